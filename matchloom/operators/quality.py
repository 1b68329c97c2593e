"""Data tests: the rows that break a rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.functions.text import quote


def not_positive(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is there and not above zero; an empty result is a pass."""
    return df.where(F.col(quote(column)).isNotNull() & (F.col(quote(column)) <= 0))
