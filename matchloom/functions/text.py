"""Normal forms, evidence strings, identifiers and the test for English, as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts of these characters alone count as English without a detector.
ASCII_TEXT = r"^[\x20-\x7E\t\r\n]*$"


def quote(name: str) -> str:
    """A column name between backticks."""
    return "`" + name.replace("`", "``") + "`"


def safe_name(text: str, max_len: int = 80) -> str:
    """Letters, digits and underscores only, cut to ``max_len``; never empty, never a digit first."""
    out = re.sub(r"\W+", "_", text, flags=re.ASCII).strip("_")[:max_len]
    return out if out and not out[0].isdigit() else f"c_{out}"


def json_safe(value: str | None, data_type: str) -> int | float | str | None:
    """An example value as it is shown in JSON: numbers of numerical columns as numbers, whole ones without a point; all else as text."""
    if value is None or data_type != "numerical":
        return value
    try:
        return float(value) if "." in value or "e" in value.lower() else int(value)
    except ValueError:
        return value


def normalize(column: Column, unicode_words: bool = False) -> Column:
    """Lower case, no punctuation, single spaces, no space at either end; null becomes empty.

    Word characters are ASCII unless ``unicode_words`` is set: accented letters then stay.
    """
    flag = "(?U)" if unicode_words else ""
    text = F.lower(F.trim(F.coalesce(column.cast("string"), F.lit(""))))
    return F.trim(F.regexp_replace(F.regexp_replace(text, flag + r"[^\w\s]", ""), r"\s+", " "))


def evidence(pairs: Sequence[tuple[str, Column]]) -> Column:
    """``label: value`` for each pair, joined by "; "; a null value reads ``nan``."""
    return F.concat_ws("; ", *[F.concat(F.lit(f"{label}: "), F.coalesce(c.cast("string"), F.lit("nan"))) for label, c in pairs])


def is_ascii_text(column: Column) -> Column:
    """True for null and for plain ASCII texts."""
    return F.coalesce(column.rlike(ASCII_TEXT), F.lit(True))


def numeric_text(column: Column) -> Column:
    """The value as a double, or null; only plain decimal notation counts."""
    text = F.trim(column.cast("string"))
    return F.when(text.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))


def timestamp_text(column: Column) -> Column:
    """The value as a timestamp without zone, or null; only ISO dates with or without a time count."""
    text = F.trim(column.cast("string"))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"), text.try_cast("timestamp_ntz"))


def contradicts_not(enrichment: Column, master: Column) -> Column:
    """True unless both values are there and differ after lower case and trim."""
    return enrichment.isNull() | master.isNull() | (F.lower(F.trim(enrichment)) == F.lower(F.trim(master)))
