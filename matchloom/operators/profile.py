"""Profiles of columns: one long table of value counts, and all statistics from it."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.functions.text import numeric_text, quote, timestamp_text

KEYS = ("dataset", "column_name")


def catalog(spark: SparkSession, datasets: Mapping[str, DataFrame]) -> DataFrame:
    """dataset and column_name of every column, from the schemas."""
    return spark.createDataFrame([(d, c) for d, df in datasets.items() for c in df.columns], "dataset string, column_name string")


def long_values(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """dataset, column_name, value: every cell as a string. Each dataset is scanned once for all its columns."""
    parts = []
    for name, df in datasets.items():
        cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(quote(c)).cast("string").alias("value")) for c in df.columns])
        parts.append(df.select(F.lit(name).alias("dataset"), F.explode(cells).alias("x")).select("dataset", "x.*"))
    return reduce(DataFrame.unionByName, parts)


def value_counts(datasets: Mapping[str, DataFrame], digests: bool = False) -> DataFrame:
    """dataset, column_name, value, n. The one shuffle that all statistics share; partial counts are made before it.

    With ``digests``, value is binary and at most 16 bytes, and its text's length beside it: texts of 16 bytes or more are their MD5, shorter
    ones themselves, so neither is ever the other. That is all that ``column_stats`` and ``overlap`` ask for, however long the texts.
    """
    cells = long_values(datasets)
    if not digests:
        return cells.groupBy(*KEYS, "value").agg(F.count(F.lit(1)).alias("n"))
    short = F.when(F.octet_length("value") < 16, F.col("value").cast("binary")).otherwise(F.unhex(F.md5("value")))
    return cells.select(*KEYS, short.alias("value"), F.length("value").alias("length")).groupBy(*KEYS, "value").agg(F.max("length").alias("length"), F.count(F.lit(1)).alias("n"))


def column_stats(counts: DataFrame, columns: DataFrame | None = None) -> DataFrame:
    """n_rows, n_values, n_distinct, fill_rate, avg_length (of distinct values) and entropy (bits) of each column.

    With ``columns`` (a catalog), those of empty datasets are there too, with nulls. The counts are of values or of their digests.
    """
    length = F.col("length") if "length" in counts.columns else F.length("value")
    there = F.col("value").isNotNull()
    n = F.when(there, F.col("n"))
    stats = counts.groupBy(*KEYS).agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(n), F.lit(0)).alias("n_values"),
        F.count("value").alias("n_distinct"),
        F.avg(length).alias("avg_length"),
        F.sum(n * F.log2(n)).alias("_weighted"),
    )
    values = F.col("n_values").cast("double")
    stats = stats.withColumns({"fill_rate": values / F.col("n_rows"), "entropy": F.when(F.col("n_values") > 0, F.greatest(F.log2(values) - F.col("_weighted") / values, F.lit(0.0)))}).drop("_weighted")
    if columns is not None:
        stats = columns.join(stats, list(KEYS), "left").fillna(0, ["n_rows", "n_values", "n_distinct"])
    return stats


def top_values(counts: DataFrame, k: int = 10) -> DataFrame:
    """value, n and rank of the k most frequent values of each column, ties by value."""
    order = W.partitionBy(*KEYS).orderBy(F.desc("n"), F.asc("value"))
    return counts.where(F.col("value").isNotNull()).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def detect_types(counts: DataFrame) -> DataFrame:
    """data_type of each column: numerical if all values are numbers, else datetime if all are timestamps, unknown if there is none, else text."""
    n = F.when(F.col("value").isNotNull(), F.col("n"))
    seen = counts.groupBy(*KEYS).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("n_values"),
        F.coalesce(F.sum(F.when(numeric_text(F.col("value")).isNotNull(), n)), F.lit(0)).alias("n_numbers"),
        F.coalesce(F.sum(F.when(timestamp_text(F.col("value")).isNotNull(), n)), F.lit(0)).alias("n_times"),
    )
    kind = F.when(F.col("n_values") == 0, "unknown").when(F.col("n_numbers") == F.col("n_values"), "numerical").when(F.col("n_times") == F.col("n_values"), "datetime").otherwise("text")
    return seen.withColumn("data_type", kind)


def sample_rows(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """At most n rows, the same ones each time: those whose values, as text, have the least MD5."""
    values = [F.coalesce(F.col(quote(c)).cast("string"), F.lit("")) for c in df.columns]
    return df.withColumn("_order", F.md5(F.concat_ws("|", F.lit(str(seed)), *values))).orderBy("_order", *[quote(c) for c in df.columns]).limit(n).drop("_order")


def metadata(datasets: Mapping[str, DataFrame], k: int = 10, sample: int | None = 1000, counts: DataFrame | None = None) -> DataFrame:
    """dataset, column_name, data_type, example_values (the k most frequent), of a sample of each dataset, or of all rows without ``sample``.

    Without ``sample``, ``counts`` are the value counts of all rows where they are there already.
    """
    seen = {d: sample_rows(df, sample) for d, df in datasets.items()} if sample else datasets
    counts = value_counts(seen) if sample or counts is None else counts
    examples = top_values(counts, k).groupBy(*KEYS).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))), lambda x: x["value"]).alias("example_values"))
    types = detect_types(counts).select(*KEYS, "data_type")
    spark = next(iter(datasets.values())).sparkSession
    out = catalog(spark, datasets).join(types, list(KEYS), "left").join(examples, list(KEYS), "left")
    return out.select(*KEYS, F.coalesce("data_type", F.lit("unknown")).alias("data_type"), F.coalesce("example_values", F.array().cast("array<string>")).alias("example_values"))
