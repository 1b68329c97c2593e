"""Pairs of a master column and any column: value overlap and all features, in a fixed number of jobs whatever the number of pairs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.functions.similarity import cosine, fuzzy_ratio, fuzzy_token_set_ratio, fuzzy_token_sort_ratio
from matchloom.operators.profile import KEYS, catalog, column_stats, value_counts
from matchloom.schemas import PAIR_FEATURES
from matchloom.sources.intermediate import materialize

SIDES = ("master", "enrichment")


def column_pairs(columns: DataFrame, master: str = "Master") -> DataFrame:
    """Every (master column, dataset, column), the master's own columns included. The catalog has a row for each column, not each value."""
    left = columns.where(F.col("dataset") == master).select(F.col("column_name").alias("master_column"))
    right = columns.select(F.col("dataset").alias("enrichment_dataset"), F.col("column_name").alias("enrichment_column"))
    return left.crossJoin(right).select(F.lit(master).alias("master_dataset"), "master_column", "enrichment_dataset", "enrichment_column")


def overlap(counts: DataFrame, master: str = "Master", pairs: DataFrame | None = None) -> DataFrame:
    """n_master, n_enrichment, n_both (distinct values) and the ratios overlap_master, overlap_enrichment, overlap_jaccard of each pair.

    ``counts`` are of values or of their digests, and are read three times: write them first.

    One join on the value for all pairs: both sides hold each distinct value of a column once, so a frequent value is no hot key, and
    partial counts of pairs are made before the last shuffle. Without ``pairs``, those that share no value are left out.
    """
    values = counts.where(F.col("value").isNotNull()).select(*KEYS, "value")
    left = values.where(F.col("dataset") == master).select(F.col("column_name").alias("master_column"), "value")
    right = values.select(F.col("dataset").alias("enrichment_dataset"), F.col("column_name").alias("enrichment_column"), "value")
    both = left.join(right, "value").groupBy("master_column", "enrichment_dataset", "enrichment_column").agg(F.count(F.lit(1)).alias("n_both"))
    sizes = values.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    if pairs is not None:
        both = pairs.join(both, ["master_column", "enrichment_dataset", "enrichment_column"], "left")
    m = sizes.where(F.col("dataset") == master).select(F.col("column_name").alias("master_column"), F.col("n").alias("n_master"))
    e = sizes.select(F.col("dataset").alias("enrichment_dataset"), F.col("column_name").alias("enrichment_column"), F.col("n").alias("n_enrichment"))
    out = both.join(m, "master_column", "left").join(e, ["enrichment_dataset", "enrichment_column"], "left").fillna(0, ["n_both", "n_master", "n_enrichment"])
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    n, a, b = F.col("n_both"), F.col("n_master"), F.col("n_enrichment")
    return out.withColumns({"overlap_master": share(n, a), "overlap_enrichment": share(n, b), "overlap_jaccard": share(n, a + b - n)})


def gaps(pairs: DataFrame, stats: DataFrame, master: str = "Master") -> DataFrame:
    """The pairs with fill rates, entropies, avg_length_diff and entropy_gap; a gap is null if a side is."""
    wanted = ("fill_rate", "entropy", "avg_length")
    m = stats.where(F.col("dataset") == master).select(F.col("column_name").alias("master_column"), *[F.col(c).alias(f"master_{c}") for c in wanted])
    e = stats.select(F.col("dataset").alias("enrichment_dataset"), F.col("column_name").alias("enrichment_column"), *[F.col(c).alias(f"enrichment_{c}") for c in wanted])
    out = pairs.join(m, "master_column", "left").join(e, ["enrichment_dataset", "enrichment_column"], "left")
    return out.withColumns({"avg_length_diff": F.abs(F.col("master_avg_length") - F.col("enrichment_avg_length")), "entropy_gap": F.abs(F.col("master_entropy") - F.col("enrichment_entropy"))})


def pair_features(datasets: Mapping[str, DataFrame], described: DataFrame, master: str = "Master", counts: DataFrame | None = None) -> DataFrame:
    """All features of all pairs. ``described`` has dataset, column_name, data_type, example_values, description and vector (array<float>).

    ``counts`` are the value counts of all cells, or of their digests, where they are there already; else digests are counted here, and
    written once.
    """
    spark = next(iter(datasets.values())).sparkSession
    columns = catalog(spark, datasets)
    counts = materialize(value_counts(datasets, digests=True), "value-counts") if counts is None else counts
    pairs = column_pairs(columns, master)
    out = gaps(overlap(counts, master, pairs), column_stats(counts, columns), master)
    for side in SIDES:
        keys = ["master_column"] if side == "master" else ["enrichment_dataset", "enrichment_column"]
        own = described.where(F.col("dataset") == master) if side == "master" else described
        names = {"column_name": f"{side}_column", "data_type": f"{side}_data_type", "example_values": f"{side}_example_values", "description": f"{side}_description", "vector": f"{side}_vector"}
        own = own.withColumnsRenamed(names | ({} if side == "master" else {"dataset": "enrichment_dataset"}))
        out = out.join(own.drop("dataset") if side == "master" else own, keys, "left")
    names = F.col("master_column"), F.col("enrichment_column")
    out = out.withColumns(
        {
            "fuzzy_ratio": fuzzy_ratio(*names),
            "fuzzy_token_sort_ratio": fuzzy_token_sort_ratio(*names),
            "fuzzy_token_set_ratio": fuzzy_token_set_ratio(*names),
            "description_similarity": cosine(F.col("master_vector"), F.col("enrichment_vector"), 0.0),
            "type_mismatch": F.col("master_data_type") != F.col("enrichment_data_type"),
            "status": F.lit("processed"),
        }
    )
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PAIR_FEATURES.fields])
