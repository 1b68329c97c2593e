"""From column pairs to the column map: thresholds, weighted score, three reductions, synonyms, overlap, filters."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.config import Thresholds, Weights


def _number(name: str) -> Column:
    """NaN counts as missing: in Spark it would be greater than any threshold."""
    return F.when(~F.isnan(F.col(name)), F.col(name))


def filter_pairs(features: DataFrame, t: Thresholds | None = None) -> DataFrame:
    """The pairs within all thresholds. A missing feature drops a pair, and so do equal column names unless they are allowed."""
    t = t or Thresholds()
    good = (
        (_number("avg_length_diff") < t.max_avg_length_diff)
        & (_number("master_fill_rate") >= t.min_fill_rate)
        & (_number("enrichment_fill_rate") >= t.min_fill_rate)
        & (_number("description_similarity") >= t.min_description_similarity)
        & ((F.col("master_data_type") == F.col("enrichment_data_type")) | (_number("description_similarity") > t.high_similarity_override))
        & (_number("entropy_gap") <= t.max_entropy_gap)
    )
    same = F.col("master_column") == F.col("enrichment_column")
    return features.where(good & ~(same & (F.col("enrichment_dataset") == F.col("master_dataset")) if t.allow_same_name else same))


def weighted_score(pairs: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Adds weighted_score: the weighted sum of the means of the features over the pairs of a master column and a dataset."""
    group = W.partitionBy("master_column", "enrichment_dataset")
    terms = [F.coalesce(F.avg(_number(name)).over(group) * w, F.lit(0.0)) for name, w in asdict(weights or Weights()).items()]
    return pairs.withColumn("weighted_score", sum(terms[1:], terms[0]))


def best_of(df: DataFrame, keys: list[str], ties: list[str], score: str = "weighted_score") -> DataFrame:
    """The row of the highest score for each key; ties go to the first in the order of ``ties``."""
    order = W.partitionBy(*keys).orderBy(F.desc_nulls_last(score), *[F.asc(c) for c in ties])
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def reduce_matches(scored: DataFrame) -> DataFrame:
    """One row for each master column and dataset, then one for each dataset and enrichment column."""
    first = best_of(scored, ["master_column", "enrichment_dataset"], ["enrichment_column"])
    return best_of(first, ["enrichment_dataset", "enrichment_column"], ["master_column"])


def synonym_clusters(best: DataFrame, master: str = "Master") -> DataFrame:
    """Adds enrichment_candidates: the master column and the master columns matched to it, sorted and joined by ", "."""
    own = best.where(F.col("enrichment_dataset") == master).groupBy("master_column").agg(F.collect_set("enrichment_column").alias("_related"))
    related = F.coalesce("_related", F.array().cast("array<string>"))
    names = F.array_sort(F.array_distinct(F.concat(related, F.array("master_column"))))
    return best.join(own, "master_column", "left").withColumn("enrichment_candidates", F.array_join(names, ", ")).drop("_related")


def overlap_percent(best: DataFrame, overlaps: DataFrame) -> DataFrame:
    """Adds percent_master_in_enrichment and percent_enrichment_in_master; 0 where nothing is shared."""
    keys = ["master_column", "enrichment_dataset", "enrichment_column"]
    shares = overlaps.select(*keys, (100 * F.col("overlap_master")).alias("percent_master_in_enrichment"), (100 * F.col("overlap_enrichment")).alias("percent_enrichment_in_master"))
    return best.join(shares, keys, "left").fillna(0.0, ["percent_master_in_enrichment", "percent_enrichment_in_master"])


def column_matches(classified: DataFrame, overlaps: DataFrame, weights: Weights | None = None, master: str = "Master") -> DataFrame:
    """The column map: pairs judged Yes, scored, reduced, clustered, and one for each dataset and cluster."""
    scored = weighted_score(classified.where(F.col("decision") == "Yes"), weights)
    best = overlap_percent(synonym_clusters(reduce_matches(scored), master), overlaps)
    out = best_of(best.where(F.col("enrichment_dataset") != master), ["enrichment_dataset", "enrichment_candidates"], ["master_column", "enrichment_column"])
    return out.select("master_column", "enrichment_dataset", "enrichment_column", "enrichment_candidates", "weighted_score", "percent_master_in_enrichment", "percent_enrichment_in_master")


def split_filters(matches: DataFrame, percent: float = 75) -> DataFrame:
    """Adds is_filter: either side's overlap reaches the threshold. Every pair stays mapped."""
    return matches.withColumn("is_filter", (F.col("percent_master_in_enrichment") >= percent) | (F.col("percent_enrichment_in_master") >= percent))


def column_map(matches: DataFrame, percent: float = 75) -> dict[str, list[tuple[str, str, bool]]]:
    """(enrichment column, master column, is_filter) by dataset, in order; a plan's parameters, one entry for each mapped column."""
    out: dict[str, list[tuple[str, str, bool]]] = {}
    for r in split_filters(matches, percent).orderBy("enrichment_dataset", "master_column", "enrichment_column").collect():
        out.setdefault(r.enrichment_dataset, []).append((r.enrichment_column, r.master_column, r.is_filter))
    return out
