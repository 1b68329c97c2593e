"""Connected components by alternating large and small stars; every round is written, so a lost executor costs one round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.shared import materialize, scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round on edges (a > b). Large: the greater neighbours of a node are tied to its least; small: the lesser ones and itself.

    The least neighbour is aggregated before its shuffle and written; a node of very many edges then meets it in a join of two plain
    exchanges, which adaptive execution divides.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "star-least", narrow=True)
    met = both.join(least, "a")
    if large:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return materialize(out.where("a != b").distinct(), "star-edges", narrow=True)


def _settled(edges: DataFrame) -> bool:
    """All nodes hang on a root, and on one only."""
    roles = edges.select(F.col("a").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("root")).union(edges.select("b", F.lit(0), F.lit(1)))
    odd = roles.groupBy("x").agg(F.sum("child").alias("child"), F.max("root").alias("root")).where("child > 1 OR (child > 0 AND root > 0)")
    return odd.isEmpty()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """id and root (the least id of its component) of every node of the written edges (a, b: long), as a written table; what the rounds wrote is deleted.

    Self-loops and repeated edges do no harm; no edges give an empty table.
    """
    with scratch():
        edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        for _ in range(rounds):
            edges = _star(_star(edges, True), False)
            if _settled(edges):
                roots = edges.select(F.col("a").alias("id"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
                return materialize(roots, "components", narrow=True, outlive=True)
    raise RuntimeError("the components did not settle")
