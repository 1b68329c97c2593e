"""Merkle manifest of a dataset: trees of fan-out 8 over the rows of each group, reduced superblock by superblock, with a proof for each row."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.llm.shared import materialize, only, partitions

#: Children of a node, and levels that one task collapses: a superblock has FANOUT ** LEVELS nodes.
FANOUT, LEVELS = 8, 4
#: Stands in a level of a proof for the node itself.
OWN = "*"


def hashed(parts: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the parts, one after another."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the length in bytes, ``:`` and the value: no two rows of fields give the same string."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _node(children: Sequence[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def _collapse(nodes: list[str], n: int, high: int) -> list[list[str]]:
    """The levels above a superblock's nodes, itself first, of a tree whose level has ``n`` nodes: ``high`` more, or as many as leave one node."""
    levels = [nodes]
    while len(levels) <= high and (n > FANOUT**high or len(levels[-1]) > 1):
        last = levels[-1]
        levels.append([_node(last[k : k + FANOUT]) for k in range(0, len(last), FANOUT)])
    return levels


def _runs(level: list[str]) -> list[str]:
    """For each node its run's digests in order, with OWN in its own place."""
    runs = [level[k : k + FANOUT] for k in range(0, len(level), FANOUT)]
    return ["".join(run[:k]) + OWN + "".join(run[k + 1 :]) for run in runs for k in range(len(run))]


def ranked(df: DataFrame, order: Sequence[str], span: int) -> DataFrame:
    """``df`` (with g: string) and the place i of each row among those of its g, from 0, in ``order``, n (rows of its g) and b = i / ``span``.

    Rows are sorted by range and written with their place in their partition; for each partition and group, which are few, the rows
    before are summed up. No task sees a group whole.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("g", *order)]
    ranged = df.repartitionByRange(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
    placed = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "manifest-order")
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumn("_part", part).withColumn("_at", inside)
    by_part = placed.groupBy("g", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("g").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = by_part.select("g", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(W.partitionBy("g")).alias("n"))
    out = placed.join(materialize(starts, "manifest-starts", narrow=True), ["g", "_part"])
    return out.withColumn("i", F.col("_at") + F.col("_shift")).withColumn("b", F.floor(F.col("i") / span)).drop("_part", "_at", "_shift")


def _up(nodes: DataFrame, high: int) -> DataFrame:
    """The roots of the superblocks of nodes (g, i, n, b, h), as the nodes of the next level."""

    span = FANOUT**high

    def collapse(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("i")
        n, b = int(rows.n.iloc[0]), int(rows.b.iloc[0])
        root = _collapse(rows.h.tolist(), n, high)[-1]
        return pd.DataFrame({"g": [rows.g.iloc[0]], "i": [b], "n": [-(-n // span)], "b": [b // span], "h": root})

    return nodes.select("g", "i", "n", "b", "h").groupBy("g", "b").applyInPandas(collapse, "g string, i long, n long, b long, h string")


def _down(nodes: DataFrame, above: DataFrame, high: int) -> DataFrame:
    """Nodes with the path from them up: their own superblock's levels, then those of its root, which ``above`` (g, i, path, subroot, root) has."""
    kept = [c for c in nodes.columns if c not in ("b", "n")]

    def descend(rows: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("i")
        levels = [_runs(level) for level in _collapse(rows.h.tolist(), int(rows.n.iloc[0]), high)[:-1]]
        rest, out = list(upper.path.iloc[0]), rows[kept].copy()
        out["path"] = [[level[k // FANOUT**m] for m, level in enumerate(levels)] + rest for k in range(len(rows))]
        out["subroot"], out["root"] = upper.subroot.iloc[0], upper.root.iloc[0]
        return out

    kinds = dict(nodes.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", path array<string>, subroot string, root string"
    return nodes.groupBy("g", "b").cogroup(above.withColumnRenamed("i", "b").groupBy("g", "b")).applyInPandas(descend, schema)


def _tree(leaves: DataFrame, high: int) -> list[DataFrame]:
    """The written levels of superblock roots over ranked leaves (g, i, n, b, h); the last has one node for each g."""
    levels = [leaves]
    while len(levels) == 1 or not levels[-1].where("n > 1").isEmpty():
        levels.append(materialize(_up(levels[-1], high), "manifest-level", narrow=True))
    return levels


def _paths(levels: list[DataFrame], top: DataFrame, high: int) -> DataFrame:
    """The leaves of a tree with their paths, given those of its roots."""
    for nodes in levels[-2:0:-1]:
        top = _down(nodes, top, high).select("g", "i", "path", "subroot", "root")
    return _down(levels[0], top, high)


def manifest(leaves: DataFrame, group: str, order: Sequence[str], high: int = LEVELS) -> DataFrame:
    """``leaves`` (with the digest ``leaf``) and, for each, subroot (of its group), root (of all) and path, from the leaf up to the root.

    A group's leaves ascend by ``order``, nulls first, then by digest; groups ascend by their bytes, null first. While a level has
    several nodes, every 8 in turn, or what is left, become the hash of their digests; a lone leaf is a subroot itself. A level of a path is
    the run's digests in order with ``*`` for the node itself, so ``fold`` replays it. A task takes 8 ** ``high`` nodes of a group and collapses
    so many levels; the roots of these superblocks are reduced likewise. An empty table gives no row; equal rows are leaves each.
    Other columns ride along; those with a name of the three added ones are replaced.
    """
    given = [c for c in leaves.columns if c not in (group, "leaf", "path", "subroot", "root")]
    kept = F.struct(*[F.col(f"`{c}`") for c in given]).alias("kept") if given else F.struct(F.lit(0).alias("none")).alias("kept")
    keyed = leaves.select(F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`")), F.lit("")).alias("g"), *[F.col(f"`{c}`").alias(f"o{k}") for k, c in enumerate(order)], F.col("leaf").alias("h"), kept)
    keyed = materialize(keyed, "manifest-leaves")  # what the leaves were made from is read once, though a sort by range reads twice
    levels = _tree(ranked(keyed, [*[f"o{k}" for k in range(len(order))], "h"], FANOUT**high).drop(*[f"o{k}" for k in range(len(order))]), high)
    subroots = levels[-1].select(F.lit("").alias("g"), F.col("g").alias("of"), "h")
    over = _tree(materialize(ranked(subroots, ["of"], FANOUT**high), "manifest-groups", narrow=True), high)
    roots = over[-1].select("g", "i", F.array().cast("array<string>").alias("path"), F.lit("").alias("subroot"), F.col("h").alias("root"))
    tops = _paths(over, roots, high).select(F.col("of").alias("g"), F.lit(0).cast("long").alias("i"), "path", F.col("h").alias("subroot"), "root")
    found = _paths(levels, materialize(tops, "manifest-tops", narrow=True), high)
    own = F.when(F.col("g") != "", F.expr("substring(g, 2)")).alias(group)
    return found.select(own, F.col("h").alias("leaf"), *[F.col("kept")[c].alias(c) for c in given], "path", "subroot", "root")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda node, run: F.sha2(F.replace(run, F.lit(OWN), node), 256))


def siblings(path: Column) -> Column:
    """The digests of a path in order, without the own places."""
    return F.array_join(F.transform(path, lambda run: F.replace(run, F.lit(OWN), F.lit(""))), "")


#: The fields of a document's leaf, in order.
FIELDS = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof in the manifest of ``documents``, and whether what is shown for it folds to the root.

    Shown is the document, with A-Z of its text in lower case where 3 divides the crc32 of its doc_id. Nulls are ``-`` in a leaf; an empty
    text is ``0:``; a null doc_id isn't tampered with and comes first; rows with one doc_id follow each other by their digests; texts of
    any length are hashed whole, by the JVM, and only digests are shuffled.
    """
    docs = only(spark.read.parquet(f"{sf_dir}/documents.parquet"), **FIELDS)
    whole = hashed([field(F.col(c)) for c in FIELDS])
    lowered = hashed([field(F.translate("text", UPPER, LOWER) if c == "text" else F.col(c)) for c in FIELDS])
    shown = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, lowered).otherwise(whole)
    found = manifest(docs.select("doc_id", "lang", whole.alias("leaf"), shown.alias("shown")), "lang", ["doc_id"])
    folded = found.withColumn("folded_root", fold(F.col("shown"), F.col("path")))
    proof = F.sha2(siblings(F.col("path")), 256).alias("proof_sha256")
    return folded.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
