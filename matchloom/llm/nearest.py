"""Approximate nearest neighbours: lists of an index probed in two rounds, candidates scanned by column blocks and abandoned early."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.llm.shared import materialize, only, partitions, slices

#: Rows that the centroids are fitted on, and the most lists: lists are the root of the rows, this many at most.
SAMPLE, LISTS = 16_384, 1024
#: Queries that the number of probes is read off, by brute force, and the share of their neighbours that the probed lists must hold.
PROBED, HELD = 256, 0.98
#: Candidates and queries of a tile.
CANDIDATES, QUERIES = 2048, 1024
#: Columns of a block, and how many deviations a partial distance may lie above the limit before its candidate is abandoned.
COLUMNS, DEVIATIONS = 16, 2.1


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, scaled by their largest component first, so that no square is lost or too large."""
    if not x.size:
        return x
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def rotation(width: int, seed: int = 0) -> np.ndarray:
    """A random rotation: after it, any columns tell as much of a distance as any others."""
    q, r = np.linalg.qr(np.random.default_rng((seed, width)).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def _centroids(x: np.ndarray, lists: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """Spherical k-means of unit rows; a list that is left empty takes the row that is farthest from its centroid."""
    lists = min(lists, len(x))
    c = x[np.random.default_rng(seed).choice(len(x), lists, replace=False)]
    for _ in range(rounds):
        near = x @ c.T
        own = near.argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        empty = np.nonzero(np.bincount(own, minlength=lists) == 0)[0]
        sums[empty] = x[np.argsort(near.max(axis=1), kind="stable")[: len(empty)]]
        norms = np.sqrt(np.einsum("ij,ij->i", sums, sums))
        c = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-300)[:, None], c)
    return c


def scan(queries: np.ndarray, candidates: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs (query, candidate) of rotated unit vectors that may lie within the squared distance ``limits`` of their query, and the
    number of components that were looked at.

    Columns come block by block. The distance over d of D columns, times D / d, estimates the whole: a pair goes once that lies more
    than DEVIATIONS / sqrt(d) above the limit (the hypothesis that it is within the limit is rejected). What is left at the end is within.
    """
    width = queries.shape[1]
    a, b = np.meshgrid(np.arange(len(queries)), np.arange(len(candidates)), indexing="ij")
    a, b = a.ravel(), b.ravel()
    partial, looked = np.zeros(len(a)), 0
    for start in range(0, width, COLUMNS):
        stop = min(width, start + COLUMNS)
        x, y = queries[:, start:stop], candidates[:, start:stop]
        looked += len(a) * (stop - start)
        if len(a) * 4 > len(queries) * len(candidates):  # most are left: a product of matrices
            dense = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", y, y)[None, :] - 2 * (x @ y.T)
            partial += dense[a, b]
        else:
            partial += np.concatenate([((x[a[k : k + 65536]] - y[b[k : k + 65536]]) ** 2).sum(axis=1) for k in range(0, len(a), 65536)] or [np.zeros(0)])
        slack = (1 + DEVIATIONS / math.sqrt(stop)) ** 2 if stop < width else 1 + 1e-6
        near = partial * (width / stop) <= limits[a] * slack + 1e-9
        a, b, partial = a[near], b[near], partial[near]
    return a, b, looked


def _best(a: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k pairs of the highest score of each query a, ties to smaller ids."""
    order = np.lexsort((ids, -scores, a))
    first = np.r_[True, a[order][1:] != a[order][:-1]] if len(order) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0)) if len(order) else np.zeros(0, int)
    return order[np.arange(len(order)) - start < k]


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The cosine of each row of x with that of y, in double precision."""
    norm = np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))
    plain = np.einsum("ij,ij->i", x, y) / np.where((norm > 1e-150) & np.isfinite(norm), norm, 1)
    odd = ~((norm > 1e-150) & np.isfinite(norm))  # components whose squares leave the range of doubles
    if odd.any():
        plain[odd] = np.einsum("ij,ij->i", _unit(x[odd]), _unit(y[odd]))
    return np.clip(plain, -1, 1)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows with an id and a vector without null, with finite components that aren't all zero."""
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("id").isNotNull() & (F.size("v") > 0) & whole & F.exists("v", lambda x: x != 0))


class Index:
    """Centroids by width of the vectors, from a bounded sample; vectors of a width that the sample lacks form one list."""

    def __init__(self, sample: np.ndarray | list, rows: int):
        by_width: dict[int, list] = {}
        for v in sample:
            by_width.setdefault(len(v), []).append(v)
        lists = max(1, min(LISTS, round(math.sqrt(rows))))
        self.centroids = {w: _centroids(_unit(np.array(x, dtype=np.float64)), max(1, round(lists * len(x) / len(sample)))) for w, x in by_width.items()}
        self.first, at = {}, 1  # list 0 is for other widths
        for w, c in sorted(self.centroids.items()):
            self.first[w], at = at, at + len(c)
        self.lists = at

    def nearness(self, x: np.ndarray) -> np.ndarray | None:
        c = self.centroids.get(x.shape[1])
        return None if c is None else x @ c.T

    def order(self, x: np.ndarray, probes: int) -> np.ndarray:
        """The numbers of the ``probes`` lists nearest to each unit row, nearest first."""
        near = self.nearness(x)
        if near is None:
            return np.zeros((len(x), 1), np.int64)
        return np.argsort(-near, axis=1, kind="stable")[:, :probes] + self.first[x.shape[1]]


def _by_width(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of one width, as their places and their matrix."""
    lists = batch.column(batch.schema.get_field_index(column))
    widths = np.asarray(pc.list_value_length(lists))
    for w in np.unique(widths):
        at = np.nonzero(widths == w)[0]
        yield at, _matrix(lists.take(pa.array(at)))


def _arrays(x: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel(), kind))


def _indexed(vectors: DataFrame, index: Index) -> DataFrame:
    """list, id, v and r (the rotated unit vector) of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "v"):
            ids = np.asarray(batch.column(0))
            for at, x in _by_width(batch, "v"):
                unit = _unit(x)
                arrays = [pa.array(index.order(unit, 1)[:, 0].astype(np.int32)), pa.array(ids[at]), _arrays(x, pa.float64()), _arrays(unit @ rotation(x.shape[1]), pa.float32())]
                yield pa.RecordBatch.from_arrays(arrays, names=["list", "id", "v", "r"])

    return vectors.select("id", "v").mapInArrow(run, "list int, id long, v array<double>, r array<float>")


def _exact(vectors: DataFrame, queries: list[tuple[int, list]], k: int) -> DataFrame:
    """query_id, id, list and score: for each of a few queries the k best of every partition."""
    by_width: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for w in {len(v) for _, v in queries}:
        own = [(i, v) for i, v in queries if len(v) == w]
        by_width[w] = np.array([i for i, _ in own]), np.array([v for _, v in own], dtype=np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {w: [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0)] for w in by_width}
        for batch in slices(batches, "v"):
            ids, lists = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for at, x in _by_width(batch, "v"):
                if x.shape[1] not in by_width:
                    continue
                of, q = by_width[x.shape[1]]
                score = _unit(q) @ _unit(x).T
                score[of[:, None] == ids[at][None, :]] = -np.inf
                a = np.repeat(np.arange(len(q)), min(k, len(at)))
                b = np.argsort(-score, axis=1, kind="stable")[:, :k].ravel()
                old = best[x.shape[1]]
                new = [np.r_[old[0], a], np.r_[old[1], ids[at][b]], np.r_[old[2], lists[at][b]], np.r_[old[3], score[a, b]]]
                keep = _best(new[0], new[1], new[3], k)
                best[x.shape[1]] = [z[keep] for z in new]
        for w, (a, ids, lists, score) in best.items():
            there = score > -np.inf
            yield pa.RecordBatch.from_arrays([pa.array(by_width[w][0][a][there]), pa.array(ids[there]), pa.array(lists[there], pa.int32()), pa.array(score[there])], names=["query_id", "id", "list", "score"])

    return vectors.select("id", "list", "v").mapInArrow(run, "query_id long, id long, list int, score double")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def probes_for(vectors: DataFrame, queries: DataFrame, index: Index, k: int) -> int:
    """How many lists must be probed so that they hold a share of HELD of the nearest k of PROBED of the queries, found by brute force."""
    some = queries.orderBy(F.xxhash64("id"), "id").limit(PROBED).collect()  # a bounded number
    if not some:
        return 1
    ranks, at = [], {r.id: r.v for r in some}
    for r in _first(_exact(vectors, [(r.id, r.v) for r in some], k), k).select("query_id", "list").collect():  # PROBED * k rows
        order = index.order(_unit(np.array([at[r.query_id]], dtype=np.float64)), index.lists)[0]
        ranks.append(int(np.nonzero(order == r["list"])[0][0]) + 1)
    return sorted(ranks)[min(len(ranks) - 1, math.ceil(HELD * len(ranks)) - 1)] if ranks else 1


def _probes(queries: DataFrame, index: Index, start: int, stop: int) -> DataFrame:
    """Each query with each of the lists ``start`` to ``stop`` in its order of nearness."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "v"):
            for at, x in _by_width(batch, "v"):
                unit = _unit(x)
                lists = index.order(unit, stop)[:, start:]
                for p in range(lists.shape[1]):
                    rows = batch.take(pa.array(at))
                    arrays = [pa.array(lists[:, p].astype(np.int32)), *rows.columns, _arrays(unit @ rotation(x.shape[1]), pa.float32())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["list", "id", "v", "tau", "r"])

    return queries.select("id", "v", "tau").mapInArrow(run, "list int, id long, v array<double>, tau double, r array<float>")


def _tile(k: int):
    """Of a tile: the best k candidates of each query, and the components that were looked at of all there are."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
        if left.num_rows and right.num_rows:
            of, ids = np.asarray(left.column("id")), np.asarray(right.column("id"))
            tau = np.asarray(pc.fill_null(left.column("tau"), float("inf")))
            for (la, lx), (ra, rx) in ((x, y) for x in _groups(left) for y in _groups(right)):
                if lx[0].shape[1] != rx[0].shape[1]:
                    continue
                for at in range(0, len(la), 128):
                    own = la[at : at + 128]
                    a, b, _ = scan(lx[1][at : at + 128], rx[1], tau[own])
                    other = of[own[a]] != ids[ra[b]]
                    a, b = a[other], b[other]
                    score = cosines(lx[0][at + a], rx[0][b])
                    keep = _best(a, ids[ra[b]], score, k)
                    for whole, part in zip(out, (of[own[a[keep]]], ids[ra[b[keep]]], score[keep]), strict=True):
                        whole.append(part)
        return pa.table({"query_id": np.concatenate(out[0]), "id": np.concatenate(out[1]), "score": np.concatenate(out[2])})

    def _groups(table: pa.Table):
        v, r = table.column("v").combine_chunks(), table.column("r").combine_chunks()
        widths = np.asarray(pc.list_value_length(v))
        return [(at := np.nonzero(widths == w)[0], (_matrix(v.take(pa.array(at))), _matrix(r.take(pa.array(at))))) for w in np.unique(widths)]

    return run


def _searched(probed: DataFrame, indexed: DataFrame, blocks: list[int], k: int) -> DataFrame:
    """query_id, id and score: of each tile of a list (a block of its candidates, a chunk of the queries that probe it) the best k of each query."""
    n_blocks = F.get(F.split(F.lit(",".join(map(str, blocks))), ",").cast("array<int>"), F.col("list"))
    asked = probed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("chunks"))
    sizes = {r["list"]: r.chunks for r in asked.collect()}  # a number for each list, LISTS at most
    n_chunks = F.get(F.split(F.lit(",".join(str(sizes.get(x, 0)) for x in range(len(blocks)))), ",").cast("array<int>"), F.col("list"))
    every = lambda n: F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")))
    left = probed.withColumn("chunk", F.pmod(F.xxhash64("id"), n_chunks).cast("int")).withColumn("block", every(n_blocks))
    right = indexed.withColumn("block", F.pmod(F.xxhash64("id"), n_blocks).cast("int")).withColumn("chunk", every(n_chunks))
    return left.groupBy("list", "block", "chunk").cogroup(right.groupBy("list", "block", "chunk")).applyInArrow(_tile(k), "query_id long, id long, score double")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), id and score (cosine, in doubles): the k nearest found of each query's vector (id, v) among vectors (id, v) of other ids.

    Every vector is in a list. How many lists a query probes is measured: as many as hold 98 % of the true neighbours of up to
    256 queries. The nearest list is scanned whole and gives each query its limit; in the others, candidates are abandoned by
    partial distances over blocks of rotated columns. Lists are dealt into blocks and the queries of a list into chunks, so a list of any size
    is searched whole. Queries that found fewer than k search all other lists. Null and zero vectors, those with null or non-finite
    components, and rows without an id take no part; vectors of different widths aren't compared; rows that repeat an id count once, with their best score; equal scores
    rank by id; an empty table gives no row.
    """
    both = [usable(only(df, id="long", v="array<double>")) for df in (vectors, queries)]
    written = materialize(both[0], "nearest-vectors")
    rows = written.count()
    if not rows:
        return written.selectExpr("id AS query_id", "1 AS rank", "id", "0D AS score").limit(0)
    sample = written.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()  # a bounded sample
    index = Index([r.v for r in sample], rows)
    indexed = materialize(_indexed(written, index), "nearest-lists")
    sizes = {r["list"]: r["count"] for r in indexed.groupBy("list").count().collect()}  # a number for each list
    blocks = [-(-sizes.get(x, 0) // CANDIDATES) for x in range(index.lists)]
    asked = materialize(both[1].repartition(partitions(written.sparkSession), "id"), "nearest-queries")
    probes = probes_for(indexed, asked, index, k)

    def round_(of: DataFrame, start: int, stop: int) -> DataFrame:
        probed = materialize(_probes(of, index, start, stop), "nearest-probes")
        return materialize(_searched(probed, indexed, blocks, k), "nearest-found")

    def limits(found: DataFrame) -> DataFrame:
        worst = _first(found, k).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst"))
        met = asked.join(worst.withColumnRenamed("query_id", "id"), "id", "left")
        return met.select("id", "v", F.when(F.col("n") >= k, 2 - 2 * F.col("worst")).alias("tau"), F.coalesce("n", F.lit(0)).alias("n"))

    once = lambda found: found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    found = round_(asked.withColumn("tau", F.lit(None).cast("double")), 0, 1)
    if probes > 1:
        found = found.unionByName(round_(limits(once(found)), 1, probes))
    if probes < index.lists:
        short = limits(once(found)).where(F.col("n") < k)
        found = found.unionByName(round_(short, probes, index.lists))
    return _first(once(found), k).select("query_id", "rank", "id", "score")


def op11_dimension_scan(spark, sf_dir: str) -> DataFrame:
    """The 5 nearest of ``embeddings`` to each row whose vec_id is divisible by 50; see ``nearest`` for odd rows."""
    vectors = only(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), vec_id="long", embedding="array<double>").withColumnsRenamed({"vec_id": "id", "embedding": "v"})
    found = nearest(vectors, vectors.where("id % 50 = 0"))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
