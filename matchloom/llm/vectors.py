"""Near-duplicates of embeddings: passes over vectors in the order of random hyperplane codes, runs of that order, and verified links."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.components import connected_components
from matchloom.llm.shared import materialize, partitions, scratch

COSINE = 0.93
#: Vectors of a run, which are compared with each other whole: so many at most on average over a label, and the most before a run is split,
#: by so many more bits of the code.
RUN, MOST, STEP = 2048, 8192, 2
#: The least and most vectors of a block when a component is counted.
LEAST, BLOCK = 64, 1024
#: Share of links at just the limit that a vector may miss in all passes; vectors that may miss more are compared exactly, in blocks of CROWD.
#: If they are more than CROWDED of a label, all of the label are: there, the codes that seem rare are just those near a plane.
MISSED, CROWD, CROWDED = 1e-3, 4096, 0.01
#: Bits of a code, and passes that share one shuffle.
BITS, AT_ONCE = 64, 8


def _rows(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix of doubles."""
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1. They are scaled by their largest component first, so that no square is lost or too large."""
    if x.size:
        x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def bits_for(rows: int, run: int = RUN) -> int:
    """Bits of the code that leave ``run`` of so many vectors in a run, or fewer."""
    return max(1, math.ceil(math.log2(max(2.0, rows / run))))


def passes_for(rows: int, run: int = RUN, cosine: float = COSINE, missed: float = 1e-6) -> int:
    """So many passes that a pair at just ``cosine`` shares a run in one of them, but for a share of ``missed``.

    Vectors of one label, of so many rows, are in one run where their codes agree in the first ``bits_for`` bits; each bit agrees with the
    probability 1 - angle / pi. The number grows as a power of the rows, about 0.18 at 0.93: 16 for 3e4, 27 for 2e5, 37 for 1e6.
    """
    agree = (1 - math.acos(cosine) / math.pi) ** bits_for(rows, run)
    return max(4, math.ceil(math.log(missed) / math.log1p(-agree)))


def _key(label: np.ndarray, bits: np.ndarray, code: np.ndarray) -> np.ndarray:
    """A number for a run of a label: the first bits of the codes, and how many these are. Two runs that share one are compared as one."""
    start = np.where(bits > 0, code >> (BITS - np.clip(bits, 1, BITS)).astype(np.uint64), np.uint64(0))
    mixed = (start + np.uint64(0x9E3779B97F4A7C15) * bits.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9) + label.astype(np.int64).view(np.uint64) * np.uint64(0x94D049BB133111EB)
    return (mixed ^ (mixed >> np.uint64(31))).view(np.int64)


class _Runs:
    """How each pass cuts the order of its codes into runs: bits by label (others: none, one run) and the runs that were too large, by pass."""

    def __init__(self, bits: dict[int, int], seed: int):
        self.bits, self.seed = bits, seed
        self.large: dict[int, np.ndarray] = {}

    def place(self, x: np.ndarray, label: np.ndarray, passes: range) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each pass: the pass, and for each vector its run, the bits that it has, above ``BITS`` where none is small enough, and its splits."""
        labels, at = np.unique(label, return_inverse=True)
        first = np.array([self.bits.get(v, 0) for v in labels.tolist()], np.int64)[at]
        for p in passes:
            planes = np.random.default_rng((self.seed, p)).standard_normal((x.shape[1], BITS))
            code = np.packbits(x @ planes > 0, axis=1).view(">u8").ravel().astype(np.uint64)
            bits, large = first.copy(), self.large.get(p, np.zeros(0, np.int64))
            key = _key(label, bits, code)
            while len(large) and (over := np.isin(key, large) & (bits <= BITS)).any():
                bits[over] += STEP
                key = np.where(over, _key(label, bits, code), key)
            yield p, key, bits, (bits - first) // STEP

    def split(self, vectors: DataFrame, passes: range) -> None:
        """Counts the runs of some passes and splits those of more than ``MOST`` until none is left; only the large ones' numbers are collected."""

        def count(depth: int):
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    if batch.num_rows:
                        for p, key, bits, splits in self.place(_unit(_rows(batch.column(1))), np.asarray(batch.column(0)), passes):
                            keys, n = np.unique(key[(bits > 0) & (bits <= BITS) & (splits == depth)], return_counts=True)
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), p, np.int32)), pa.array(keys), pa.array(n.astype(np.int64))], names=["pass", "key", "n"])

            return run

        depth = 0
        while self.bits:
            counted = vectors.select("label", "v").mapInArrow(count(depth), "pass int, key long, n long").groupBy("pass", "key").agg(F.sum("n").alias("n"))
            found = counted.where(F.col("n") > MOST).collect()  # at most one for MOST vectors and pass
            if not found:
                return
            for p in {r["pass"] for r in found}:
                self.large[p] = np.union1d(self.large.get(p, np.zeros(0, np.int64)), np.array([r.key for r in found if r["pass"] == p], np.int64))
            depth += 1


def _joined(x: np.ndarray, cosine: float) -> np.ndarray:
    """For each unit vector the first one that it hangs together with."""
    root = np.arange(len(x))
    for at in range(0, len(x), 256):
        i, j = np.nonzero(x[at : at + 256] @ x[at:].T >= cosine)
        i, j = i + at, j + at
        while True:
            a, b = root[i], root[j]
            some = a != b
            if not some.any():
                break
            i, j, a, b = i[some], j[some], a[some], b[some]
            up = np.arange(len(x))
            np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
            while (up[up] != up).any():
                up = up[up]
            root = up[root]
    return root


def _pass_links(vectors: DataFrame, passes: range, runs: _Runs, cosine: float) -> DataFrame:
    """Some passes: each vector goes to its run once for each pass; of a run, each vector with the least one that it hangs together with.

    A label without bits is one run, so the first pass has it whole.
    """
    kind = dict(vectors.dtypes)["v"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for p, key, bits, _ in runs.place(_unit(_rows(batch.column(2))), np.asarray(batch.column(1)), passes):
                    keep = pa.array((bits <= BITS) & ((bits > 0) | (p == 0)))
                    arrays = [pa.array(np.full(len(key), p, np.int32)), batch.column(1), pa.array(key), batch.column(0), batch.column(2)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["pass", "label", "key", "id", "v"]).filter(keep)

    def join(table: pa.Table) -> pa.Table:
        ids = np.asarray(table.column("id"))
        order = np.argsort(ids)
        root = _joined(_unit(_rows(table.column("v").combine_chunks())[order]), cosine)
        linked = np.nonzero(root != np.arange(len(root)))[0]
        return pa.table({"a": pa.array(ids[order][linked]), "b": pa.array(ids[order][root[linked]])})

    placed = vectors.select("id", "label", "v").mapInArrow(place, f"pass int, label long, key long, id long, v {kind}")
    return placed.groupBy("pass", "label", "key").applyInArrow(join, "a long, b long").distinct()


def _crowded(vectors: DataFrame, passes: range, runs: _Runs, cosine: float) -> DataFrame:
    """id and label of the vectors that may miss more than ``MISSED`` of their links, by the bits of their runs."""
    agree = 1 - math.acos(cosine) / math.pi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                missed = np.zeros(batch.num_rows)
                for _, _, bits, _ in runs.place(_unit(_rows(batch.column(2))), np.asarray(batch.column(1)), passes):
                    missed += np.where(bits <= BITS, np.log1p(-np.minimum(agree**bits, 1 - 1e-9)), 0)
                yield batch.select(["id", "label"]).filter(pa.array(missed > math.log(MISSED)))

    return vectors.select("id", "label", "v").mapInArrow(run, "id long, label long")


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Of the edges between numbered nodes, those that join something."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _exact_links(vectors: DataFrame, cosine: float) -> DataFrame:
    """Links between different roots among all vectors (id, root, label, v) of a label, in tiles of blocks; as many as join something."""

    def run(table: pa.Table) -> pa.Table:
        side, root, ids = (np.asarray(table.column(c)) for c in ("side", "root", "id"))
        x = _unit(_rows(table.column("v").combine_chunks()))
        left = np.nonzero(side == 0)[0]
        right = np.nonzero(side == 1)[0] if (side == 1).any() else left
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(left), 512):
            some = left[at : at + 512]
            i, j = np.nonzero((x[some] @ x[right].T >= cosine) & (root[some][:, None] != root[right][None, :]))
            a.append(some[i])
            b.append(right[j])
        edges = np.array(_forest(root[np.concatenate(a)], root[np.concatenate(b)]), dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(edges[:, 0]), "b": pa.array(edges[:, 1])})

    sizes = vectors.groupBy("label", F.size("v").alias("d")).agg(F.ceil(F.count(F.lit(1)) / CROWD).alias("blocks"))
    placed = vectors.withColumn("d", F.size("v")).join(sizes, ["label", "d"])
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    tiles = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda o: F.struct(F.least(block, o).alias("i"), F.greatest(block, o).alias("j"), F.when(block <= o, 0).otherwise(1).alias("side")))
    tiled = placed.withColumn("t", F.explode(tiles)).select("label", "d", "t.i", "t.j", "t.side", "root", "id", "v")
    return tiled.groupBy("label", "d", "i", "j").applyInArrow(run, "a long, b long")


def _count_links(members: DataFrame, cosine: float) -> DataFrame:
    """id and n (weights of the linked others) from tile, i, j, side, root, id, weight, v: products of blocks, no pairs leave a task."""

    def run(table: pa.Table) -> pa.Table:
        side, root, ids, weight = (np.asarray(table.column(c)) for c in ("side", "root", "id", "weight"))
        x = _unit(_rows(table.column("v").combine_chunks()))
        order = np.lexsort((side, root))
        out_id, out_n = [], []
        cut = np.nonzero(np.diff(root[order]))[0] + 1
        for some in np.split(order, cut):
            left, right = some[side[some] == 0], some[side[some] == 1]
            if len(right):
                near = x[left] @ x[right].T >= cosine
                out_id += [ids[left], ids[right]]
                out_n += [near @ weight[right], near.T @ weight[left]]
            else:
                near = x[left] @ x[left].T >= cosine
                np.fill_diagonal(near, False)
                out_id.append(ids[left])
                out_n.append(near @ weight[left])
        return pa.table({"id": pa.array(np.concatenate(out_id)), "n": pa.array(np.concatenate(out_n).astype(np.int64))})

    return members.groupBy("tile", "i", "j").applyInArrow(run, "id long, n long")


def near_vectors(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, run: int = RUN, passes: int | None = None, seed: int = 11) -> DataFrame:
    """vec_id, n_links, component_id, kept: components of vectors of equal label with a cosine of ``cosine`` or more, in doubles, whatever numbers they hold.

    Vectors of equal direction become one, with a weight. Each pass puts those of a label into the order of the concatenated bits of random
    projections, cuts it into runs that share their first bits, and compares each vector with all of its run; the links of all passes are
    united. A vector is shuffled once for each pass, and not at all for a label that is one run. The number of passes follows from that of
    the vectors of the largest label (``passes_for``). A run bounds what a pass compares, not what is found: the links within each
    component are then counted exactly, in blocks, so a crowd keeps all its links. Where vectors of a label share a direction, their
    codes agree in many bits and runs of more than ``MOST`` are split by further bits: vectors whose runs, by the bits they have, may miss
    more than ``MISSED`` of their links are compared with each other exactly, in blocks, and where they are more than ``CROWDED`` of a
    label, so are all of it; that takes the square of their number. Only a link outside these that would have joined two components
    and fell into no run is missed.

    Vectors that are null, empty or zero, or hold null or non-finite components, and those with a null label or vec_id, link with nothing
    (component_id is the vec_id). Repeated rows are others to each other: they link, and have one vec_id. Vectors of other lengths than
    the most frequent never meet them. An empty table gives an empty result. Other columns are left out.
    """
    spark = embeddings.sparkSession
    given = dict(embeddings.dtypes).get(vector)
    kind = given if given == "array<float>" else "array<double>"  # floats are half as much to move, and the same in doubles
    rows = embeddings.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label"), F.col(f"`{vector}`").cast(kind).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fit = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    # the quotients that _unit takes: equal ones have equal cosines with all others
    largest = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    direction = F.array_join(F.transform("v", lambda x: (x.cast("double") / F.col("largest")).cast("string")), ",")
    rows = rows.withColumns({"fit": fit, "largest": largest})
    rows = rows.withColumn("same", F.when(F.col("fit"), F.unhex(F.sha2(F.concat_ws(",", F.col("label").cast("string"), direction), 256)))).drop("largest")
    rows = materialize(rows, "vectors")
    with scratch():
        unique = materialize(rows.where("fit").groupBy("same").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"), F.first("label").alias("label"), F.first("v").alias("v")), "vectors-unique")
        links, crowd = [], []
        for d in [r.d for r in unique.select(F.size("v").alias("d")).distinct().collect()]:  # a row for each length
            own = unique.where(F.size("v") == d)
            counts = {r.label: r["count"] for r in own.groupBy("label").count().where(F.col("count") > MOST).collect()}  # at most one for MOST vectors
            runs = _Runs({k: bits_for(n, run) for k, n in counts.items()}, seed)
            todo = (passes or passes_for(max(counts.values()), run, cosine)) if counts else 1
            for at in range(0, todo, AT_ONCE):
                some = range(at, min(at + AT_ONCE, todo))
                runs.split(own, some)
                with scratch():
                    links.append(materialize(_pass_links(own, some, runs, cosine), "vector-links", outlive=True))
            if not counts:
                continue
            missing = materialize(_crowded(own, range(todo), runs, cosine), "vector-crowded")
            many = {r.label: r["count"] for r in missing.groupBy("label").count().collect()}  # labels with bits only
            if many:
                whole = [k for k, n in many.items() if n > CROWDED * counts[k]]
                few = own.join(missing.select("id"), "id", "left_semi")
                crowd.append(own.where(F.col("label").isin(whole)).unionByName(few.where(~F.col("label").isin(whole))) if whole else few)
        found = reduce(DataFrame.union, links) if links else spark.createDataFrame([], "a long, b long")
        roots = connected_components(found)
        if crowd:
            among = reduce(DataFrame.unionByName, crowd).join(roots, "id", "left").select("id", "label", "v", F.coalesce("root", "id").alias("root"))
            more = materialize(_exact_links(materialize(among, "vector-crowd"), cosine), "vector-more")
            if not more.isEmpty():
                roots = connected_components(found.unionByName(more))
        sizes = materialize(roots.groupBy("root").agg(F.count(F.lit(1)).alias("c")), "vector-sizes")
        members = sizes.agg(F.sum("c")).first()[0] or 0
        inside = roots.join(sizes, "root").join(unique.select("id", "weight", "v"), "id")
        # a component is dealt into at least sixteen blocks if these have LEAST vectors, so that no task has most of it
        blocks = F.when(F.col("c") <= LEAST, F.lit(1).cast("long")).otherwise(F.greatest(F.ceil(F.col("c") / BLOCK), F.least(F.lit(16).cast("long"), F.ceil(F.col("c") / LEAST))))
        block = F.pmod(F.xxhash64("id"), blocks)
        tiles = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda o: F.struct(F.least(block, o).alias("i"), F.greatest(block, o).alias("j"), F.when(block <= o, 0).otherwise(1).alias("side")))
        # components of one block share tiles, each of a few thousand vectors
        shared = F.pmod(F.xxhash64("root"), F.lit(max(1, partitions(spark) * 4, members // (2 * BLOCK))))
        tile = F.when(blocks == 1, shared).otherwise(-1 - F.abs(F.xxhash64("root") % (1 << 62)))
        tiled = inside.withColumn("t", F.explode(tiles)).select(tile.alias("tile"), "t.i", "t.j", "t.side", "root", "id", "weight", "v")
        counted = materialize(_count_links(tiled, cosine).groupBy("id").agg(F.sum("n").alias("n")), "vector-counts")
        known = unique.select("same", "id", "weight").join(roots, "id", "left").join(counted, "id", "left")
        known = known.select("same", F.coalesce("root", "id").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
        known = materialize(known, "vector-known", outlive=True)
    out = rows.select("vec_id", "same").join(known, "same", "left")
    component = F.coalesce("root", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op2_sorted_projections(spark, sf_dir: str) -> DataFrame:
    """The query: all vectors."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
