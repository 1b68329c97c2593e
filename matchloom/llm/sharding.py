"""Sharding by histogram sort: exact byte counts under probes, refined until the splitters are good, then one exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.llm.shared import materialize

#: Bits that one round of refinement resolves.
ROUND_BITS = 8
#: Sub-keys by which one very heavy key is divided, at least.
TIES_BITS = 12
#: A cell's rows are numbered in one task: bytes that it may have, or this power of two's part of all bytes if that is more, so that the
#: histogram stays within some thousand cells.
LEAF_BYTES, LEAF_BITS = 64 << 20, 13


class _Trie:
    """The probes: cells of the key space, each split into 2**ROUND_BITS where its bytes are too many for the tolerance."""

    def __init__(self, bits: int):
        self.top = -(-bits // ROUND_BITS)  # levels
        self.tables: list[list[int]] = []  # of each refined cell: its children's numbers; -1 - n: the table n one level below
        self.leaves: list[tuple[int, int, int, int]] = []  # first key, shift, bytes, rows; in the order of keys

    def shift(self, level: int) -> int:
        return (self.top - 1 - level) * ROUND_BITS


def _count(table: DataFrame, shift: int, parents: list[int] | None) -> dict[int, tuple[int, int]]:
    """Exact bytes and rows of each non-empty cell; at most len(parents) << ROUND_BITS rows reach the driver."""
    if parents is not None:
        table = table.where(F.shiftright("key", shift + ROUND_BITS).isin(parents))
    found = table.groupBy(F.shiftright("key", shift).alias("cell")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
    return {r.cell: (r.bytes, r.rows) for r in found}


def _refine(table: DataFrame, bits: int, total: int, shards: int, tolerance: float) -> tuple[_Trie, bool]:
    """Rounds of counting. A cell is refined while it is heavier than the tolerance and a splitter falls inside, or than a shard's 16th or one task's bytes.

    Also tells whether a single key stays heavier than twice that.
    """
    trie, width = _Trie(bits), 1 << ROUND_BITS
    most = min(total / shards / 16, max(LEAF_BYTES, total >> LEAF_BITS))
    slack = max(1.0, tolerance * total / shards)
    counts = [_count(table, trie.shift(0), None)]
    heavy = False

    def wanted(level: int, cell: int, below: int) -> bool:
        size = counts[level][cell][0]
        inside = int(below * shards // total) != int((below + size) * shards // total)
        return (inside and size > slack) or size > most

    opened: list[list[int]] = []
    parents, starts = [None], {None: 0}
    for level in range(trie.top):
        below, refine, begins = 0, [], {}
        by_parent: dict = {}
        for cell in sorted(counts[level]):
            by_parent.setdefault(None if level == 0 else cell >> ROUND_BITS, []).append(cell)
        for parent in parents:
            below = starts[parent]
            for cell in by_parent.get(parent, []):
                if wanted(level, cell, below):
                    refine.append(cell)
                    begins[cell] = below
                below += counts[level][cell][0]
        if level == trie.top - 1:
            heavy = any(size > 2 * most and rows > 1 for size, rows in counts[level].values())
            opened.append([])
            break
        opened.append(refine)
        if not refine:
            break
        parents, starts = refine, begins
        counts.append(_count(table, trie.shift(level + 1), refine))

    def build(level: int, parent: int | None) -> int:
        mine = len(trie.tables)
        trie.tables.append([])
        rows = []
        for k in range(width):
            cell = k if parent is None else (parent << ROUND_BITS) + k
            if level < len(opened) - (level == trie.top - 1) and cell in open_sets[level]:
                rows.append(-1 - build(level + 1, cell))
            else:
                rows.append(len(trie.leaves))
                trie.leaves.append((cell << trie.shift(level), trie.shift(level), *counts[level].get(cell, (0, 0))))
        trie.tables[mine] = rows
        return mine

    open_sets = [set(x) for x in opened]
    build(0, None)
    return trie, heavy


def _constants(values: list[int]) -> Column:
    """A constant array; Catalyst folds it into one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _leaf(trie: _Trie, key: Column) -> Column:
    """The number of the leaf that holds the key, by look-ups in constant arrays."""
    flat = _constants([x for t in trie.tables for x in t])
    at = F.get(flat, F.shiftright(key, trie.shift(0)).cast("int"))
    for level in range(1, trie.top):
        if not any(x < 0 for t in trie.tables for x in t):
            break
        child = F.shiftright(key, trie.shift(level)).bitwiseAND(F.lit((1 << ROUND_BITS) - 1)).cast("int")
        at = F.when(at >= 0, at).otherwise(F.get(flat, ((-1 - at) * (1 << ROUND_BITS) + child).cast("int")))
    return at.cast("int")


def shard_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 24, tolerance: float = 0.002) -> DataFrame:
    """Deals rows to ``shards`` of nearly equal bytes, in the order of ``key``, with one exchange of the rows.

    Adds ``size`` (UTF-8 bytes of ``text`` plus 8), ``shard`` and ``slot`` (gapless from 0 within the shard).
    Native: DataFrame functions only. The driver holds the histogram, of at most some thousand cells; rows are numbered by cell, and a cell
    has at most ``LEAF_BYTES``, or a 2**-LEAF_BITS part of all bytes if that is more.
    Null keys sort first; null and empty texts have no bytes; texts of any length stay whole. Equal keys, and so repeated rows, may be
    parted: a key too heavy for one cell is divided by a row number into sub-keys. An empty table gives an empty result. Other columns
    of ``docs`` ride along, except those named like an added one, which are replaced.
    """
    docs = docs.drop("size", "shard", "slot")
    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long") + 8
    raw = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(-(1 << 63)))
    narrow = materialize(docs.select(raw.alias("raw"), size.alias("size")), "shard-keys")
    low, high, total, rows = narrow.agg(F.min("raw"), F.max("raw"), F.sum("size"), F.count(F.lit(1))).first()
    if not rows:
        return docs.withColumns({"size": size, "shard": F.lit(0), "slot": F.lit(0).cast("long")})
    drop = 0 if high - low < 1 << 50 else (high - low).bit_length() - 50  # so that sub-keys fit

    def place(x: Column) -> Column:
        return (F.shiftright(x, drop) - F.lit(low >> drop)) if drop else x - F.lit(low)

    bits = max(1, ((high >> drop) - (low >> drop)).bit_length())
    trie, heavy = _refine(narrow.select(place(F.col("raw")).alias("key"), "size"), bits, total, shards, tolerance)
    keyed = docs.withColumns({"_key": place(raw), "size": size})
    if heavy:  # some keys are too heavy to stay whole: number the rows, once and for all
        docs = materialize(docs.withColumn("_tie", F.monotonically_increasing_id()), "shard-ties")
        ties = min(62 - bits, max(TIES_BITS, (total // LEAF_BYTES).bit_length() + 2))
        tie = F.pmod(F.xxhash64("_tie"), F.lit(1 << ties))
        keyed = docs.withColumns({"_key": F.shiftleft(place(raw), ties) + tie, "size": size}).drop("_tie")
        trie, _ = _refine(keyed.select(F.col("_key").alias("key"), "size"), bits + ties, total, shards, tolerance)
    shard_of, offset_of, below, counts = [], [], 0, [0] * shards
    for _, _, heavy_bytes, n in trie.leaves:
        s = min(shards - 1, max(0, (2 * below + heavy_bytes) * shards // (2 * total)))
        shard_of.append(s)
        offset_of.append(counts[s])
        counts[s] += n
        below += heavy_bytes
    leaf = keyed.withColumn("_leaf", _leaf(trie, F.col("_key")))
    ranked = leaf.withColumn("_rank", F.row_number().over(W.partitionBy("_leaf").orderBy("_key")))
    shard = F.get(_constants(shard_of), F.col("_leaf")).cast("int")
    offset = F.get(_constants(offset_of), F.col("_leaf"))
    return ranked.withColumns({"shard": shard, "slot": offset + F.col("_rank") - 1}).drop("_key", "_leaf", "_rank")


def op10_histogram_shards(spark, sf_dir: str) -> DataFrame:
    """The query: all documents in 24 shards of nearly equal bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = shard_documents(docs)
    return out.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
