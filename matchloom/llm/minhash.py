"""Near-duplicates of word shingles: b-bit MinHash signatures, a multi-index Hamming join, links confirmed on full sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.components import connected_components
from matchloom.llm.shared import materialize, only, partitions, scratch, slices, text_bytes

WORDS = 5
#: Positions of a signature, its chunks, and the errors enumerated within a chunk. Pairs that differ in fewer than
#: CHUNKS * (ERRORS + 1) positions have a chunk with at most ERRORS of them, so they meet for certain.
POSITIONS, CHUNKS, ERRORS = 64, 16, 1
DISTANCE = CHUNKS * (ERRORS + 1) - 1
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Classes of a key, and documents of a neighbourhood, in one block, and their bytes: two blocks are compared in one task.
BLOCK, SET_BLOCK, BLOCK_BYTES = 1024, 160, 4 << 20

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20240501)
_SALT = _rng.integers(1, 1 << 63, POSITIONS, dtype=np.uint64) | _U(1)
_XOR = _rng.integers(0, 1 << 63, POSITIONS, dtype=np.uint64)
_PLACE = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) | _U(1)
#: Places of a word whose byte hashes are kept in a table.
_SHORT = 64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection that scatters 64 bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_hash(place: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """A hash of a byte (A-Z as a-z) at a place of its word, without structure: sums of them don't cancel for any pattern of letters."""
    lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte).astype(_U)
    return _mix(_mix(place.astype(_U) * _U(256) + lower + _SALT[0]) ^ _XOR[0])


_BYTES = _byte_hash(np.repeat(np.arange(_SHORT), 256), np.tile(np.arange(256), _SHORT))


def shingle_sets(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, concatenated, and the n + 1 offsets."""
    raw, offsets = text_bytes(column)
    n = len(offsets) - 1
    filled = ~_SPACE[raw]
    first = filled.copy()  # a word's first byte
    if len(raw):
        first[1:] &= ~filled[:-1]
        starts_text = offsets[:-1][offsets[:-1] < len(raw)]
        first[starts_text] = filled[starts_text]
    begin = np.nonzero(first)[0]
    if not len(begin):
        return np.zeros(0, _U), np.zeros(n + 1, np.int64)
    number = np.cumsum(first) - 1  # of the word, for the bytes of words
    where = np.nonzero(filled)[0]
    inside = where - begin[number[where]]
    # each byte's hash depends on its place, and a word's hash is their sum: tabulation, not a polynomial
    value = _BYTES[np.minimum(inside, _SHORT - 1) * 256 + raw[where]]
    long = np.nonzero(inside >= _SHORT)[0]
    value[long] = _byte_hash(inside[long], raw[where[long]].astype(np.int64))
    word = np.add.reduceat(value, np.searchsorted(where, begin))
    word = _mix(word)
    at = np.searchsorted(begin, offsets)  # words before each text
    counts = np.diff(at)
    total = np.zeros(len(word), _U)
    size = np.minimum(counts, words)
    text_of = np.repeat(np.arange(n), counts)
    left = at[1:][text_of] - np.arange(len(word))  # words from here to the end of the text
    for k in range(words):
        use = np.minimum(size[text_of], words) > k
        shifted = np.zeros(len(word), _U)
        shifted[: max(0, len(word) - k)] = word[k:]
        total += np.where(use, shifted * _PLACE[k], _U(0))
    keep = left >= size[text_of]
    value, owner = _mix(total[keep] + size[text_of][keep].astype(_U)), text_of[keep]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(n + 1))


def signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The low 16 bits of the least of each hash function over each set; rows of empty sets are zero."""
    out = np.zeros((len(offsets) - 1, POSITIONS), np.uint16)
    some = np.diff(offsets) > 0
    if some.any():
        begin = offsets[:-1][some]
        for k in range(POSITIONS):
            least = np.minimum.reduceat(((values ^ _XOR[k]) * _SALT[k]) >> _U(16), begin)
            out[some, k] = (_mix(least) >> _U(48)).astype(np.uint16)
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, n (size of the set), bytes (of the text), same (digest of the set) and sig, from doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=2 << 20):
            values, offsets = shingle_sets(batch.column(1))
            raw, sig = values.tobytes(), signatures(values, offsets)
            ends = (offsets * 8).tolist()
            same = [_digest(raw[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(np.diff(text_bytes(batch.column(1))[1])), pa.array(same, pa.binary()), pa.array([x.tobytes() for x in sig], pa.binary())], names=["doc_id", "n", "bytes", "same", "sig"])

    return docs.mapInArrow(run, "doc_id long, n long, bytes long, same binary, sig binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return text_bytes(column)[0].view(np.uint16).reshape(-1, POSITIONS)


def index_keys(sets: DataFrame, key: str = "id") -> DataFrame:
    """key and id: for each chunk of a signature and each place of an allowed error, the hash of the rest of the chunk."""
    width = POSITIONS // CHUNKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                sig = _matrix(batch.column(1)).astype(_U).reshape(-1, CHUNKS, width)
                keys = []
                for wild in range(width):
                    rest = [sig[:, :, k] << _U(16 * i) for i, k in enumerate(k for k in range(width) if k != wild)]
                    label = (np.arange(CHUNKS, dtype=_U) * _U(width) + _U(wild)) << _U(48)
                    keys.append(_mix(np.bitwise_or.reduce(rest) | label[None, :]))
                flat = np.stack(keys, axis=2).reshape(-1).view(np.int64)
                ids = np.repeat(np.asarray(batch.column(0)), CHUNKS * width)
                yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(ids)], names=["key", "id"])

    return sets.select(key, "sig").mapInArrow(run, "key long, id long")


def _groups(near: np.ndarray) -> np.ndarray:
    """The first node of each node's component, from a symmetric matrix of links."""
    root = np.full(len(near), -1)
    for seed in range(len(near)):
        if root[seed] < 0:
            front = np.array([seed])
            root[seed] = seed
            while len(front):
                front = np.nonzero(near[front].any(axis=0) & (root < 0))[0]
                root[front] = seed
    return root


def _whole(near: np.ndarray, left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """The symmetric matrix of all n rows from that of the left against the right ones."""
    out = np.zeros((n, n), bool)
    out[np.ix_(left, right)] = near
    return out | out.T


def _sides(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows to compare with each other: those of both blocks of a tile, or all of a single block."""
    left, right = np.nonzero(side == 0)[0], np.nonzero(side == 1)[0]
    return (left, right) if len(right) else (left, left)


def _by_signature(sig: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Which rows of a key are within the signature distance."""
    left, right = _sides(side)
    far = np.zeros((len(left), len(right)), np.uint8)
    for k in range(POSITIONS):
        far += sig[left, k][:, None] != sig[right, k][None, :]
    return _whole(far <= DISTANCE, left, right, len(sig))


def _by_sets(sets: list[np.ndarray], side: np.ndarray, percent: int) -> np.ndarray:
    """Which rows have full sets that overlap enough: the incidence of shared shingles, multiplied some thousand shingles at a time."""
    n = np.array([len(x) for x in sets])
    row = np.repeat(np.arange(len(sets)), n)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    row, column = row[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    left, right = _sides(side)
    both = np.zeros((len(left), len(right)), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, width, 4096):
        a, z = np.searchsorted(column, [at, at + 4096])
        there = np.zeros((len(sets), min(4096, width - at)), np.float32)
        there[row[a:z], column[a:z] - at] = 1
        both += there[left] @ there[right].T
    both = both.astype(np.int64)
    near = 100 * both >= percent * (n[left][:, None] + n[right][None, :] - both)
    return _whole(near & (both > 0), left, right, len(sets))


def _in_tiles(members: DataFrame, group: str, total: int, block_rows: int, judge, column: str, same: str | None = None) -> DataFrame:
    """Edges (a, b) that join the rows of each group as its links do; never more than the rows of its tiles.

    Rows come with the rows (n) and bytes of their group; ``total`` are the bytes of all. A group of more than ``block_rows`` rows or
    BLOCK_BYTES is dealt into blocks, and each two blocks make a tile of their own; smaller groups share tiles, as many as their bytes ask
    for. ``judge`` gets the cells of ``column`` of a group and their sides, and gives the rows that count and the matrix of their links;
    with ``same`` it also gets that column's cells.
    """
    shared = max(8 * partitions(members.sparkSession), -(-total // BLOCK_BYTES))
    blocks = F.greatest(F.ceil(F.col("n") / block_rows), F.ceil(F.col("bytes") / BLOCK_BYTES), F.lit(1).cast("long"))
    block = F.pmod(F.xxhash64("id"), F.col("_blocks"))
    tiles = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1), lambda o: F.struct(F.least(block, o).alias("i"), F.greatest(block, o).alias("j"), F.when(block <= o, 0).otherwise(1).alias("side")))
    tile = F.when(F.col("_blocks") == 1, F.pmod(F.xxhash64(group), F.lit(shared))).otherwise(F.xxhash64(group, F.lit(1)))
    more = [same] if same else []
    tiled = members.withColumn("_blocks", blocks).withColumn("t", F.explode(tiles)).select(tile.alias("tile"), "t.i", "t.j", "t.side", F.col(group).alias("group"), "id", column, *more)

    def run(table: pa.Table) -> pa.Table:
        number, side, ids = (np.asarray(table.column(c)) for c in ("group", "side", "id"))
        order = np.lexsort((ids, number))
        cells = [table.column(c).combine_chunks() for c in (column, *more)]
        out: list[np.ndarray] = []
        for some in np.split(order, np.nonzero(np.diff(number[order]))[0] + 1):
            if len(some) > 1:
                good, near = judge(*[c.take(pa.array(some)) for c in cells], side[some])
                some = some[good]
                root = _groups(near)
                tied = root != np.arange(len(some))
                out.append(np.stack([ids[some[root[tied]]], ids[some[tied]]], axis=1))
        pairs = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return tiled.groupBy("tile", "i", "j").applyInArrow(run, "a long, b long")


def _judge_signatures(cells: pa.Array, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.arange(len(side)), _by_signature(_matrix(cells), side)


def _judge_texts(percent: int):
    """Rows count whose text has the digest of their class, each digest once; all rows if no digest is given."""

    def judge(cells: pa.Array, *rest) -> tuple[np.ndarray, np.ndarray]:
        same, side = rest[:-1], rest[-1]
        values, offsets = shingle_sets(cells)
        sets, known, good = np.split(values, offsets[1:-1]), set(), []
        if not same:
            return np.arange(len(sets)), _by_sets(sets, side, percent)
        for k, (x, want) in enumerate(zip(sets, same[0].to_pylist(), strict=True)):
            if want not in known and _digest(x.tobytes()) == want:
                known.add(want)
                good.append(k)
        return np.array(good, dtype=np.int64), _by_sets([sets[k] for k in good], side[good], percent) if len(good) > 1 else np.zeros((len(good),) * 2, bool)

    return judge


def _digest(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: components of documents whose sets of five-word shingles overlap by ``percent`` or more.

    1. Equal sets become one class, known by its least doc_id.
    2. Classes meet by the keys of the multi-index Hamming join; those of a key are compared by signature. What the close pairs join is a
       neighbourhood: no pair within the signature distance leaves it.
    3. In each neighbourhood the full sets of all pairs are intersected, and the links join components, named by their least doc_id.
    Keys and neighbourhoods are compared within tasks, in blocks of bounded rows and bytes; a task gives at most as many edges as it has
    rows, so no pairs of a crowd are ever written or shuffled. Comparing a neighbourhood of n different sets still takes n * n / 2
    intersections, over (n / SET_BLOCK) ** 2 / 2 tiles. A pair at just 75 % is beyond the signature distance with a probability of about 1e-5.

    Null and empty texts have empty sets and link with nothing; so do rows with a null doc_id, whose component_id is null. Texts of any length
    are taken whole. Repeated rows give repeated results; different texts with one doc_id each have their own links, and one name.
    An empty table gives an empty result. Other columns, whatever their names, are left out.
    """
    docs = only(docs, **{doc_id: "long", text: "string"}).toDF("doc_id", "text")
    sets = materialize(sketch(docs), "minhash-sets")
    with scratch():
        classes = sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("same").agg(F.min("doc_id").alias("first"), F.max("bytes").alias("bytes"), F.first("sig").alias("sig"))
        classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()), "minhash-classes")
        # a class is known by its least doc_id; where some doc_id has several texts, by a number, and its text by the digest
        told = sets.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "same").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
        several = not told.where("n > 1").isEmpty()
        classes = classes if several else classes.withColumn("id", F.col("first"))
        same = ["same"] if several else []
        keys = index_keys(classes)
        shared = materialize(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "minhash-shared", narrow=True)
        met = keys.join(shared, "key").join(classes.select("id", "sig"), "id").withColumn("bytes", F.col("n") * 2 * POSITIONS)
        total = (shared.agg(F.sum("n")).first()[0] or 0) * 2 * POSITIONS
        close = _in_tiles(met, "key", total, BLOCK, _judge_signatures, "sig")
        around = connected_components(materialize(close.distinct(), "minhash-close", narrow=True))
        sizes = classes.select("id", "bytes").join(around, "id").groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
        sizes = materialize(sizes, "minhash-sizes", narrow=True)
        # a plain table of two numbers, so that Spark can broadcast it, and leave the texts where they are, if its size allows
        fetch = classes.select("id", "first", "same").join(around, "id") if several else around.withColumn("first", F.col("id"))
        texts = docs.join(fetch, docs["doc_id"] == F.col("first")).join(sizes, "root").select("id", "root", "n", "bytes", "text", *same)
        links = _in_tiles(texts, "root", sizes.agg(F.sum("bytes")).first()[0] or 0, SET_BLOCK, _judge_texts(percent), "text", *same)
        root = connected_components(materialize(links.distinct(), "minhash-links", narrow=True))
        named = classes.select("same", "id", "first").join(root, "id", "left").select("same", "first", F.coalesce("root", "id").alias("component"))
        if several:
            least = named.groupBy("component").agg(F.min("first").alias("least"))
            named = named.join(least, "component").select("same", F.col("least").alias("component"))
        of_class = materialize(named.select("same", "component"), "minhash-of-class", outlive=True)
    out = sets.select("doc_id", "n", "same").join(of_class, "same", "left")
    lonely = F.col("n") == 0
    component = F.when(F.col("doc_id").isNotNull(), F.when(lonely, F.col("doc_id")).otherwise(F.col("component")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op1_minhash(spark, sf_dir: str) -> DataFrame:
    """The query: all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
