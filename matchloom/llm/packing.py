"""Packing by concatenate and cut: global offsets by two prefix sums, then windows of fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.llm.shared import materialize, only, slices
from matchloom.llm.tokens import SLICE, load

#: The id that ends each document.
END_ID = 1


def tokenize(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit, with the end id), n_ids, part and before: the ids before it in its partition.

    The first pass. What it returns must be written before it is used: partition numbers are those of this run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bpe, part, total = load(vocabulary), TaskContext.get().partitionId(), 0
        end = pa.scalar(np.array([end_id], dtype="<u4").tobytes(), pa.large_binary())
        for batch in slices(batches, limit=SLICE):
            found = pc.binary_join_element_wise(bpe.encode_column(batch.column(1)), end, pa.scalar(b"", pa.large_binary()))
            counts = np.asarray(pc.binary_length(found), dtype=np.int64) // 4
            before = total + np.cumsum(counts) - counts
            total += int(counts.sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), found.cast(pa.binary()), pa.array(counts), pa.array(np.full(len(found), part, np.int64)), pa.array(before)], names=["doc_id", "ids", "n_ids", "part", "before"])

    return only(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, ids binary, n_ids long, part long, before long")


def pack(docs: DataFrame, vocabulary: str, length: int = 2048, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids (binary), doc_tokens, sequence_id, offset.

    The ids of all documents, each with ``end_id`` after it, form one stream, cut each ``length`` ids; only the last sequence can be
    shorter. Null and empty texts give one piece with the end id alone. A document over several windows has a piece in each.
    Repeated rows are packed as often as they come; an empty table gives no piece. Two passes: the first writes the ids and the
    totals of partitions, whose prefix sums (one row for each partition) are all that is broadcast; the second cuts. Texts of any length
    are taken whole; batches of both passes are cut by bytes. Other columns of ``docs``, whatever their names, are left out.
    """
    ids = materialize(tokenize(docs, vocabulary, end_id), "pack-ids")
    totals = ids.groupBy("part").agg(F.sum("n_ids").alias("n"))
    base = totals.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column="ids", limit=SLICE):
            doc, raws, at = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            rows: tuple[list, ...] = ([], [], [], [], [], [], [])
            for d, raw, first in zip(doc, raws, at, strict=True):
                n, start = len(raw) // 4, 0
                while start < n:
                    place = first + start
                    size = min(n - start, length - place % length)
                    for out, x in zip(rows, (d, start, size, raw[4 * start : 4 * (start + size)], n, place // length, place % length), strict=True):
                        out.append(x)
                    start += size
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    placed = ids.join(F.broadcast(base), "part").select("doc_id", "ids", (F.col("base") + F.col("before")).alias("at"))
    return placed.mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def pieces(docs: DataFrame, vocabulary: str, length: int = 2048) -> DataFrame:
    """The rows of ``pack`` with the CRC-32 of the ids in place of the ids."""
    return pack(docs, vocabulary, length).withColumn("ids_crc32", F.crc32("ids")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op7_concatenate_and_cut(spark, sf_dir: str) -> DataFrame:
    """The query: all documents in sequences of 2048 ids."""
    import public_tokenizers

    return pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
