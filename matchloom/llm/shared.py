"""Helpers of the operators: tables written to cut lineage, columns by name, and passes over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.sources.intermediate import delete, materialize, new_path, own_rows, partitions, scratch, shared_folder, write_by

__all__ = ["SPACES", "SPACE_CLASS", "delete", "materialize", "new_path", "only", "own_rows", "partitions", "scratch", "shared_folder", "slices", "strings", "text_bytes", "write_by"]

#: White space of the word pattern ``[^\x20\x09-\x0D]+``.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE_CLASS = r"[\x20\x09-\x0D]"

def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named columns, cast: other columns, whatever their names, never reach an operator's plan."""
    return df.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in columns.items()])


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that ``column`` (strings, bytes, or lists of numbers) has about ``limit`` bytes in each piece; a longer value stays alone and whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column_ = batch.column(batch.schema.get_field_index(column))
        listed = pa.types.is_list(column_.type) or pa.types.is_large_list(column_.type)
        sizes = np.asarray(pc.fill_null((pc.list_value_length if listed else pc.binary_length)(column_), 0).cast(pa.int64())) * (8 if listed else 1)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated UTF-8 bytes of a string array (null: empty) and the n + 1 offsets."""
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def strings(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]
