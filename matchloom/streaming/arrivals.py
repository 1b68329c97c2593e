"""Rows that arrive as a stream, matched batch by batch against a fixed master."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from matchloom.operators.rowmatch import Mapping, match_fuzzy, row_index
from matchloom.sources.intermediate import scratch


#: Row numbers of a batch begin after this many for each batch before it.
BATCH_ROWS = 1 << 40


def match_arrivals(stream: DataFrame, master: DataFrame, mapping: Mapping, dataset: str, sink: Callable[[DataFrame, int], None], checkpoint: str, threshold: float = 75) -> StreamingQuery:
    """Numbers the arriving rows, matches each batch and hands the result to ``sink`` with the batch's number; runs until the source is drained.

    A row's number is BATCH_ROWS times that of its batch, plus its place in the batch, from 1: no two rows of a stream have one number, and a
    batch that is run again gives the same numbers. What a batch writes in between is deleted when the sink is done with it.
    """
    numbered = row_index(master, "master_row_index")

    def batch(rows: DataFrame, number: int) -> None:
        with scratch():
            own = row_index(rows, "enrichment_row_index").withColumn("enrichment_row_index", F.col("enrichment_row_index") + number * BATCH_ROWS)
            sink(match_fuzzy(own, numbered, mapping, dataset, threshold), number)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
