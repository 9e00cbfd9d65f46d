"""Helpers that the training-data operators share: where tables between steps live, how long texts travel, ASCII words."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import cut
from ..sources.sinks import shared_path as fresh_path

__all__ = ["BATCH_ROWS", "CHUNK", "WORD", "ascii_lower", "cut", "fresh_path", "in_fold", "map_batches", "small"]

#: Words of the contracts: runs of ASCII digits, ASCII letters and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Runs of anything but ASCII white space.
CHUNK = r"[^\x20\x09-\x0D]+"
#: Rows of an Arrow batch, so that a batch of long texts stays small.
BATCH_ROWS = 256
#: Rows of a side that may be broadcast; callers count before they hint.
BROADCAST_ROWS = 500_000


def small(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if its counted rows are few; as it is, for a shuffled join, beyond that."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. All-ASCII texts take lower(), which is the same there and faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """mapInArrow with small batches. work is called once for each batch."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)

    return df.mapInArrow(run, schema)


def in_fold(doc_id: Column) -> Column:
    """True for the held-out fifth: crc32(doc_id as text) mod 5 is 0. A null id is held out, so that nothing is learned from it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))
