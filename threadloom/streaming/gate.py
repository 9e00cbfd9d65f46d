"""The gate, exact deduplication and the graph over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RELAXED, Gate
from ..operators import dedup, graph
from ..operators.gate import with_reason


def gated(posts: DataFrame, text_col: str = "text", limits: Gate = RELAXED) -> DataFrame:
    """The gate has no state: the same column as in a batch."""
    return with_reason(posts, text_col, min_words=limits.post_min_words, gate=limits)


def first_texts(posts: DataFrame, time: str, text_col: str = "text", delay: str = "1 day") -> DataFrame:
    """Exact duplicates within the watermark's delay go; the state holds a digest for each text of that time."""
    keyed = posts.withWatermark(time, delay).withColumn("digest", F.sha2(dedup.normal_form(text_col), 256))
    return keyed.dropDuplicatesWithinWatermark(["digest"]).drop("digest")


def windowed_reasons(gated_posts: DataFrame, time: str, window: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Rejections by reason and time window."""
    return gated_posts.withWatermark(time, delay).groupBy(F.window(time, window), F.coalesce("reason", F.lit("ok")).alias("reason")).count()


def merge_into_graph(folder: str):
    """A foreachBatch function that keeps edges by batch: a batch that is run again overwrites its own part, so weights do not count twice."""

    def merge(typed: DataFrame, batch: int) -> None:
        graph.edge_merge(typed).write.mode("overwrite").parquet(f"{folder}/batch={batch}")

    return merge


def edges_of(parts: DataFrame) -> DataFrame:
    """The edges of all batches: the earliest batch's attributes, the sum of weights."""
    return parts.groupBy("source", "target").agg(F.min_by("relation", "batch").alias("relation"), F.min_by("evidence", "batch").alias("evidence"), F.sum("weight").alias("weight"))
