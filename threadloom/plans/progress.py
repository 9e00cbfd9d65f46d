"""How far a run of batches came: a one-row table, committed by Spark."""

from __future__ import annotations

import logging
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def save(spark: SparkSession, path: str, last_index: int, total: int) -> None:
    row = spark.createDataFrame([(last_index, total)], "last_processed_index int, total_batches int")
    row.withColumn("timestamp", F.current_timestamp()).write.mode("overwrite").parquet(path)


def next_index(spark: SparkSession, path: str) -> int:
    """The batch to go on with; 0 if nothing is there, or nothing that can be read (which is logged)."""
    try:
        found = spark.read.parquet(path).agg(F.max("last_processed_index")).first()[0]
    except AnalysisException:
        return 0
    except (PySparkException, Py4JJavaError):
        log.warning("the progress table at %s cannot be read; the run starts at 0", path, exc_info=True)
        return 0
    return 0 if found is None else found + 1


def left_over(batches: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    return batches.where(F.col("batch_index") >= next_index(spark, path))


def clear(spark: SparkSession, path: str) -> None:
    """An empty table: the next run starts at 0."""
    spark.createDataFrame([], "last_processed_index int, total_batches int, timestamp timestamp").write.mode("overwrite").parquet(path)


def run(batches: DataFrame, step: Callable[[DataFrame], None], path: str, *, at_once: int = 100) -> tuple[int, Exception | None]:
    """Runs step over batches in order of batch_index, `at_once` of them at a time, from where an earlier run stopped. Progress is saved after each; the first failure ends the
    run and is logged, and what was done before it stays done. Returns the index to go on with and the failure, if there was one; the step should overwrite what it writes for a batch.
    """
    spark = batches.sparkSession
    last = batches.agg(F.max("batch_index")).first()[0]
    at = next_index(spark, path)
    while last is not None and at <= last:
        upto = min(at + at_once - 1, last)
        try:
            step(batches.where(F.col("batch_index").between(at, upto)))
        except Exception as e:
            log.exception("batches %d to %d failed; a run goes on from %d", at, upto, at)
            return at, e
        save(spark, path, upto, last + 1)
        at = upto + 1
    return at, None
