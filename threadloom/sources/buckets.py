"""Tables in buckets of their key: an upsert rewrites the buckets that new rows fall into, and a manifest makes all of it visible at once."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import upsert_latest

_MANIFEST = "bucket int, buckets int, folder string"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, path: str) -> tuple[int, DataFrame] | None:
    """(version, rows of bucket, buckets, folder) of the newest version; None without one. A version is one file, which Spark's writer moves into place when it is whole."""
    try:
        found = spark.read.schema(_MANIFEST + ", version int").parquet(f"{path}/versions")
        version = found.agg(F.max("version")).first()[0]
    except AnalysisException:
        return None
    return None if version is None else (version, found.where(F.col("version") == version).drop("version"))


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of its newest version, or an earlier one."""
    found = manifest(spark, path)
    if found is None:
        raise FileNotFoundError(f"no version of a table at {path}")
    rows = found[1] if version is None else spark.read.schema(_MANIFEST + ", version int").parquet(f"{path}/versions").where(F.col("version") == version)
    return _read(spark, path, rows)


def _read(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    # as many folders as the table has buckets at most
    folders = [f"{path}/rows/{r.folder}/bucket={r.bucket}" for r in rows.collect()]
    return spark.read.parquet(*folders)


def create(rows: DataFrame, path: str, keys: list[str], buckets: int = 64) -> None:
    """Writes a first version. buckets stays as it is; choose it so that a bucket is some hundred MB."""
    _write(rows, path, keys, buckets, None, 0)


def upsert(new: DataFrame, path: str, keys: list[str], merge: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
    """Merges new rows into the table: merge(old, new) gets the rows of the buckets that new rows fall into, and all new rows; its result takes the place of these buckets. The others stay in the
    files that they are in. Returns the version. One writer at a time; what reads an older version goes on reading it, and a run that dies changes nothing that is read.
    """
    spark = new.sparkSession
    found = manifest(spark, path)
    if found is None:
        raise FileNotFoundError(f"no version of a table at {path}")
    version, rows = found
    buckets = rows.first().buckets
    touched = new.select(bucket_of(keys, buckets).alias("bucket")).distinct()  # no more than the table has buckets
    old = rows.join(F.broadcast(touched), "bucket", "left_semi")
    before = _read(spark, path, old) if not old.isEmpty() else spark.createDataFrame([], _read(spark, path, rows).schema)
    _write(merge(before, new), path, keys, buckets, rows, version + 1)
    return version + 1


def _write(rows: DataFrame, path: str, keys: list[str], buckets: int, before: DataFrame | None, version: int) -> None:
    spark, folder = rows.sparkSession, uuid.uuid4().hex
    placed = rows.withColumn("bucket", bucket_of(keys, buckets))
    placed.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/rows/{folder}")
    here = spark.read.parquet(f"{path}/rows/{folder}").select("bucket").distinct()
    now = here.select(F.col("bucket").cast("int"), F.lit(buckets).alias("buckets"), F.lit(folder).alias("folder"))
    if before is not None:
        now = before.join(here.select(F.col("bucket").cast("int").alias("bucket")), "bucket", "left_anti").select("bucket", "buckets", "folder").unionByName(now)
    now.coalesce(1).write.parquet(f"{path}/versions/version={version}")


def merge_by(keys: list[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """A merge in which new rows take the place of old ones with the same keys."""
    return lambda old, new: old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def latest_batches(old: DataFrame, new: DataFrame) -> DataFrame:
    """The merge of extractions: a batch that comes again takes the place of what it gave before."""
    return upsert_latest(old, new)
