"""A backend that is a service: several requests in flight, a bounded rate, retries with growing delays, and failures as rows that a later run asks again."""

from __future__ import annotations

import random
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from .backends import Backend


class Throttled(Exception):
    """The service asks to wait; `after` seconds, if it says so."""

    def __init__(self, after: float | None = None):
        super().__init__(f"throttled, after {after}")
        self.after = after


@dataclass(frozen=True)
class Limits:
    """tasks ask at once, each with `in_flight` requests; `rate` requests a second in all (None: as fast as answers come), of which a task may save up `burst`; a request is tried `attempts` times,
    with delays that double from `delay` up to `longest` and vary by chance."""

    tasks: int = 8
    in_flight: int = 8
    rate: float | None = None
    burst: int = 1
    attempts: int = 4
    delay: float = 1.0
    longest: float = 60.0


class Bucket:
    """A token bucket that threads share. A throttled request stops all until its time is over."""

    def __init__(self, rate: float | None, burst: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.burst, self.clock, self.sleep = rate, max(1, burst), clock, sleep
        self.tokens, self.at, self.closed_until = float(self.burst), clock(), 0.0
        self.lock = threading.Lock()

    def take(self) -> None:
        while True:
            with self.lock:
                now = self.clock()
                wait = self.closed_until - now
                if wait <= 0:
                    if self.rate is None:
                        return
                    self.tokens = min(float(self.burst), self.tokens + (now - self.at) * self.rate)
                    self.at = now
                    if self.tokens >= 1 - 1e-9:  # sums of small waits fall short by a rounding
                        self.tokens -= 1
                        return
                    wait = (1 - self.tokens) / self.rate
            self.sleep(wait)

    def close_for(self, seconds: float) -> None:
        with self.lock:
            self.closed_until = max(self.closed_until, self.clock() + seconds)


def asked(backend: Backend, system: str, user: str, limits: Limits, bucket: Bucket) -> tuple[str | None, str | None, int]:
    """(answer, error, attempts) of one request; the answer is null if every attempt failed."""
    error = None
    for attempt in range(1, limits.attempts + 1):
        bucket.take()
        try:
            return backend.generate(system, user), None, attempt
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
            pause = min(limits.longest, limits.delay * 2 ** (attempt - 1)) * random.uniform(0.5, 1.0)
            if isinstance(e, Throttled):
                bucket.close_for(pause if e.after is None else e.after)
            elif attempt < limits.attempts:
                bucket.sleep(pause)
    return None, error, limits.attempts


def answered(rows: DataFrame, system: Column, user: Column, backend: Backend, limits: Limits | None = None) -> DataFrame:
    """rows with answer, error and attempts; none is lost, and a failed request has a null answer and its last error. Rows go to `tasks` tasks; the order of rows within a task stays. A null prompt
    is asked as an empty one. backend must be picklable, and may be called from several threads of a task."""
    limits = limits or Limits()
    staged = rows.withColumn("__system", F.coalesce(system, F.lit(""))).withColumn("__user", F.coalesce(user, F.lit(""))).repartition(limits.tasks)
    schema = StructType([*rows.schema.fields, StructField("answer", StringType()), StructField("error", StringType()), StructField("attempts", IntegerType())])

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket = Bucket(None if limits.rate is None else limits.rate / limits.tasks, limits.burst)
        with ThreadPoolExecutor(limits.in_flight) as pool:
            for pdf in batches:
                found = list(pool.map(lambda p: asked(backend, p[0], p[1], limits, bucket), zip(pdf["__system"], pdf["__user"])))
                out = pdf.drop(columns=["__system", "__user"])
                yield out.assign(answer=[f[0] for f in found], error=[f[1] for f in found], attempts=[f[2] for f in found])

    return staged.mapInPandas(ask, schema)


def run(rows: DataFrame, key: str, system: Column, user: Column, backend: Backend, path: str, limits: Limits | None = None) -> DataFrame:
    """Asks for the rows that have no answer yet and adds what it finds to the table at `path`; returns the answers of all rows (key, answer, attempts), one for each key.

    The table grows by a part for each run. Failed rows are in it with their errors (`failures`), and the next run asks them again; a run that dies leaves the parts of those before it.
    """
    spark = rows.sparkSession
    schema = f"{key} {rows.schema[key].dataType.simpleString()}, answer string, error string, attempts int"
    try:
        done = spark.read.schema(schema).parquet(path).where("answer IS NOT NULL").select(F.col(key).alias("__done")).distinct()
        left = rows.join(done, F.col(key) == F.col("__done"), "left_anti")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        left = rows
    found = answered(left, system, user, backend, limits).select(key, "answer", "error", "attempts")
    found.write.mode("append").parquet(path)
    whole = spark.read.schema(schema).parquet(path).where("answer IS NOT NULL")
    return whole.groupBy(key).agg(F.min_by("answer", "attempts").alias("answer"), F.min("attempts").alias("attempts"))


def failures(rows: DataFrame, key: str, path: str) -> DataFrame:
    """key, error, attempts: the rows that no run got an answer for, with the error of their longest try (ties by text)."""
    found = rows.sparkSession.read.parquet(path)
    good = found.where("answer IS NOT NULL").select(F.col(key).alias("__done")).distinct()
    bad = found.where("answer IS NULL").join(good, F.col(key) == F.col("__done"), "left_anti")
    return bad.groupBy(key).agg(F.max(F.struct("attempts", "error")).alias("m"), F.sum("attempts").alias("attempts")).select(key, "m.error", "attempts")
