"""Duplicates among accepted texts."""

from __future__ import annotations

import hashlib
from functools import reduce

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import RELAXED, Gate
from ..functions import text as T
from ..sources.sinks import cut
from .similarity import Close, similar_pairs

__all__ = ["Close", "exact_dedup", "fuzzy_dedup", "normal_form", "place_of", "similar_pairs", "walked"]


def normal_form(text_col: str):
    return F.lower(T.strip(F.col(text_col)))


def exact_dedup(rows: DataFrame, text_col: str = "text", seq: str = "seq") -> DataFrame:
    """The rows whose lower-cased, stripped text no row of smaller seq has. Sums up by text digest first, so a text that a third of all rows
    share costs a row for each task, not a task for all of them."""
    first = rows.select(F.sha2(normal_form(text_col), 256).alias("__digest"), F.col(seq).alias("__first")).groupBy("__digest").agg(F.min("__first").alias("__first"))
    return rows.join(first.select("__first"), F.col(seq) == F.col("__first"), "left_semi")


#: What the walk says of a text: kept, an exact copy of a kept one, similar to one of the last kept ones, or below a head that was not kept and so never looked at.
KEPT, EXACT, FUZZY, PASSED_OVER = 0, 1, 2, 3
#: UTF-8 bytes of the texts that one task walks (a single head with what stands under it may have more).
RANGE_BYTES = 32 << 20


def fuzzy_dedup(rows: DataFrame, text_col: str = "text", seq: str = "seq", *, gate: Gate = RELAXED, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows that pass exact and fuzzy deduplication: those of the sequential walk over all rows, whatever `range_bytes` is (see `walked`)."""
    kept = walked(rows.select(F.col(seq).cast("long").alias("seq"), F.lit(0).alias("at"), F.col(text_col).alias("text")), gate=gate, range_bytes=range_bytes).where(F.col("status") == KEPT)
    return rows.join(kept.select(F.col("seq").alias("__kept")), F.col(seq) == F.col("__kept"), "left_semi")


_ROW = "range long, kind int, seq long, at int, text string, digest string, status int, like_seq long, like_at int"
_FOUND = "range long, seq long, at int, status int, like_seq long, like_at int, copy string, from_end int, text string"
#: Kinds of rows that a range's walk gets: its texts, texts of which ranges before it keep an equal one, the last kept texts before it, those that its last walk started from, what that said.
TEXT, BEFORE, NOW, THEN, OLD = range(5)


def walked(texts: DataFrame, *, gate: Gate = RELAXED, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """seq, at, status of all texts as the walk in order of (seq, at) finds them.

    texts: seq, at (together unique; rows without seq are left out), text (null counts as empty). A text with at > 0 stands under the head (seq, 0) and is looked at only if that was kept. A text
    is rejected if an equal one was kept before, or if one of the last `gate.history` kept ones is similar.

    Acceptance depends on earlier acceptance. So ranges of some `range_bytes` are walked in parallel, each from a guess of what was kept before it (at first: nothing, and of equal texts
    one in the first range that holds any); then each range whose guess differs from what the ranges before it gave is walked again, until all agree. The first range needs no
    guess, so what all agree on is the sequential result; a chain may need as many rounds as there are ranges.

    All of it is tables. A walk gives its last kept texts, numbered from the end; counts of kept texts number them over all ranges, and a range takes the numbers right before its own first one. A
    round writes only the ranges that it walks, and `versions` says which round a range's rows are from. The driver holds the number of ranges that are left to walk. A range
    walked again compares a text only with those it was not compared with before.
    """
    spark = texts.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 256)
    texts = texts.where(F.col("seq").isNotNull()).select("seq", F.col("at").cast("int").alias("at"), F.coalesce("text", F.lit("")).alias("text"))
    # ranges come from a sample, so they are written once
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = cut(texts.repartitionByRange(parts, "seq").sortWithinPartitions("seq", "at").mapInPandas(_ranged(range_bytes), "range long, seq long, at int, text string, digest string"), "fuzzy-texts")
    ranges = cut(rows.groupBy("range").agg(F.count("*").alias("n")), "fuzzy-ranges").select("range")
    # texts that several ranges hold; within a range the walk sees copies itself
    pairs = rows.groupBy("digest", "range").agg(F.count("*").alias("n"))
    shared = pairs.groupBy("digest").agg(F.count("*").alias("n"), F.min("range").alias("kept_in")).where("n > 1").drop("n")
    copies = cut(pairs.select("digest", "range").join(shared, "digest"), "fuzzy-copies")
    kept_in = copies.select("digest", "kept_in").distinct()
    copies = copies.select("digest", "range")
    walk = _walk_of(gate)
    state: DataFrame | None = None
    history = spark.createDataFrame([], "range long, seq long, at int, text string")
    versions = spark.createDataFrame([], "range long, round int, used string")
    walks: list[DataFrame] = []
    todo, left, turn = ranges.withColumn("now", F.lit("")), 1, 0
    then = history
    while left:
        here = todo.select("range")
        given = [
            _rows(rows.join(here, "range", "left_semi"), TEXT, "seq", "at", "text", "digest"),
            _rows(copies.join(here, "range", "left_semi").join(kept_in, "digest").where(F.col("kept_in") < F.col("range")), BEFORE, "digest"),
        ]
        if state is not None:
            given += [
                _rows(history.join(here, "range", "left_semi"), NOW, "seq", "at", "text"),
                _rows(then.join(here, "range", "left_semi"), THEN, "seq", "at"),
                _rows(state.join(here, "range", "left_semi"), OLD, "seq", "at", "status", "like_seq", "like_at"),
            ]
        marked = _rows(copies.join(here, "range", "left_semi"), -1, "digest")  # digests that other ranges hold too
        found = reduce(DataFrame.unionByName, [*given, marked]).groupBy("range").applyInPandas(walk, _FOUND)
        walks.append(cut(found, "fuzzy-state"))
        fresh = todo.select("range", F.lit(turn).alias("round"), F.col("now").alias("used"))
        versions = cut(versions.join(here, "range", "left_anti").unionByName(fresh), "fuzzy-versions")
        state = reduce(DataFrame.unionByName, [p.withColumn("round", F.lit(i)) for i, p in enumerate(walks)]).join(versions.select("range", "round"), ["range", "round"]).drop("round")
        if turn % 8 == 7:  # one table in place of many
            state = cut(state, "fuzzy-state")
            walks = [state]
            versions = versions.withColumn("round", F.lit(0))
            turn = 0
        turn += 1
        # the last kept texts before each range, and how they differ from those that its walk started from
        then, history = history, cut(_history(ranges, state, gate.history), "fuzzy-history")
        keys = F.transform(F.array_sort(F.collect_list(F.struct("seq", "at"))), lambda k: F.concat_ws(":", k["seq"].cast("string"), k["at"].cast("string")))
        now = history.groupBy("range").agg(F.sha2(F.array_join(keys, ","), 256).alias("now"))
        now = versions.select("range", "used").join(now, "range", "left").withColumn("now", F.coalesce("now", F.lit("")))
        # the first range that keeps a text, and the ranges after or before it for which that is new
        was, kept_in = kept_in, cut(state.where(F.col("copy").isNotNull()).groupBy(F.col("copy").alias("digest")).agg(F.min("range").alias("kept_in")), "fuzzy-kept")
        moved = was.withColumnRenamed("kept_in", "was").join(kept_in, "digest", "full").where(~F.col("was").eqNullSafe(F.col("kept_in")))
        sees = lambda c: F.coalesce(F.col(c) < F.col("range"), F.lit(False))
        flipped = copies.join(moved, "digest").where(sees("was") != sees("kept_in")).select(F.col("range").alias("__r")).distinct()
        todo = now.join(flipped, F.col("range") == F.col("__r"), "left").where((F.col("now") != F.col("used")) | F.col("__r").isNotNull()).select("range", "now")
        todo = cut(todo, "fuzzy-todo")
        left = todo.count()
    return state.select("seq", "at", "status")


def _rows(df: DataFrame, kind: int, *columns: str) -> DataFrame:
    """df as rows of a kind; numbers that it has not are -1 and not null, so that pandas keeps them whole."""

    def own(name: str, type_: str) -> Column:
        if name == "kind":
            return F.lit(kind)
        if name not in (*columns, "range"):
            return F.lit(None if type_ == "string" else -1).cast(type_)
        return F.col(name) if type_ == "string" else F.coalesce(name, F.lit(-1)).cast(type_)

    return df.select(*(own(*c.split()).alias(c.split()[0]) for c in _ROW.split(", ")))


def _history(ranges: DataFrame, state: DataFrame, length: int) -> DataFrame:
    """range, seq, at, text: the last `length` kept texts before each range."""
    counts = ranges.join(state.where(F.col("status") == KEPT).groupBy("range").agg(F.count("*").alias("n")), "range", "left").select("range", F.coalesce("n", F.lit(0)).alias("n"))
    # a row for each range
    counts = counts.select("range", "n", (F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    tails = state.where(F.col("from_end").isNotNull()).join(counts, "range").select((F.col("before") + F.col("n") - 1 - F.col("from_end")).alias("number"), "seq", "at", "text")
    wanted = counts.where("before > 0").select("range", F.explode(F.sequence(F.greatest(F.lit(0).cast("long"), F.col("before") - length), F.col("before") - 1)).alias("number"))
    return wanted.join(tails, "number").select("range", "seq", "at", "text")


def _ranged(range_bytes: int):
    """Numbers ranges of a partition in the order of their heads; a head stays with what stands under it."""

    def work(batches):
        first, sub, size, last = TaskContext.get().partitionId() << 32, 0, 0, None
        for pdf in batches:
            numbers, digests = [], []
            for seq, text in zip(pdf["seq"], pdf["text"]):
                if seq != last and size >= range_bytes:
                    sub, size = sub + 1, 0
                last = seq
                size += len(text.encode("utf-8", "surrogatepass"))
                numbers.append(first + sub)
                digests.append(hashlib.blake2b(text.lower().strip().encode("utf-8", "surrogatepass"), digest_size=16).hexdigest())
            yield pdf[["seq", "at", "text"]].assign(range=numbers, digest=digests)[["range", "seq", "at", "text", "digest"]]

    return work


def _walk_of(gate: Gate):
    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        kinds = {k: rows for k, rows in pdf.groupby("kind", sort=False)}
        none = pdf.iloc[:0]
        keys = lambda rows: list(zip(rows["seq"].tolist(), rows["at"].tolist()))
        shared, before = set(kinds.get(-1, none)["digest"]), set(kinds.get(BEFORE, none)["digest"])
        history = kinds.get(NOW, none).sort_values(["seq", "at"])
        # the last kept texts, oldest first: by this walk, and by the one before
        now = {k: Close(t.lower().strip(), gate.similarity) for k, t in zip(keys(history), history["text"])}
        then = dict.fromkeys(sorted(keys(kinds.get(THEN, none))))
        rows = kinds.get(OLD, none)
        old = dict(zip(keys(rows), zip(rows["status"].tolist(), zip(rows["like_seq"].tolist(), rows["like_at"].tolist()))))
        rows = kinds.get(TEXT, none).sort_values(["seq", "at"])
        seen: set[str] = set()
        out, kept, head = [], [], None
        for key, text, digest in zip(keys(rows), rows["text"], rows["digest"]):
            was, was_like = old.get(key, (None, None))
            close = like = None
            if key[1] and head != key[0]:
                status = PASSED_OVER
            elif digest in before or digest in seen:
                status = EXACT
            elif was == FUZZY and was_like in now:
                status, like = FUZZY, was_like
            else:
                close = Close(text.lower().strip(), gate.similarity)
                like = next((k for k, other in now.items() if not (was == KEPT and k in then) and close.to(other)), None)
                status = KEPT if like is None else FUZZY
            if status == KEPT:
                seen.add(digest)
                kept.append((len(out), text))
                now[key] = close
                if len(now) > gate.history:
                    del now[next(iter(now))]
                if key[1] == 0:
                    head = key[0]
            if was == KEPT:
                then[key] = None
                if len(then) > gate.history:
                    del then[next(iter(then))]
            out.append([pdf["range"].iloc[0], *key, status, like and like[0], like and like[1], digest if status == KEPT and digest in shared else None, None, None])
        for i, (place, text) in enumerate(reversed(kept[-gate.history :])):
            out[place][-2:] = i, text
        names = [c.split()[0] for c in _FOUND.split(", ")]
        return pd.DataFrame(out, columns=names).astype({"like_seq": "Int64", "like_at": "Int32", "from_end": "Int32"})

    return walk


def place_of(rows: DataFrame, *order: str | Column, parts: int | None = None) -> DataFrame:
    """Adds a dense `place` from 0 in the given order (seq): ranges are counted, then numbered from their offsets, so no task sees all rows."""
    order = order or ("seq",)
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ranges come from a sample, so they are written once
    ranged = cut(rows.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("__part").agg(F.count("*").alias("__n"))  # a row for each range
    before = counts.select(F.col("__part").alias("__p"), (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    ranged = ranged.withColumn("__in", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    return ranged.join(F.broadcast(before), F.col("__part") == F.col("__p")).withColumn("place", F.col("__before") + F.col("__in") - 1).drop("__part", "__in", "__p", "__before")
