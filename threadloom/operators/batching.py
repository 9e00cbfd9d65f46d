"""Token counts of posts, packing into batches, and the figures of batches."""

from __future__ import annotations

import bisect
import functools
import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..config import CAPACITY
from ..functions.members import indented_length
from ..sources.sinks import cut
from .dedup import place_of


def estimated_tokens(text: Column) -> Column:
    """The estimate used without a vocabulary: a token for every four characters, rounded up."""
    return F.ceil(F.coalesce(F.length(text), F.lit(0)) / 4).cast("int")


def estimated_json_tokens(json: Column) -> Column:
    """The same estimate of a compact JSON text as it would be indented by two, without a parse."""
    return F.ceil(F.coalesce(indented_length(json), F.lit(0)) / 4).cast("int")


@functools.cache
def _encoding(ranks_path: str, pattern: str):
    """Read once in a worker."""
    import base64

    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def tiktoken_tokens(ranks_path: str, pattern: str):
    """A column function that counts tokens with a rank file (lines of base64 and rank). Special strings count as ordinary text."""

    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        encoding = _encoding(ranks_path, pattern)
        return texts.map(lambda t: len(encoding.encode_ordinary(t or "")))

    return count


@F.pandas_udf(StringType())
def pretty_json(texts: pd.Series) -> pd.Series:
    """A JSON text indented by two, non-ASCII kept: what a vocabulary's tokens of a whole post are counted over. to_json's own pretty form has other blanks."""
    return texts.map(lambda t: None if t is None else json.dumps(json.loads(t), ensure_ascii=False, indent=2))


def oversize(posts: DataFrame, capacity: int = CAPACITY, tokens: str = "tokens") -> DataFrame:
    return posts.where(F.col(tokens) > capacity)


def pack(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, place in the bin) of items that come largest first: each goes to the bin it fills best, the oldest of equals, or to a new one.

    Bins are kept sorted by what is left and age, so an item costs a binary search.
    """
    open_bins: list[tuple[int, int]] = []
    held: list[int] = []
    out = []
    for size in sizes:
        at = bisect.bisect_left(open_bins, (size, -1))
        if at < len(open_bins):
            left, index = open_bins.pop(at)
        else:
            left, index = capacity, len(held)
            held.append(0)
        out.append((index, held[index]))
        held[index] += 1
        bisect.insort(open_bins, (left - size, index))
    return out


def pack_counts(counts: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """What `pack` does to n items of each size, (size, n) with the largest size first, as runs (place, n, each, bin, pos): from the item at `place` on, n items go to bins from `bin`
    on, `each` to a bin, from position `pos` in each.

    A bin that best fits a size goes on being the best fit until the size no longer fits, so bins with equally much left take equally many items one after another. Bins are kept by
    what is left as intervals of their numbers, and the work depends on the sizes and intervals, not on the items.
    """
    left: dict[int, list[tuple[int, int, int]]] = {}  # what is left: (first bin, bins, items in each), sorted
    order: list[int] = []
    runs, place, opened = [], 0, 0

    def put(rest: int, interval: tuple[int, int, int]) -> None:
        if rest not in left:
            left[rest] = []
            bisect.insort(order, rest)
        bisect.insort(left[rest], interval)

    for size, n in counts:
        at = bisect.bisect_left(order, size)
        while n and at < len(order):
            rest = order[at]
            first, bins, held = left[rest].pop(0)
            if not left[rest]:
                del left[rest], order[at]
            each = rest // size if size else n
            whole, more = min(bins, n // each), 0
            if whole:
                runs.append((place, whole * each, each, first, held))
                put(rest - each * size, (first, whole, held + each))
                place, n = place + whole * each, n - whole * each
            if whole < bins:
                more = min(n, each)  # the last bin of this size may take fewer
                if more:
                    runs.append((place, more, each, first + whole, held))
                    put(rest - more * size, (first + whole, 1, held + more))
                    place, n = place + more, n - more
                if whole + bool(more) < bins:
                    put(rest, (first + whole + bool(more), bins - whole - bool(more), held))
            at = bisect.bisect_left(order, size)
        if n:
            each = capacity // size if size else n
            whole, more = divmod(n, each)
            if whole:
                runs.append((place, whole * each, each, opened, 0))
                put(capacity - each * size, (opened, whole, each))
            if more:
                runs.append((place + whole * each, more, each, opened + whole, 0))
                put(capacity - more * size, (opened + whole, 1, more))
            opened, place = opened + whole + bool(more), place + n
    return runs


def packed(posts: DataFrame, capacity: int = CAPACITY, *, seq: str = "seq", tokens: str = "tokens") -> DataFrame:
    """(seq, tokens, batch_index from 1, pos) by best fit decreasing over all posts; equal sizes keep seq order, larger ones than the capacity are left out.

    The walk is sequential, but it needs only how many posts have each size, at most `capacity` rows, and tells where runs of posts go. Posts get a dense place in packing order
    by ranges, and look their run up.
    """
    # written once: sizes are read by the counts, the sample of ranges and the ranges
    rows = cut(posts.select(F.col(seq).cast("long").alias("seq"), F.col(tokens).cast("long").alias("tokens")), "post-sizes").where(F.col("tokens") <= capacity)
    counts = sorted(((r.tokens, r.n) for r in rows.groupBy("tokens").agg(F.count("*").alias("n")).collect()), reverse=True)  # a row for each size
    runs = np.array(pack_counts(counts, capacity), np.int64).reshape(-1, 5)
    shared = posts.sparkSession.sparkContext.broadcast(runs)

    @F.pandas_udf("struct<bin:long,pos:long>")
    def slot(place: pd.Series) -> pd.DataFrame:
        found = shared.value[np.searchsorted(shared.value[:, 0], place.to_numpy(), side="right") - 1]
        turn, each = place.to_numpy() - found[:, 0], found[:, 2]
        return pd.DataFrame({"bin": found[:, 3] + turn // each, "pos": found[:, 4] + turn % each})

    placed = place_of(rows, F.col("tokens").desc(), F.col("seq")).withColumn("slot", slot("place"))
    return placed.select("seq", "tokens", (F.col("slot.bin") + 1).cast("int").alias("batch_index"), F.col("slot.pos").alias("pos"))


def rolled_up(placed: DataFrame) -> DataFrame:
    return placed.groupBy("batch_index").agg(
        F.sum("tokens").alias("total_tokens"), F.count("*").alias("post_count"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "seq"))), lambda x: x["seq"]).alias("posts")
    )


def utilisation(placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """batches, tokens, utilisation in percent of all capacity; 0 without batches."""
    sums = placed.agg(F.countDistinct("batch_index").alias("batches"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    return sums.withColumn("utilisation", F.coalesce(F.try_divide(F.col("tokens") * 100.0, F.col("batches") * capacity), F.lit(0.0)))


def savings(original: Column, compressed: Column) -> tuple[Column, Column]:
    """Tokens saved, and percent saved (0 of nothing)."""
    return original - compressed, F.coalesce(F.try_divide((original - compressed) * 100.0, original), F.lit(0.0))
