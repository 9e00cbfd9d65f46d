"""Byte strings of some length that stand in more than one place of a corpus: found by suffix arrays of what can match, and taken out of the texts.

A string of `length` bytes that stands twice holds the same anchor in both places: of its grams the one with the least hash. So each place where a string may start belongs to one anchor, and the
places that belong to an occurrence of an anchor are consecutive; they and the bytes of their strings are the occurrence's context. Strings are equal only under equal anchors. An
anchor that occurs once has nothing to find; where all contexts of an anchor are equal, all their strings repeat. For the others the distinct contexts of an anchor meet, and an enhanced suffix array
over them gives the tree of common-prefix intervals: a stack scan of the LCP array, in which an interval with different bytes (or the border of a context) on the left of its
members is a maximal repeat, with all of its occurrences. An anchor with very many contexts (a passage that a large share of all texts holds, and what stands around it) has no
bounded suffix array; its strings are counted by 128 bits of hash instead.

Texts themselves are known by 128 bits of hash, so equal texts have equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .common import BATCH_ROWS, cut, map_batches

LENGTH = 200
#: Bytes of an anchor at most; it takes a quarter of short strings.
GRAM = 48
#: Bytes that are hashed at once, so that arrays stay in the processor's cache; a longer text goes in pieces that overlap by length - 1.
PIECE = 1 << 18
#: Low bits of a hash that give way to the place, the same ones whatever the piece, so that equal strings choose alike.
_BITS = np.uint64(20)
#: Bytes of texts among which a task looks for equal contexts before it gives them away.
FLUSH = 1 << 23
#: Bytes of contexts that share a suffix array, and contexts of one anchor that do; beyond these an anchor's strings are counted by their hashes.
BLOCK, CONTEXTS = 1 << 20, 4000
#: Bytes of spans that may be broadcast to the texts; beyond these both are shuffled.
BROADCAST_BYTES = 32 << 20

# odd multipliers, their inverses modulo 2^64, and a random number for each byte: two polynomial hashes of any stretch from prefix sums
_RNG = np.random.default_rng(2011)
_ODD = [int(x) | 1 for x in _RNG.integers(1 << 62, 1 << 63, 2)]
_VALUES = _RNG.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a multiplier and of its inverse, at least n of them."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        n = max(n, 2 * PIECE)
        up, down = np.full(n, _ODD[which], np.uint64), np.full(n, pow(_ODD[which], -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[which] = np.cumprod(up), np.cumprod(down)
    return _POWERS[which]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _sums(data: np.ndarray, which: int) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[which][data] * _powers(which, len(data))[0][: len(data)], out=out[1:])
    return out


def _stretch(sums: np.ndarray, which: int, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
    return _mixed((sums[end] - sums[start]) * _powers(which, len(sums))[1][: len(sums)][start])


def gram_of(length: int) -> int:
    return max(1, min(GRAM, length // 4))


def _contexts(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of texts that follow each other in data: (first place, places, anchor's place, anchor's hash, context's hash) of each occurrence of an anchor."""
    gram = gram_of(length)
    n, reach = len(data), length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    first, second = _sums(data, 0), _sums(data, 1)
    hashes = _stretch(first, 0, slice(0, n - gram + 1), slice(gram, n + 1))
    # the least of `reach` consecutive ones; of equal ones the first. The place stands in the low bits.
    least = (hashes >> _BITS << _BITS) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while 2 * span <= reach:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    if span < reach:
        least = np.minimum(least[: len(least) - (reach - span)], least[reach - span :])
    whole = np.zeros(n + 1, np.int32)
    long = sizes >= length
    np.add.at(whole, starts[long], 1)
    np.add.at(whole, starts[long] + sizes[long] - length + 1, -1)
    places = np.flatnonzero(np.cumsum(whole)[: len(least)])
    if not len(places):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    at = (least[places] & np.uint64((1 << int(_BITS)) - 1)).astype(np.int64)
    new = np.ones(len(places), bool)
    new[1:] = (at[1:] != at[:-1]) | (places[1:] != places[:-1] + 1)
    new = np.flatnonzero(new)
    begin, count, at = places[new], np.diff(np.append(new, len(places))), at[new]
    context = _stretch(second, 1, begin, begin + count - 1 + length)
    return begin, count, at, hashes[at], _mixed(context ^ (at - begin).astype(np.uint64))


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, number of the text, offset in it, start in the bytes) of runs of about PIECE bytes."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[offset : offset + PIECE + length - 1]
            if held and size + len(part) > PIECE:
                yield _joined(held)
                held, size = [], 0
            held.append((i, offset, part))
            size += len(part)
    if held:
        yield _joined(held)


def _joined(held):
    sizes = np.array([len(x[2]) for x in held])
    return b"".join(x[2] for x in held), np.array([x[0] for x in held]), np.array([x[1] for x in held]), np.cumsum(sizes) - sizes


_FOUND = "h1 long, h2 long, start long, places long, before long, anchor long, context long, same long"


def occurrences(texts: DataFrame, length: int) -> DataFrame:
    """A row for each occurrence of an anchor, with the number of equal contexts in the stretch of texts that a task looks at together (`same`): only the first of those stands for them. Where there
    are several, their places are given at once, in rows without an anchor. texts: h1, h2, text."""

    def flushed(h1: list[int], h2: list[int], texts: list[bytes]) -> pa.RecordBatch:
        columns = []
        for joined, number, offset, start in _pieces(texts, length):
            data = np.frombuffer(joined, np.uint8)
            begin, count, at, anchor, context = _contexts(data, start, np.diff(np.append(start, len(data))), length)
            of = np.searchsorted(start, begin, side="right") - 1
            columns.append((number[of], begin - start[of] + offset[of], count, at - begin, anchor.view(np.int64), context.view(np.int64)))
        of, begin, count, before, anchor, context = (np.concatenate(c) for c in zip(*columns))
        order = np.lexsort((context, anchor))
        a, c = anchor[order], context[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
        new = np.flatnonzero(new)
        same = np.diff(np.append(new, len(order)))
        lead = order[new]
        # those that repeat here: consecutive places of a text as one row
        again = np.sort(np.concatenate([order[new[i] : new[i] + same[i]] for i in np.flatnonzero(same > 1)] or [np.zeros(0, np.int64)]))
        cuts = np.ones(len(again), bool)
        cuts[1:] = (of[again[1:]] != of[again[:-1]]) | (begin[again[1:]] != begin[again[:-1]] + count[again[:-1]])
        cuts = np.flatnonzero(cuts)
        merged = np.add.reduceat(count[again], cuts) if len(again) else np.zeros(0, np.int64)
        heads = again[cuts]
        h1, h2, k = np.array(h1, np.int64), np.array(h2, np.int64), len(heads)
        rows = np.concatenate([lead, heads])
        known = np.arange(len(rows)) < len(lead)
        arrays = [h1[of[rows]], h2[of[rows]], begin[rows], np.concatenate([count[lead], merged]), before[rows]]
        arrays = [pa.array(x) for x in arrays] + [pa.array(x[rows], mask=~known) for x in (anchor, context)] + [pa.array(np.concatenate([same, np.zeros(k, np.int64)]))]
        return pa.record_batch(arrays, names=["h1", "h2", "start", "places", "before", "anchor", "context", "same"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h1, h2, texts, size = [], [], [], 0
        for batch in batches:
            for a, b, t in zip(*(batch.column(i).to_pylist() for i in range(3))):
                h1.append(a), h2.append(b), texts.append(t)
                size += len(t)
                if size >= FLUSH:
                    yield flushed(h1, h2, texts)
                    h1, h2, texts, size = [], [], [], 0
        if texts:
            yield flushed(h1, h2, texts)

    texts.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return texts.select("h1", "h2", F.col("text").cast("binary").alias("text")).where(F.length("text") >= length).mapInArrow(run, _FOUND)


def intervals(contexts: list[bytes], length: int) -> list[tuple[int, int, int, int, int]]:
    """(context, start, length, group, parent) of the maximal repeats of `length` bytes or more among texts: an occurrence with the deepest interval of the tree that holds it. A group's
    occurrences are its own and those of the groups below it; parent is -1 at a root."""
    data = np.frombuffer(b"\xff".join(contexts) + b"\xff" * 9, np.uint8)  # no byte of UTF-8
    n = len(data) - 8
    sizes = np.array([len(c) for c in contexts])
    first = np.cumsum(sizes + 1) - sizes - 1
    left = np.zeros(n, np.int64)  # bytes up to the end of the context
    of = np.repeat(np.arange(len(contexts)), sizes + 1)
    left[: len(of)] = (first + sizes)[of] - np.arange(len(of))
    code = np.zeros(n, np.uint64)
    for k in range(8):
        code = code << np.uint64(8) | data[k : k + n]
    # ranks by the first 8, 16, 32, ... bytes; a class is named by the number of smaller suffixes, and only members of classes with others are sorted again
    order = np.argsort(code, kind="stable")
    new = np.ones(n, bool)
    new[1:] = code[order[1:]] != code[order[:-1]]
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0))
    last = np.append(new[1:], True)
    many, levels, width = order[~(new & last)], [rank], 8
    del order
    while len(many) and width < sizes.max(initial=0):
        after = np.zeros(len(many), np.int64)
        inside = many + width < n
        after[inside] = rank[many[inside] + width] + 1
        key = rank[many].astype(np.int64) * (n + 1) + after
        turn = np.argsort(key, kind="stable")
        many, key = many[turn], key[turn]
        old, at = rank[many], np.arange(len(many))
        new, head = np.ones(len(many), bool), np.ones(len(many), bool)
        new[1:], head[1:] = key[1:] != key[:-1], old[1:] != old[:-1]
        rank = rank.copy()
        rank[many] = old + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(head, at, 0))
        last = np.append(new[1:], True)
        levels.append(rank)
        many, width = many[~(new & last)], 2 * width
    # the suffix array of places where a string may start, and its LCP array, within contexts
    places = np.flatnonzero(left >= length)
    places = places[np.argsort(rank[places], kind="stable")]
    a, b = places[:-1].copy(), places[1:].copy()
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = inside & (levels[k][np.where(inside, a, 0)] == levels[k][np.where(inside, b, 0)])
        step = np.where(same, 8 << k, 0)
        lcp, a, b = lcp + step, a + step, b + step
    a, b = np.minimum(a, n - 1), np.minimum(b, n - 1)
    apart = code[a] ^ code[b]
    lcp += np.where(apart > 0, (64 - np.frexp(apart.astype(np.float64))[1]) // 8, 0)
    lcp = np.minimum(lcp, np.minimum(left[places[:-1]], left[places[1:]])) if len(places) else lcp
    # the stack scan: an entry is (length, first suffix, group, left byte or -1 if they differ)
    before = np.where(places > 0, data[places - 1], 0xFF).astype(np.int64)
    before[before == 0xFF] = -1  # the border of a context: unlike any
    keep = np.flatnonzero(lcp >= length)
    out: list[tuple[int, int, int, int, int]] = []
    if not len(keep):
        return out
    starts = np.flatnonzero(np.diff(keep, prepend=-2) > 1)
    depth: dict[int, int] = {}
    groups = 0
    lcps, lefts = lcp.tolist(), before.tolist()
    parent: dict[int, int] = {}
    diverse: dict[int, bool] = {}
    own: dict[int, list[int]] = {}
    for s, e in zip(keep[starts].tolist(), keep[np.append(starts[1:] - 1, len(keep) - 1)].tolist()):
        stack: list[list[int]] = []  # [lcp, group, left byte]
        for t in range(s, e + 2):  # suffix t, with lcps[t - 1] to the one before and lcps[t] to the next
            here = lcps[t] if t <= e else 0
            was = lcps[t - 1] if t > s else 0
            byte = lefts[t]
            if here > was:  # opens an interval, which begins with this suffix
                stack.append([here, groups, byte])
                own[groups] = [t]
                groups += 1
                continue
            own[stack[-1][1]].append(t)
            stack[-1][2] = byte if stack[-1][2] == byte else -1
            while stack and stack[-1][0] > here:
                value, group, byte = stack.pop()
                depth[group], diverse[group] = value, byte < 0
                if stack and stack[-1][0] >= here:
                    parent[group] = stack[-1][1]
                    stack[-1][2] = byte if stack[-1][2] == byte else -1
                elif here >= length:  # goes on as a part of a wider interval
                    stack.append([here, groups, byte])
                    own[groups] = []
                    parent[group] = groups
                    groups += 1
                    break
    for group, members in own.items():
        if diverse[group]:
            for t in members:
                p = int(places[t])
                out.append((int(of[p]), p - int(first[of[p]]), depth[group], group, parent.get(group, -1)))
    return out


def _prepared(docs: DataFrame, text_col: str, *keep: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(*keep, F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), text.alias("text"))


def repeats(docs: DataFrame, *, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """h1, h2, start, end, how: the stretches of texts (known by two hashes) whose strings of `length` bytes stand elsewhere too. how: equal (whole contexts), tree (an interval of the suffix
    array), counted (an anchor of very many contexts). Stretches overlap; together they are all that repeats."""
    if not 0 < length <= PIECE:
        raise ValueError(f"length must be between 1 and {PIECE}")
    texts = _prepared(docs, text_col)
    found = cut(occurrences(texts, length), "repeat-anchors")
    at_once = found.where("anchor IS NULL").select("h1", "h2", "start", (F.col("start") + F.col("places") + (length - 1)).alias("end"))
    one = found.where("anchor IS NOT NULL")
    recurring = one.groupBy("anchor").agg(F.sum("same").alias("n"), F.min("context").alias("low"), F.max("context").alias("high")).where("n > 1")
    recurring = recurring.select(F.col("anchor").alias("of"), (F.col("low") != F.col("high")).alias("mixed"))
    rows = cut(one.join(recurring, F.col("anchor") == F.col("of")).drop("of"), "repeat-recurring")
    end = F.col("start") + F.col("places") + (length - 1)
    alike = rows.where("NOT mixed AND same = 1").select("h1", "h2", "start", end.alias("end"))
    # anchors with several contexts: which of these are there twice, and the rest
    mixed = rows.where("mixed")
    first = F.min(F.struct("h1", "h2", "start", "places", "before")).alias("first")
    kinds = cut(mixed.groupBy("anchor", "context").agg(F.sum("same").alias("n"), first), "repeat-contexts")
    twice = kinds.where("n > 1").select(F.col("anchor").alias("of"), F.col("context").alias("like"))
    twice = mixed.where("same = 1").join(twice, (F.col("anchor") == F.col("of")) & (F.col("context") == F.col("like")), "left_semi").select("h1", "h2", "start", end.alias("end"))
    open_ = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("single")).where("single > 0").select(F.col("anchor").alias("of"), "kinds")
    wanted = kinds.join(open_, F.col("anchor") == F.col("of")).select("anchor", "context", "n", "kinds", "first.*")
    wanted = cut(wanted, "repeat-open")
    parts = _bytes_of(wanted, texts, length)
    few, many = parts.where(F.col("kinds") <= CONTEXTS), parts.where(F.col("kinds") > CONTEXTS)
    equal = at_once.unionByName(alike).unionByName(twice).withColumn("how", F.lit("equal"))
    return equal.unionByName(_by_tree(few, length).withColumn("how", F.lit("tree"))).unionByName(_by_count(many, length).withColumn("how", F.lit("counted")))


def _bytes_of(wanted: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """The distinct contexts of anchors with their bytes."""
    lists = wanted.groupBy("h1", "h2").agg(F.collect_list(F.struct("anchor", "context", "n", "kinds", "start", "places", "before")).alias("parts"))
    joined = texts.join(lists.withColumnsRenamed({"h1": "__h1", "h2": "__h2"}), (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2")))
    rows = joined.select("h1", "h2", F.col("text").cast("binary").alias("text"), F.explode("parts").alias("p"))
    body = F.substring("text", (F.col("p.start") + 1).cast("int"), (F.col("p.places") + (length - 1)).cast("int"))
    rows = rows.select("h1", "h2", "p.*", body.alias("body"))
    return cut(rows.dropDuplicates(["anchor", "context"]), "repeat-bodies")  # equal texts gave the same ones


_SPAN = "h1 long, h2 long, start long, end long"


def _by_tree(parts: DataFrame, length: int) -> DataFrame:
    size = parts.agg(F.coalesce(F.sum(F.length("body")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(size) // BLOCK))

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        found = intervals([bytes(b) for b in pdf["body"]], length)
        table = np.array(found, np.int64).reshape(-1, 5)
        table = table[pdf["n"].to_numpy()[table[:, 0]] == 1]  # the others repeat as a whole
        of = table[:, 0]
        start = pdf["start"].to_numpy()[of] + table[:, 1]
        return pd.DataFrame({"h1": pdf["h1"].to_numpy()[of], "h2": pdf["h2"].to_numpy()[of], "start": start, "end": start + table[:, 2]})

    return parts.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(blocks)).alias("block")).applyInPandas(block, _SPAN)


def _by_count(parts: DataFrame, length: int) -> DataFrame:
    """Strings of anchors with too many contexts for one suffix array: a row for each, summed up in each task first."""

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for anchor, n, before, start, h1, h2, body in zip(*(c.to_pylist() for c in batch.columns)):
            data = np.frombuffer(body, np.uint8)
            x = np.arange(len(data) - length + 1)
            own = [_stretch(_sums(data, k), k, x, x + length).view(np.int64) for k in (0, 1)]
            full = lambda v, like=x: np.full(len(like), v, np.int64)
            rows.append((full(anchor), before - x, *own, full(n), full(h1), full(h2), start + x))
        columns = [np.concatenate(c) for c in zip(*rows)]
        return pa.record_batch([pa.array(c) for c in columns], names=["anchor", "offset", "s1", "s2", "n", "h1", "h2", "start"])

    columns = ["anchor", "n", "before", "start", "h1", "h2", "body"]
    places = map_batches(parts.select(*columns), hashed, "anchor long, offset long, s1 long, s2 long, n long, h1 long, h2 long, start long")
    places = cut(places, "repeat-strings")
    key = ["anchor", "offset", "s1", "s2"]
    again = places.groupBy(*key).agg(F.sum("n").alias("all")).where(F.col("all") > 1).drop("all")
    return places.where("n = 1").join(again, key, "left_semi").select("h1", "h2", "start", (F.col("start") + length).alias("end"))


def spans(docs: DataFrame, *, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """h1, h2, spans: of each text with repeats, the stretches that they cover, apart from each other and in order (start and end, one after the other)."""
    found = repeats(docs, text_col=text_col, length=length)
    lists = found.groupBy("h1", "h2").agg(F.collect_set(F.struct("start", "end")).alias("found"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(2)
        merged = []
        for i in range(batch.num_rows):
            values = lists[i].values
            start, end = (values.field(k).to_numpy() for k in (0, 1))
            order = np.argsort(start, kind="stable")
            start, end = start[order], np.maximum.accumulate(end[order])
            new = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
            ends = end[np.append(new[1:] - 1, len(end) - 1)]
            merged.append(np.stack([start[new], ends], axis=1).ravel())
        return pa.record_batch([batch.column(0), batch.column(1), pa.array(merged, pa.list_(pa.int64()))], names=["h1", "h2", "spans"])

    return map_batches(lists, work, "h1 long, h2 long, spans array<long>")


def without_repeats(docs: DataFrame, *, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """docs with n_bytes, spans (start and end, one after the other, of what was removed) and kept, the bytes that are left of the text in UTF-8.

    A byte goes if a string of `length` bytes that covers it also starts anywhere else in any text, the same one included, as the texts came in; a text is not joined with another. All
    columns of docs stay; columns of the three names are replaced. Null counts as empty; texts shorter than `length` stay whole; rows with equal texts lose all of a text of `length`
    bytes or more. Texts are shuffled only to pick out the contexts of anchors that occur with several ones, and, if the spans have more than BROADCAST_BYTES, to meet them.
    """
    columns = [c for c in docs.columns if c not in ("n_bytes", "spans", "kept")]
    found = cut(spans(docs, text_col=text_col, length=length), "repeat-spans").withColumnsRenamed({"h1": "__h1", "h2": "__h2"})
    size = found.agg(F.coalesce(F.sum(64 + 8 * F.size("spans")), F.lit(0))).first()[0]
    found = F.broadcast(found) if size <= BROADCAST_BYTES else found
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*columns).alias("row"), text.alias("text"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))
    rows = rows.join(found, (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2")), "left").select("row", "text", "spans")
    rows = rows.withColumn("body", F.col("text").cast("binary"))
    # what is kept lies between the spans
    gaps = F.when(F.col("spans").isNotNull(), _between(F.when(F.col("spans").isNotNull(), F.col("body")), F.col("spans"))).otherwise(F.col("body"))
    return rows.select("row.*", F.octet_length("text").cast("long").alias("n_bytes"), F.coalesce("spans", F.array().cast("array<long>")).alias("spans"), gaps.alias("kept"))


@F.pandas_udf(BinaryType())
def _between(bodies: pd.Series, lists: pd.Series) -> pd.Series:
    def left(body: bytes, spans) -> bytes | None:
        if spans is None or body is None:
            return None
        out, at = [], 0
        for start, end in zip(spans[::2], spans[1::2]):
            out.append(body[at:start])
            at = end
        return b"".join([*out, body[at:]])

    return pd.Series([left(b, s) for b, s in zip(bodies, lists)])


def summarised(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and a digest of the bytes that are left."""
    removed = F.col("n_bytes") - F.octet_length("kept")
    return found.select(F.col(id_col).alias("doc_id"), "n_bytes", removed.cast("long").alias("n_removed"), F.expr("size(spans) div 2").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
