"""Periodic runs: all stretches of consecutive words that repeat with a smallest period and cannot be extended, and texts with the repeats taken out.

By the runs theorem every run holds, at the place of a Lyndon root, the longest Lyndon word that begins there, under the order of the words or under its reverse. Under either order the
longest Lyndon word at a place ends before the next smaller value of the inverse suffix array. Each such root is extended to both sides by the longest common prefix of the
suffixes at its two ends and the longest common suffix of what stands before them: range minima over the LCP arrays of the text and of its reverse, from sparse tables.

Many documents are worked out at once: each has symbols of its own, and ends with a common one that is smaller than all under both orders, so nothing matches across documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

#: Words that are worked out at once; a document of more stands alone. Memory is about 16 bytes times log2(words) a word.
GROUP = 1 << 16
RUNS = "array<struct<start:long,length:long,period:long>>"


def _suffixes(text: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rank of each suffix, and the ranks by the first 1, 2, 4, ... symbols on the way there. A class has the number of smaller suffixes as its rank, so only suffixes whose class
    holds others are sorted again."""
    n = len(text)
    sizes = np.bincount(text)
    rank = (np.cumsum(sizes) - sizes)[text]
    levels, width = [rank], 1
    many = np.flatnonzero(sizes[text] > 1)
    while len(many):
        after = np.zeros(len(many), np.int64)
        inside = many + width < n
        after[inside] = rank[many[inside] + width] + 1
        key = rank[many] * (n + 1) + after
        order = np.argsort(key, kind="stable")
        many, key = many[order], key[order]
        old = rank[many]
        new = np.empty(len(many), bool)
        new[0], new[1:] = True, key[1:] != key[:-1]
        head = np.empty(len(many), bool)
        head[0], head[1:] = True, old[1:] != old[:-1]
        at = np.arange(len(many))
        first = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[many] = old + first - np.maximum.accumulate(np.where(head, at, 0))
        levels.append(rank)
        last = np.append(new[1:], True)
        many, width = many[~(new & last)], 2 * width
    return rank, levels


class _Common:
    """Lengths of common prefixes of suffixes."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        self.rank, levels = _suffixes(text)
        places = np.empty(n, np.int64)
        places[self.rank] = np.arange(n)
        a, b = places[:-1].copy(), places[1:].copy()
        lcp = np.zeros(n, np.int32)
        for k in range(len(levels) - 1, -1, -1):
            inside = (a < n) & (b < n)
            same = inside & (levels[k][np.where(inside, a, 0)] == levels[k][np.where(inside, b, 0)])
            lcp[1:][same] += 1 << k
            a[same] += 1 << k
            b[same] += 1 << k
        # row v: the least of 2^v consecutive values
        rows = [lcp]
        while 2 << (len(rows) - 1) <= n:
            half, above = 1 << (len(rows) - 1), rows[-1]
            row = above.copy()
            row[:-half] = np.minimum(above[:-half], above[half:])
            rows.append(row)
        self.table = np.array(rows)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of the suffixes at i and j, places that differ."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        v = np.frexp((high - low + 1).astype(float))[1] - 1
        return np.minimum(self.table[v, low], self.table[v, high - (1 << v) + 1])


def _next_smaller(rank: np.ndarray) -> np.ndarray:
    """The next place with a smaller value; the length where there is none."""
    values, n = rank.tolist(), len(rank)
    out = [n] * n
    for i in range(n - 2, -1, -1):
        x, j = values[i], i + 1
        while j < n and values[j] > x:
            j = out[j]
        out[i] = j
    return np.array(out)


def runs_of(text: np.ndarray, least: int, times: int) -> np.ndarray:
    """Rows (start, end, period) of the runs of `least` symbols and `times` periods or more, in this order. text: positive symbols; 0 ends a document, which shares no symbol with others."""
    n = len(text)
    forward, backward = _Common(text), _Common(text[::-1].copy())
    reverse = np.where(text > 0, text.max() + 1 - text, 0)
    found = []
    for rank in (forward.rank, _suffixes(reverse)[0]):
        end = _next_smaller(rank)
        i = np.flatnonzero((text > 0) & (end < n))
        j = end[i]
        period = j - i
        ahead = forward(i, j)
        behind = np.zeros(len(i), np.int64)
        inner = np.flatnonzero(i > 0)
        behind[inner] = backward(n - i[inner], n - j[inner])  # those that end before i and j
        length = period + ahead + behind
        long = length >= np.maximum(least, times * period)
        found.append(np.stack([i - behind, j + ahead, period], axis=1)[long])
    return np.unique(np.concatenate(found), axis=0)


def _worked(docs: list[list[bytes]], least: int, times: int) -> list[tuple[list[tuple[int, int, int]], list[bytes]]]:
    """Of each document the runs (start, length, period), and the words that are left."""
    symbols: list[int] = []
    starts, base = [], 1
    for words in docs:
        known: dict[bytes, int] = {}
        starts.append(len(symbols))
        symbols += [known.setdefault(w, base + len(known)) for w in words]
        symbols.append(0)
        base += len(known)
    found = runs_of(np.array(symbols, np.int64), least, times)
    out: list[tuple[list[tuple[int, int, int]], list[bytes]]] = [([], words) for words in docs]
    of = np.searchsorted(starts, found[:, 0], side="right") - 1
    borders = np.flatnonzero(np.diff(of, prepend=-1, append=-1))
    for a, b in zip(borders[:-1], borders[1:]):
        d = int(of[a])
        runs = found[a:b] - [starts[d], starts[d], 0]
        cover = np.zeros(len(docs[d]) + 1, np.int64)
        np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
        np.add.at(cover, runs[:, 1], -1)
        stays = np.cumsum(cover)[:-1] == 0
        out[d] = [(s, e - s, p) for s, e, p in runs.tolist()], [w for w, keep in zip(docs[d], stays.tolist()) if keep]
    return out


def periodic_runs(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", least: int = 12, times: int = 2, edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs, collapsed of each row: the runs of `least` words and `times` periods or more by start and period, and the text without what any run holds after its first
    period (words joined by one space). Words are what ASCII white space parts. edit: (id, words) -> words, applied first.

    Every row is worked out by itself, whole: no shuffle. Null and empty texts have no words, no runs and an empty collapsed text; repeated rows give the same again; other columns are
    not looked at. A document is worked out in one task, with memory of some n log2(n) words of 4 bytes.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(0).to_pylist()
        words = [(t or "").encode("utf-8", "surrogatepass").split() for t in batch.column(1).to_pylist()]
        if edit is not None:
            words = [edit(i, w) for i, w in zip(ids, words)]
        done, group, size = [], [], 0
        for w in [*words, None]:
            if group and (w is None or size + len(w) > GROUP):
                done += _worked(group, least, times)
                group, size = [], 0
            if w is not None:
                group.append(w)
                size += len(w) + 1
        runs = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r, _ in done]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        texts = [b" ".join(left).decode("utf-8", "replace") for _, left in done]
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array(map(len, words), pa.int64()), pa.array(runs, kind), pa.array(texts, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, work, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def looped(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's edit: in a tenth of the documents, by crc32 of the id, the words from some place on repeat with a period. A null id is in no such tenth."""
    if doc_id is None or not words or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def summarised(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period; null without a run) and digests of all runs and of the collapsed text."""
    longest = F.try_element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("back"), r["start"].alias("start"), r["period"].alias("period")))), F.lit(1))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    rows = found.withColumn("top", longest)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), (-F.col("top.back")).alias("length"), F.col("top.period").alias("period"),
        F.expr("1000 * -top.back div top.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
