"""Toxicity by convolutional text classifiers, trained by tasks on all labelled rows.

Words are hashed, whole and by their first letters, to rows of an embedding table. Filters of several widths slide over the embedded words, the greatest
answer of each filter over the whole text is kept (max pooling), and a logistic unit weighs these.

Labelled rows fall into two halves. A net is learned from all rows of a half, its thresholds, one for each language, from all rows of the other, so every row shapes a net and the thresholds of the other
net. The language is recognised from the text. A score is the mean of how far both nets are beyond their thresholds, moved so that 0.5 is at them.

Rows lie in shards. In each epoch tasks walk over the shards, each from the same net, in small steps; the mean of their moves moves the net. Tasks give the rows of the embedding
table that they moved, so what reaches the driver has the size of the table, whatever the input's.

Since filters are linear, each is applied to the embedding table once; a text then costs look-ups, sums and maxima. Texts of a batch are worked on together, in pieces of bounded size: their words
are looked up at once, and each answer lies along the words. A score does not depend on the texts beside it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, cut, in_fold, map_batches, small
from .near_dedup import _LETTERS, _powers, mix64

#: Rows of the embedding table for whole words, and as many again for beginnings; its columns; filters of a width; widths.
BUCKETS, DIMS, FILTERS, WIDTHS = 1 << 15, 12, 8, (1, 2, 3)
#: Letters (bytes) of a beginning.
LEAD = 5
#: Labelled rows of a shard, about; there are as many shards as the rows need.
SHARD = 4096
EPOCHS, BATCH, RATE = 8, 64, 0.01
#: Texts and words that a walk mixes before it takes steps; words that are worked on at once (few enough for a core's cache).
MIXED_TEXTS, MIXED_WORDS, BLOCK = 1024, 1 << 20, 1 << 12
#: Training texts that a bucket must occur in for its log-odds to be a start, and texts added to either label's count to shrink them.
SEEN, SHRINK = 3, 1.0
#: Texts of each label and half that two nets take; with fewer, one net and its thresholds are learned from all rows.
HALVES = 10
#: Texts of each label of a language that a threshold of its own takes.
CALIBRATE = 20
#: Logits are counted on a grid of 1 / GRID, moves summed as whole numbers of 1 / UNIT (sums do not depend on their order).
GRID, FAR, UNIT = 256, 1 << 14, float(1 << 24)
#: The part of a language's own words in its share of a bucket; the rest is the share that all texts give it.
OWN = 0.9
#: Languages that a task counts before it gives counts away.
HELD_LANGUAGES = 64
_WORDS = bytes(c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))
_PIECE = 1 << 16
_T = TypeVar("_T")


def together(items: Iterable[_T], size: Callable[[_T], int], most: int) -> Iterator[list[_T]]:
    """The items in their order, in lists of `most` in all, or of one that is greater."""
    some, held = [], 0
    for item in items:
        n = size(item)
        if some and held + n > most:
            yield some
            some, held = [], 0
        some.append(item)
        held += n
    if some:
        yield some


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of `data` begins, and as in word_ids()."""
    part = np.frombuffer(b" " + data + b" ", np.uint8)
    inside = part != 32
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, stop = edge[::2], edge[1::2]
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS.take(part[1:-1]) * up[: len(data)], out=sums[1:])
    first, back, most = sums.take(start), down.take(start), np.uint64(BUCKETS - 1)
    ids = np.empty((len(start), 2), np.int32)
    ids[:, 0] = mix64((sums.take(stop) - first) * back) & most
    ids[:, 1] = mix64((sums.take(np.minimum(stop, start + LEAD)) - first) * back + np.uint64(1)) & most
    ids[:, 1] += BUCKETS
    return start, ids


def _pieces(data: bytes) -> Iterator[bytes]:
    """Pieces of _PIECE bytes that end behind a blank, or at the next blank."""
    at = 0
    while at < len(data):
        end = len(data) if at + _PIECE >= len(data) else (data.rfind(b" ", at, at + _PIECE) + 1 or data.find(b" ", at + _PIECE) + 1 or len(data))
        yield data[at:end]
        at = end


def words_of(texts: Iterable[str | None]) -> Iterator[list[np.ndarray]]:
    """word_ids() of each text, in lists of texts of some _PIECE bytes."""
    for some in together((text.lower().encode() if text else b"" for text in texts), len, _PIECE):
        if len(some) == 1:
            ids = [_hashed(piece)[1] for piece in _pieces(some[0].translate(_WORDS))]
            yield [np.concatenate(ids) if ids else _NONE]
        else:
            start, ids = _hashed(b" ".join(some).translate(_WORDS))
            yield np.split(ids, np.searchsorted(start, np.cumsum([len(data) + 1 for data in some])[:-1]))


def word_ids(text: str) -> np.ndarray:
    """(words, 2): bucket of each word and of its beginning."""
    return next(words_of([text]))[0]


def _columns() -> list[tuple[int, int, int]]:
    """(width, place within the filter, first column of the projected table) of each block of FILTERS columns."""
    out, at = [], 0
    for width in WIDTHS:
        for place in range(width):
            out.append((width, place, at))
            at += FILTERS
    return out


COLUMNS = _columns()
PAD = max(WIDTHS) - 1
_NONE = np.zeros((0, 2), np.int32)
_BEHIND = [np.full((n, 2), -1, np.int32) for n in range(PAD + 2)]


def pieces(docs: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The texts one behind the other, BLOCK words at once: of which text each piece is, where it begins, in how many places a filter may begin there, and the words (-1 behind a text's end).
    A piece is followed by the PAD words behind it; a text is in one piece of a block."""
    cuts = ((i, at, min(max(len(doc) - at, 1), BLOCK)) for i, doc in enumerate(docs) for at in range(0, max(len(doc), 1), BLOCK))
    for some in together(cuts, lambda cut: cut[2] + PAD, BLOCK + PAD):
        of, first, valid = np.array(some).T
        parts = []
        for i, at, n in some:
            part = docs[i][at : at + n + PAD]
            parts += [part, _BEHIND[n + PAD - len(part)]]
        yield of, np.cumsum(valid + PAD) - valid - PAD, valid, np.concatenate([*parts, _BEHIND[1]])


def embed(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Rows of the words, of whole word and beginning together; zeros where there is none."""
    rows = table.take(ids[:, 0], axis=0)
    rows += table.take(ids[:, 1], axis=0)
    rows[ids[:, 0] < 0] = 0
    return rows


@dataclass
class Cnn:
    embedding: np.ndarray
    filters: np.ndarray  # DIMS x columns of COLUMNS
    bias: np.ndarray  # of each filter
    weights: np.ndarray
    offset: float

    @classmethod
    def new(cls, seed: int = 1) -> Cnn:
        rng = np.random.default_rng(seed)
        embedding = rng.normal(0, 0.02, (2 * BUCKETS, DIMS)).astype(np.float32)
        filters = rng.normal(0, 0.3, (DIMS, FILTERS * len(COLUMNS))).astype(np.float32)
        n = FILTERS * len(WIDTHS)
        return cls(embedding, filters, np.full(n, -0.3, np.float32), np.abs(rng.normal(0, 0.3, n)).astype(np.float32), -0.5)

    def answers(self, rows: np.ndarray, valid: int) -> np.ndarray:
        """Of each filter at each of the first `valid` places, from projected rows with PAD zero rows behind them."""
        return across(rows.T, valid).T

    def logits(self, table: np.ndarray, texts: list[str | None]) -> np.ndarray:
        """table: embedding @ filters. A text without words has the answers of an empty one: zeros."""
        return np.array([look([self], table, ids)[0][0] for some in words_of(texts) for ids in some])

    def logit(self, pooled: np.ndarray) -> np.ndarray:
        """Of each row, in sums of its own (a product's last bits would depend on the rows beside it)."""
        return (np.maximum(pooled + self.bias, 0) * self.weights).sum(axis=-1) + self.offset


def across(projected: np.ndarray, valid: int) -> np.ndarray:
    """(filters, places): the answers at the first `valid` places. projected: a row for each of COLUMNS, along the words."""
    out = np.empty((FILTERS * len(WIDTHS), valid), np.float32)
    for width, place, at in COLUMNS:
        own = out[WIDTHS.index(width) * FILTERS :][:FILTERS]
        here = projected[at : at + FILTERS, place : place + valid]
        if place:
            own += here
        else:
            own[...] = here
    return out


def look(nets: list[Cnn], table: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """look_all() of one text."""
    logits, sums = look_all(nets, table, [ids])
    return logits[0], sums[0]


def look_all(nets: list[Cnn], table: np.ndarray, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each text the logit of each net, and the sums over the words of the columns behind those of the nets. table: embedding @ filters of each net, side by side, and columns of any other kind."""
    wide = FILTERS * len(COLUMNS)
    pooled = np.full((len(nets), len(docs), FILTERS * len(WIDTHS)), -np.inf, np.float32)
    sums = np.zeros((len(docs), table.shape[1] - wide * len(nets)))
    for of, starts, valid, ids in pieces(docs):
        rows = embed(table, ids)
        runs = np.stack([starts, starts + valid], axis=1).ravel()  # a piece, what lies behind it
        for k in range(len(nets)):
            top = np.maximum.reduceat(across(rows[:, k * wide : (k + 1) * wide].T, len(ids) - PAD), runs, axis=1)[:, ::2]
            pooled[k, of] = np.maximum(pooled[k, of], top.T)
        if sums.shape[1]:
            sums[of] += np.add.reduceat(rows[:, wide * len(nets) :], runs, axis=0, dtype=np.float64)[::2]
    return np.stack([net.logit(p) for net, p in zip(nets, pooled)], axis=1), sums


class Learner:
    """A net with what its steps remember. `packed` is all of it as rows of DIMS + 1 numbers: a row for each bucket (embedding and the sum of squares), then the rest."""

    def __init__(self, net: Cnn):
        self.net, self.t = net, 0.0
        self.squares = np.full((2 * BUCKETS, 1), 1e-3, np.float32)
        self.m, self.v = ([np.zeros_like(a) for a in (net.filters, net.bias, net.weights)] for _ in range(2))

    def packed(self) -> np.ndarray:
        net = self.net
        rest = np.concatenate([np.ravel(x) for x in (net.filters, net.bias, net.weights, *self.m, *self.v, net.offset, self.t)])
        rest = np.append(rest, np.zeros(-len(rest) % (DIMS + 1)))
        return np.concatenate([np.hstack([net.embedding, self.squares]), rest.reshape(-1, DIMS + 1)]).astype(np.float32)

    @classmethod
    def of(cls, packed: np.ndarray) -> Learner:
        n = FILTERS * len(WIDTHS)
        self = cls(Cnn(packed[: 2 * BUCKETS, :DIMS].copy(), np.zeros((DIMS, FILTERS * len(COLUMNS)), np.float32), np.zeros(n, np.float32), np.zeros(n, np.float32), 0.0))
        self.squares = packed[: 2 * BUCKETS, DIMS:].copy()
        rest, at = packed[2 * BUCKETS :].ravel(), 0
        for a in (self.net.filters, self.net.bias, self.net.weights, *self.m, *self.v):
            a[...] = rest[at : at + a.size].reshape(a.shape)
            at += a.size
        for v in self.v:
            np.maximum(v, 0, out=v)  # means are rounded
        self.net.offset, self.t = float(rest[at]), float(rest[at + 1])
        return self

    def best(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For each text and filter the greatest answer, and the buckets of the words where it stands: (texts, filters, words of the widest filter, 2), -1 behind the end."""
        net, n = self.net, FILTERS * len(WIDTHS)
        pooled, words = np.full((len(docs), n), -np.inf, np.float32), np.full((len(docs), n, PAD + 1, 2), -1, np.int32)
        for of, starts, valid, ids in pieces(docs):
            answers = across(net.filters.T @ embed(net.embedding, ids).T, len(ids) - PAD)
            place = np.stack([start + answers[:, start : start + many].argmax(axis=1) for start, many in zip(starts, valid)])
            top = answers[np.arange(n), place]
            better = top > pooled[of]
            pooled[of] = np.where(better, top, pooled[of])
            words[of] = np.where(better[..., None, None], ids[place[..., None] + np.arange(PAD + 1)], words[of])
        return pooled, words

    def step(self, docs: list[np.ndarray], labels: np.ndarray, share: np.ndarray) -> None:
        """Logistic loss with weights of texts. The gradient of a pooled filter goes to the words where it answered most."""
        net = self.net
        pooled, words = self.best(docs)
        hidden = np.maximum(pooled + net.bias, 0)
        p = 1 / (1 + np.exp(-np.clip(hidden @ net.weights + net.offset, -60, 60)))
        d = ((p - labels) * share / len(docs)).astype(np.float32)
        d_hidden = np.outer(d, net.weights) * (hidden > 0)
        embedded = net.embedding[words[..., 0]] + net.embedding[words[..., 1]]
        embedded[words[..., 0] < 0] = 0
        d_filters, touched, moves = np.zeros_like(net.filters), [], []
        for width, place, at in COLUMNS:
            own = slice(WIDTHS.index(width) * FILTERS, (WIDTHS.index(width) + 1) * FILTERS)
            g = d_hidden[:, own]
            d_filters[:, at : at + FILTERS] = np.einsum("nfd,nf->df", embedded[:, own, place], g)
            use = (words[:, own, place, 0] >= 0) & (g != 0)
            touched.append(words[:, own, place][use])
            moves.append((g[:, :, None] * net.filters[:, at : at + FILTERS].T)[use])
        where, move = np.concatenate(touched), np.concatenate(moves)
        rows, back = np.unique(where.T.ravel(), return_inverse=True)
        d_rows = np.zeros((len(rows), DIMS), np.float32)
        np.add.at(d_rows, back, np.concatenate([move] * 2))
        self.squares[rows] += (d_rows**2).mean(axis=1, keepdims=True)
        net.embedding[rows] -= RATE * d_rows / np.sqrt(self.squares[rows])
        self.t += 1
        for a, g, m, v in zip((net.filters, net.bias, net.weights), (d_filters, d_hidden.sum(axis=0), hidden.T @ d), self.m, self.v):  # Adam
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= RATE * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.99**self.t)) + 1e-6)
        net.offset -= RATE * float(d.sum())


class Walk:
    """One walk over a shard from a packed net; `share` weighs texts by their label."""

    def __init__(self, packed: np.ndarray, share: tuple[float, float], seed: tuple[int, ...]):
        self.before, self.learner, self.share, self.rng = packed, Learner.of(packed), np.array(share), np.random.default_rng(seed)
        self.docs, self.labels, self.words, self.n = [], [], 0, 0

    def take(self, doc: np.ndarray, label: int) -> None:
        self.docs.append(doc)
        self.labels.append(label)
        self.words += len(doc)
        self.n += 1
        if len(self.docs) >= MIXED_TEXTS or self.words >= MIXED_WORDS:
            self.steps()

    def steps(self) -> None:
        labels, order = np.array(self.labels, np.float32), self.rng.permutation(len(self.docs))
        for first in range(0, len(order), BATCH):
            some = order[first : first + BATCH]
            self.learner.step([self.docs[i] for i in some], labels[some], self.share[labels[some].astype(int)])
        self.docs, self.labels, self.words = [], [], 0

    def moves(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the packed net that moved, and their moves times the texts of the shard as whole numbers."""
        self.steps()
        moved = self.learner.packed().astype(np.float64) - self.before
        rows = np.flatnonzero((moved != 0).any(axis=1))
        return rows, np.rint(moved[rows] * self.n * UNIT).astype(np.int64)


def log_odds(held: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """For each bucket the shrunk log-odds of label 1 among the texts that hold it, halved; 0 for rare ones. The first embedding column starts from these.
    held: (2, buckets) texts of each label; texts: all texts of each label."""
    ratio = max(texts[0], 1) / max(texts[1], 1)
    odds = np.log((held[1] + SHRINK) * ratio / (held[0] + SHRINK * ratio))
    return np.where(held.sum(axis=0) >= SEEN, odds / 2, 0).astype(np.float32)


def fresh(held: np.ndarray, texts: np.ndarray) -> Cnn:
    """A net that starts from log-odds."""
    net = Cnn.new()
    net.embedding[:, 0] = log_odds(held, texts)
    net.filters[0] = np.concatenate([np.full(FILTERS, 1.0 / width) for width, _, _ in COLUMNS])
    return net


def threshold(places: np.ndarray, labels: np.ndarray, n: np.ndarray) -> float:
    """The middle between the two neighbouring logits that part the labels best, a false alarm's share counting twice; the widest gap of equals. Logits are places of the grid, n the texts of a label there."""
    x, back = np.unique(places, return_inverse=True)
    zeros, ones = (np.bincount(back, weights=np.where(labels == k, n, 0), minlength=len(x)) for k in (0, 1))
    if len(x) < 2:
        return float(x[0]) / GRID
    below, above = np.cumsum(zeros) / max(zeros.sum(), 1), 1 - np.cumsum(ones) / max(ones.sum(), 1)
    quality, gap = np.round((2 * below + above)[:-1], 9), np.diff(x)
    at = max(range(len(gap)), key=lambda i: (quality[i], gap[i]))
    return float((x[at] + x[at + 1]) / 2 + 0.5) / GRID


def language_columns(words: np.ndarray) -> np.ndarray:
    """words: of each language, in each bucket. (buckets, languages): the logarithm of a language's share of a bucket over that of all texts."""
    together = (words.sum(axis=0) + 1) / (words.sum() + words.shape[1])
    own = words / np.maximum(words.sum(axis=1, keepdims=True), 1)
    return np.log(OWN * own / together + (1 - OWN)).T.astype(np.float32)


@dataclass
class Toxicity:
    nets: list[Cnn]
    table: np.ndarray | None  # as in look(); behind the nets, columns of the languages
    common: np.ndarray  # threshold of each net
    own: dict[int, np.ndarray]  # of languages, by their column

    def look(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Logits and the language of each text, -1 if there is none."""
        logits, sums = look_all(self.nets, self.table, docs)
        words = np.array([len(ids) for ids in docs])
        return logits, np.where(words > 0, sums.argmax(axis=1), -1) if sums.shape[1] else np.full(len(docs), -1)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.nets:
            return np.zeros(len(texts))
        out = [np.zeros(0)]
        for docs in words_of(texts):
            logits, languages = self.look(docs)
            beyond = logits - np.array([self.own.get(language, self.common) for language in languages.tolist()])
            out.append(1 / (1 + np.exp(-np.clip(beyond.mean(axis=1), -30, 30))))
        return np.concatenate(out)


def _docs(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Column `ids` as arrays: buckets of words, and of beginnings less BUCKETS, by two bytes each."""
    for x in batch.column("ids"):
        yield np.frombuffer(x.as_buffer(), np.uint16).reshape(-1, 2).astype(np.int32)


def _sparse(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns.values()], list(columns))


def labelled_words(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, lang_col: str) -> DataFrame:
    """shard, label, lang, ids of all rows outside the held-out fold that have a text and a label of 0 or 1 (a document with several labels has the greatest; a row that is repeated
    with its text counts once). A document's shard comes from its id; rows of a shard lie together, in an order by chance."""
    marked = labels.select(F.col(id_col).cast("long").alias("of"), F.col(label_col).cast("int").alias("label")).where(~in_fold(F.col("of")) & F.col("label").isin(0, 1))
    marked = cut(marked.groupBy("of").agg(F.max("label").alias("label")), "toxic-labels")
    n = marked.count()
    shards = 2 * max(1, -(-n // (2 * SHARD)))
    rows = docs.select(F.col(id_col).cast("long").alias("of"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(~in_fold(F.col("of")) & F.col("text").isNotNull())
    rows = rows.join(small(marked, n), "of").withColumn("shard", F.pmod(F.hash("of"), F.lit(shards))).repartition(shards, "shard")  # by the shard itself: whole shards, however many partitions there are
    rows = rows.groupBy("shard", "of", "label", "text").agg(F.max("lang").alias("lang"))
    rows = rows.sortWithinPartitions("shard", F.xxhash64(F.lit(11), "of", "text"), "of", "text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [ids.astype(np.uint16).tobytes() for some in words_of(batch.column(3).to_pylist()) for ids in some]
        return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ids, pa.binary())], ["shard", "label", "lang", "ids"])

    return cut(map_batches(rows.select("shard", "label", "lang", "text"), work, "shard int, label int, lang string, ids binary"), "toxic-words")


def counted(rows: DataFrame, nets: int, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(nets, 2, buckets): texts of each net's rows and label that hold a bucket. (languages, buckets): words, for `names` and, last, all other languages."""
    column = {name: i for i, name in enumerate(names)}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words = np.zeros((nets * 2, 2 * BUCKETS), np.int64), {}

        def out(group: int, n: np.ndarray) -> pa.RecordBatch:
            at = np.flatnonzero(n)
            return _sparse({"part": np.full(len(at), group), "bucket": at, "n": n[at]})

        for batch in batches:
            for shard, label, lang, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), _docs(batch)):
                here, n = np.unique(ids, return_counts=True)
                held[shard % nets * 2 + label, here] += 1
                if names and lang is not None:
                    at = column.get(lang, len(names))
                    if at not in words:
                        words[at] = np.zeros(2 * BUCKETS, np.int64)
                    words[at][here] += n
            if len(words) > HELD_LANGUAGES:
                yield from (out(nets * 2 + at, n) for at, n in words.items())
                words = {}
        yield from (out(at, n) for at, n in enumerate(held))
        yield from (out(nets * 2 + at, n) for at, n in words.items())

    found = rows.mapInArrow(count, "part long, bucket long, n long").groupBy("part", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    sums = np.zeros((nets * 2 + len(names) + 1, 2 * BUCKETS))
    sums[found.part, found.bucket] = found.n
    return sums[: nets * 2].reshape(nets, 2, -1), sums[nets * 2 :]


def learned(rows: DataFrame, nets: list[Cnn], texts: np.ndarray) -> list[Cnn]:
    """The nets after EPOCHS walks over all rows; a shard belongs to one net. texts: of each net and label."""
    share = [(0.5 * t.sum() / max(t[0], 1), 0.5 * t.sum() / max(t[1], 1)) for t in texts]
    packed = [Learner(net).packed() for net in nets]
    columns = [f"c{i}" for i in range(DIMS + 1)]
    for epoch in range(EPOCHS):
        shared = rows.sparkSession.sparkContext.broadcast(packed)

        def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, own = -1, None

            def out() -> pa.RecordBatch:
                at, moves = own.moves()
                return _sparse({"net": np.full(len(at), now % len(nets)), "at": at, "n": np.full(len(at), own.n), **dict(zip(columns, moves.T))})

            for batch in batches:
                for shard, label, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _docs(batch)):
                    if shard != now:
                        if own:
                            yield out()
                        now, own = shard, Walk(shared.value[shard % len(nets)], share[shard % len(nets)], (epoch, shard))
                    own.take(ids, label)
            if own:
                yield out()

        sums = rows.mapInArrow(walk, ", ".join(f"{c} long" for c in ("net", "at", "n", *columns))).groupBy("net", "at").agg(*(F.sum(c).alias(c) for c in ("n", *columns)))
        for net, found in sums.toArrow().to_pandas().groupby("net"):
            packed[net] = packed[net].copy()
            packed[net][found["at"].to_numpy()] += (found[columns].to_numpy() / UNIT / found[["n"]].to_numpy()).astype(np.float32)
        shared.destroy()
    return [Learner.of(p).net for p in packed]


def calibrated(rows: DataFrame, model: Toxicity) -> None:
    """Sets the thresholds of each net from all rows that it was not learned from (of a single net, from all rows), those of a language where it has CALIBRATE of each label for every net."""
    shared, nets = rows.sparkSession.sparkContext.broadcast(model), len(model.nets)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter()
        for batch in batches:
            taken = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _docs(batch))
            for some in together(taken, lambda row: len(row[2]), BLOCK):
                logits, languages = shared.value.look([ids for _, _, ids in some])
                places = np.clip(np.floor(logits * GRID), -FAR, FAR).astype(int).tolist()
                for (shard, label, _), language, place in zip(some, languages.tolist(), places):
                    for net in range(nets):
                        if nets == 1 or shard % nets != net:
                            seen[net, language, label, place[net]] += 1
        if seen:
            yield _sparse(dict(zip(("net", "language", "label", "place", "n"), np.array([(*k, n) for k, n in seen.items()]).T)))

    keys = ("net", "language", "label", "place")
    found = rows.mapInArrow(count, ", ".join(f"{c} long" for c in (*keys, "n"))).groupBy(*keys).agg(F.sum("n").alias("n")).toArrow().to_pandas()

    def of(some) -> np.ndarray:
        by_net = [some[some.net == k] for k in range(nets)]
        return np.array([threshold(x.place.to_numpy(), x.label.to_numpy(), x.n.to_numpy()) for x in by_net])

    model.common = of(found)
    for language, some in found.groupby("language"):
        enough = min(some.n[(some.net == k) & (some.label == label)].sum() for k in range(nets) for label in (0, 1))
        if 0 <= language < model.table.shape[1] - nets * FILTERS * len(COLUMNS) - 1 and enough >= CALIBRATE:
            model.own[int(language)] = of(some)
    shared.destroy()


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", lang_col: str = "lang") -> Toxicity:
    """Learns from all rows of labelled_words(), texts of any length. The driver holds the nets, counts of buckets by language (of languages with CALIBRATE rows of each label), and logits counted on a grid."""
    rows = labelled_words(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, lang_col=lang_col)
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    texts = np.zeros((2, 2))
    for r in rows.groupBy((F.col("shard") % 2).alias("half"), "label").agg(F.count("*").alias("n")).collect():
        texts[r.half, r.label] = r.n
    if not texts.sum(axis=0).all():
        return Toxicity([], None, np.zeros(0), {})
    if texts.min() < HALVES:
        texts = texts.sum(axis=0, keepdims=True)
    by_language = rows.where("lang IS NOT NULL").groupBy("lang").agg(F.sum("label").alias("ones"), F.count("*").alias("n"))
    names = sorted(r.lang for r in by_language.where((F.col("ones") >= CALIBRATE) & (F.col("n") - F.col("ones") >= CALIBRATE)).collect())
    held, words = counted(rows, len(texts), names)
    nets = learned(rows, [fresh(h, t) for h, t in zip(held, texts)], texts)
    table = np.concatenate([*(net.embedding @ net.filters for net in nets), language_columns(words)], axis=1)
    model = Toxicity(nets, table, np.zeros(len(nets)), {})
    calibrated(rows, model)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs.

    Score and prediction come from the text alone. A null or empty text is scored as one without words. With no training rows of both labels every score is
    0. A null id is held out. Repeated rows are scored each; an empty table gives no rows. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, lang_col=lang_col))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = shared.value.scores(batch.column(2).to_pylist())
        columns = [batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32), pa.int32())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    doc_id = F.col(id_col).cast("long")
    rows = docs.select(doc_id.alias("doc_id"), in_fold(doc_id).alias("held_out"), F.col(text_col).alias("text"))
    return map_batches(rows, work, "doc_id long, held_out boolean, score double, predicted int")
