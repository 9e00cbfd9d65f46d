"""The toxicity operator learns from all labelled rows outside the held-out fold, of any number and length."""

import random
import zlib
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import toxicity


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def caught(spark, docs, marks):
    """Shares of held-out toxic and clean rows that are predicted toxic."""
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(marks, "doc_id long, toxic int")
    found = toxicity.toxicity(docs, marks).where("held_out").join(marks, "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("p"))
    return {r.toxic: r.p for r in found.collect()}


def test_words_that_only_many_texts_show(spark):
    rng = random.Random(5)
    plain = lambda n: [f"w{rng.randrange(2000)}" for _ in range(n)]
    docs, marks = [], []
    for i in range(24_000):
        words = plain(12)
        if i % 2:
            words.insert(rng.randrange(12), f"vile{i // 2 % 1000}x{i // 2 % 1000}")  # each of 1000 words in 12 toxic texts
        docs.append((i, " ".join(words).replace("vile", "zq"), "en"))
        marks.append((i, i % 2))
    # beginnings are no help
    docs = [(i, " ".join((w[::-1] if w.startswith("zq") else w) for w in t.split()), lang) for i, t, lang in docs]
    found = caught(spark, docs, marks)
    assert found[1] > 0.9 and found[0] < 0.1


def test_words_that_only_long_texts_show(spark):
    rng = random.Random(6)
    docs, marks = [], []
    for i in range(240):
        words = [f"w{rng.randrange(3000)}" for _ in range(22_000 if i % 2 else 40)]  # above 100,000 bytes
        if i % 4 == 1:
            words[len(words) // 2] = "zorkish"
        if i % 4 == 2:
            words[3] = "grumfish"
        docs.append((i, " ".join(words), "en"))
        marks.append((i, int(i % 4 in (1, 2))))
    found = caught(spark, docs, marks)
    assert found[1] > 0.9 and found[0] < 0.1


def test_counts_are_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD", 20)
    rng = random.Random(7)
    docs = [(i, " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(0, 15))), ["en", "de", "fr", None][i % 4]) for i in range(300)]
    docs += [docs[3], docs[3], (None, "w1", "en"), (5, None, "en"), (6, "w2 w3", "en")]
    marks = [(i, i % 3 % 2) for i in range(280)] + [(4, 1), (7, 0), (8, None), (9, 2), (None, 1)]
    rows = toxicity.labelled_words(
        spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(marks, "doc_id long, toxic int"), id_col="doc_id", text_col="text", label_col="toxic", lang_col="lang"
    )
    label = {}
    for i, t in marks:
        if i is not None and t in (0, 1) and not held_out(i):
            label[i] = max(t, label.get(i, 0))
    want = {(i, t, lang) for i, t, lang in docs if i in label and t is not None}
    here = rows.collect()
    assert len(here) == len(want) and len({r.shard for r in here}) > 8
    held, words = np.zeros((2, 2 * toxicity.BUCKETS)), np.zeros((2, 2 * toxicity.BUCKETS))
    for i, t, lang in want:
        n = np.bincount(toxicity.word_ids(t).ravel(), minlength=2 * toxicity.BUCKETS)
        held[label[i]] += n > 0
        if lang:
            words[0 if lang == "en" else 1] += n
    for nets in (1, 2):
        got = toxicity.counted(rows, nets, ["en"])
        assert (got[0].sum(axis=0) == held).all() and (got[1] == words).all()


def test_a_shard_is_one_run_of_rows_whatever_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD", 40)
    kind = type(spark.range(0))
    plain = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda self, n, *by: plain(self, 31, *by))
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b w"), F.col("id") % 9).alias("text"), F.lit("en").alias("lang"))
    marks = spark.range(600).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    rows = toxicity.labelled_words(docs, marks, id_col="doc_id", text_col="text", label_col="toxic", lang_col="lang")
    runs = [[k for k, _ in groupby(r.shard for r in part)] for part in rows.rdd.glom().collect()]
    assert len(sum(runs, [])) == rows.select("shard").distinct().count() > 10


def test_threshold_counts_as_single_rows():
    rng = np.random.default_rng(8)
    places, labels = rng.integers(-40, 40, 300), rng.integers(0, 2, 300)
    places[labels == 1] += 30
    keys, n = np.unique(np.stack([places, labels]), axis=1, return_counts=True)
    best = toxicity.threshold(keys[0], keys[1], n) * toxicity.GRID
    x = np.unique(places)
    quality = [2 * (places <= a)[labels == 0].mean() + (places > a)[labels == 1].mean() for a in x[:-1]]
    k = int(np.searchsorted(x, best - 1e-9)) - 1
    assert quality[k] == pytest.approx(max(quality)) and best == pytest.approx((x[k] + x[k + 1]) / 2 + 0.5)


def test_best_answers_in_pieces(monkeypatch):
    rng = np.random.default_rng(9)
    learner = toxicity.Learner(toxicity.Cnn.new(4))
    learner.net.embedding = rng.normal(0, 1, learner.net.embedding.shape).astype(np.float32)
    docs = [np.stack([rng.integers(0, 50, n), toxicity.BUCKETS + rng.integers(0, 9, n)], axis=1).astype(np.int32) for n in (0, 1, 2, 90, 33, 16)]
    whole = learner.best(docs)
    monkeypatch.setattr(toxicity, "BLOCK", 16)
    pooled, words = learner.best(docs)
    assert np.allclose(pooled, whole[0]) and (words == whole[1]).all()
    table = learner.net.embedding @ learner.net.filters
    for doc, p in zip(docs, pooled):
        assert np.maximum(p + learner.net.bias, 0) @ learner.net.weights + learner.net.offset == pytest.approx(toxicity.look([learner.net], table, doc)[0][0], abs=1e-4)
    again = toxicity.Learner.of(learner.packed())
    assert (again.packed() == learner.packed()).all() and (again.net.filters == learner.net.filters).all()


def test_steps_follow_the_gradient():
    """The gradient of a step against differences of the loss, and a walk's moves against its steps."""
    rng = np.random.default_rng(10)
    docs = [np.stack([rng.integers(0, 40, n), toxicity.BUCKETS + rng.integers(0, 40, n)], axis=1).astype(np.int32) for n in (0, 1, 2, *[9] * 61)]
    labels, share = np.array([int((d[:, 0] < 4).any()) for d in docs]), rng.uniform(0.5, 2, 64)

    def fresh():
        learner = toxicity.Learner(toxicity.Cnn.new(5))
        net = learner.net
        net.embedding = np.random.default_rng(1).normal(0, 1, net.embedding.shape)
        net.filters, net.bias, net.weights = (a.astype(float) for a in (net.filters, net.bias, net.weights))
        return learner

    def loss(net):
        table = net.embedding @ net.filters
        z = np.concatenate([toxicity.look([net], table, d)[0] for d in docs])
        return float(np.mean(share * (np.logaddexp(0, z) - labels * z)))

    stepped, net = fresh(), fresh().net
    small = np.concatenate([np.arange(40), toxicity.BUCKETS + np.arange(40)])
    for d in docs:
        d[:, 1] += 40 - toxicity.BUCKETS  # a table of 80 rows is enough
    net.embedding = net.embedding[small]
    stepped.net.embedding, stepped.squares = net.embedding.copy(), stepped.squares[small]
    stepped.step(docs, labels, share)
    rows = -(stepped.net.embedding - net.embedding) * np.sqrt(stepped.squares) / toxicity.RATE
    grads = [(net.filters, stepped.m[0] * 10), (net.bias, stepped.m[1] * 10), (net.weights, stepped.m[2] * 10), (net.embedding, rows)]
    close = []
    for a, grad in grads:
        for at in [np.unravel_index(k, a.shape) for k in rng.choice(a.size, 12, replace=False)]:
            was, by = a[at], 1e-3
            a[at] = was + by
            up = loss(net)
            a[at] = was - by
            down = loss(net)
            a[at] = was
            close.append(abs((up - down) / (2 * by) - grad[at]) < 1e-4)
    assert np.mean(close) > 0.9  # a maximum may change hands between the two losses
    docs = [d - [0, 40 - toxicity.BUCKETS] for d in docs]
    start = toxicity.Learner(toxicity.Cnn.new(5)).packed()
    walk = toxicity.Walk(start, (1.0, 1.0), (0, 0))
    for doc, label in zip(docs, labels):
        walk.take(doc, label)
    at, moves = walk.moves()
    assert np.allclose(start[at] + moves / toxicity.UNIT / 64, walk.learner.packed()[at], atol=1e-6)
    assert len(at) < 300
