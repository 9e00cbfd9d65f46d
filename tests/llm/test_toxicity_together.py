"""The toxicity operator works on the texts of a batch together, with the scores that each text has alone."""

import random

import numpy as np
import pytest

from threadloom.llm import toxicity
from threadloom.llm.near_dedup import _LETTERS, mix64

ODD = [None, "", "  .,; ", "a", "ΑΣ ΣΑΣ", "é 日本 x-y", "x" * 90_000 + " y " + "z" * 70_000, " ".join(f"w{i % 5000}" for i in range(30_000)), "end"]


def test_a_batch_is_hashed_together(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "EPOCHS", 2)
    rng = random.Random(3)
    rows = [(i, " ".join(["vile"] * (i % 2) + [f"w{rng.randrange(50)}" for _ in range(6)]), "en") for i in range(120)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame([(i, i % 2) for i, _, _ in rows], "doc_id long, toxic int"))
    calls = []
    monkeypatch.setattr(toxicity, "mix64", lambda x: calls.append(len(x)) or mix64(x))
    texts = [text for _, text, _ in rows] * 2 + ODD
    found = model.scores(texts)
    assert len(calls) < 30  # two for each text, as it was, are 490
    assert (found == [model.scores([text])[0] for text in texts]).all()
    assert found[1] > 0.5 > found[0] and len(model.scores([])) == 0


def test_words_of_texts_together():
    def bucket(data, more):
        total, power = 0, 1
        for c in data:
            total, power = (total + int(_LETTERS[c]) * power) % 2**64, power * 0x9E3779B97F4A7C15 % 2**64
        return int(mix64(np.array([(total + more) % 2**64], np.uint64))[0]) % toxicity.BUCKETS

    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abcÄé9.") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(5))) for _ in range(60)] + ODD[:6]
    rng.shuffle(texts)
    together = [ids for some in toxicity.words_of(texts) for ids in some]
    assert len(together) == len(texts)
    for text, ids in zip(texts, together):
        words = (text or "").lower().encode().translate(toxicity._WORDS).split()
        assert ids.tolist() == [[bucket(w, 0), toxicity.BUCKETS + bucket(w[: toxicity.LEAD], 1)] for w in words]
    texts = ODD + texts + ODD
    for text, ids in zip(texts, [ids for some in toxicity.words_of(texts) for ids in some]):
        assert (ids == toxicity.word_ids(text)).all()


@pytest.mark.parametrize("block", [16, 1 << 12])
def test_texts_looked_up_together(monkeypatch, block):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    rng = np.random.default_rng(5)
    nets = [toxicity.Cnn.new(k) for k in (1, 2)]
    for net in nets:
        net.embedding = rng.normal(0, 1, net.embedding.shape).astype(np.float32)
    languages = rng.normal(0, 1, (2 * toxicity.BUCKETS, 3)).astype(np.float32)
    docs = [np.stack([rng.integers(0, 99, n), toxicity.BUCKETS + rng.integers(0, 99, n)], axis=1).astype(np.int32) for n in (0, 1, 2, 3, 15, 16, 17, 18, 19, 200, 0, 4095, 4096, 4098, 9000, 1, 0)]
    logits, sums = toxicity.look_all(nets, np.concatenate([*(net.embedding @ net.filters for net in nets), languages], axis=1), docs)
    for ids, logit, total in zip(docs, logits, sums):
        embedded = [np.concatenate([net.embedding[ids].sum(axis=1), np.zeros((toxicity.PAD + (not len(ids)), toxicity.DIMS))]) for net in nets]
        places = range(max(len(ids), 1))
        for net, rows, got in zip(nets, embedded, logit):
            blocks = {(width, place): rows @ net.filters[:, at : at + toxicity.FILTERS] for width, place, at in toxicity.COLUMNS}
            pooled = [max(sum(blocks[width, k][i + k][f] for k in range(width)) for i in places) for width in toxicity.WIDTHS for f in range(toxicity.FILTERS)]
            assert got == pytest.approx(np.maximum(pooled + net.bias, 0) @ net.weights + net.offset, abs=1e-3)
        assert total == pytest.approx(languages[ids].astype(np.float64).sum(axis=(0, 1)), abs=1e-2)
