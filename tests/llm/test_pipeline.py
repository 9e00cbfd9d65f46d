"""The pipeline's stages and its whole run, against plain versions."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from threadloom.llm import language_id, mixing

from .common_rows import rows
from .test_operators import ascii_words, plain_decontamination, plain_targets
from .test_against_plain import plain_links, plain_sample

STAGE = dict(corpus_pipeline.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents in two languages with near copies, benchmark passages, nulls and short texts, and a benchmark."""
    at = tmp_path_factory.mktemp("corpus")
    rng = random.Random(11)
    words = {"aa": [f"{a}{b}a" for a in "bcdfg" for b in "aeiou"], "bb": [f"s{a}{b}t" for a in "hklmn" for b in "aeiou"]}
    text = lambda lang, n: " ".join(rng.choices(words[lang], k=n))
    items = [(i, text("aa", 14)) for i in range(4)] + [(9, None), (10, "")]
    docs = []
    for i in range(240):
        lang = rng.choice(["aa", "bb"])
        t = text(lang, rng.randint(20, 120))
        if i % 10 == 3:
            t = docs[i - 1][1] + " again"  # nearly the one before
        if i % 15 == 4:
            t = docs[rng.randrange(i)][1]
        if i % 12 == 5:
            t += " " + items[i % 4][1]
        docs.append((i, t, lang if i % 7 else None, rng.choice(["x", "y", "z", None]), len(t)))
    docs += [(500, None, "aa", "x", 0), (501, "", "aa", "x", 0), (502, "12 !?", "bb", "y", 5), (503, "qzxw " * 300, None, "y", 0), (504, text("aa", 3), "aa", "z", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at), docs, items


def plain_run(spark, at, docs, items):
    """doc_id and n_tokens of each record, in order, by plain code; only the model and the draws come from the operators."""
    frame = spark.read.parquet(f"{at}/documents.parquet")
    said = language_id.fit(frame).predict([d[1] for d in docs])
    kept = [d for d, (_, _, rejected) in zip(docs, said) if not rejected]
    root = plain_links([(d[0], d[1]) for d in kept], 5, 80)
    kept = [d for d in kept if root[d[0]] == d[0]]
    kept = [d for d in kept if not plain_decontamination(d[1], [x for x in items if x[1]])[4]]
    size = {d[0]: len(d[1].encode().split()) for d in kept}
    by = defaultdict(list)
    for d in kept:
        by[d[3]].append((d[0], size[d[0]]))
    targets = plain_targets({s: sum(n for _, n in some) for s, some in by.items()})
    ids = spark.createDataFrame([(d[0], d[1]) for d in kept], "doc_id long, text string")
    u = {r.doc_id: (((r.h % 2**64) >> 11) + 0.5) / 2**53 for r in ids.select("doc_id", F.xxhash64(F.lit(1), "doc_id", F.xxhash64("text")).alias("h")).collect()}
    times = {}
    for source, some in by.items():
        total = sum(n for _, n in some)
        copies = math.floor(targets[source] / total + 1e-12)
        chance = targets[source] / total - copies
        more = plain_sample(some, chance, targets[source] - copies * total, u) if chance > 0 else set()
        times |= {i: copies + (i in more) for i, _ in some}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, start = [], 0
    for d in sorted(kept):
        ids = [*library.encode(d[1], add_special_tokens=False).ids, 1]
        for _ in range(times[d[0]]):
            out.append((d[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    return out


def test_run_is_the_plain_run(spark, folder):
    at, docs, items = folder
    found = sorted(tuple(r) for r in corpus_pipeline.run(spark, at).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    want = plain_run(spark, at, docs, items)
    assert Counter((i, n, c) for i, _, n, c in found) == Counter((i, n, c) for i, _, n, c in want)
    assert sorted(s for _, s, _, _ in found) == sorted(s for _, s, _, _ in want)
    ids = {i for i, *_ in found}
    assert 50 < len(ids) < 240 and not {500, 501, 502} & ids


def test_stages_keep_the_columns_and_handle_odd_rows(spark, folder):
    at, _, _ = folder
    odd = rows(spark).withColumn("n_chars", F.length("text"))
    for name in ("language", "near_copies", "benchmark_passages", "mixture"):
        out = STAGE[name](spark, odd, at)
        assert out.columns == odd.columns, name
        kept = {r.doc_id for r in out.select("doc_id").collect()}
        assert kept <= {r.doc_id for r in odd.select("doc_id").collect()}
        assert STAGE[name](spark, odd.limit(0), at).count() == 0, name
    language = STAGE["language"](spark, odd, at)
    assert language.where("text IS NULL OR trim(text) = '' OR text = '12 !?'").count() == 0
    once = [r.doc_id for r in STAGE["near_copies"](spark, odd, at).collect() if r.doc_id is not None]
    assert len(once) == len(set(once)) and 0 in once
    mixed = Counter(r.doc_id for r in STAGE["mixture"](spark, odd, at).collect())
    assert mixed == Counter({i: n for i, n in Counter({r.doc_id: 0 for r in odd.collect()}).items() if n}) + Counter(i for r in mixing.mix(odd).collect() for i in [r.doc_id] * r.copies)
    records = STAGE["token_ids"](spark, odd, at)
    assert Counter(r.doc_id for r in records.collect()) == Counter(r.doc_id for r in odd.collect())
    assert STAGE["token_ids"](spark, odd.limit(0), at).count() == 0


def test_benchmark_stage_takes_what_holds_a_passage(spark, folder):
    at, docs, items = folder
    frame = spark.read.parquet(f"{at}/documents.parquet")
    kept = {r.doc_id for r in STAGE["benchmark_passages"](spark, frame, at).collect()}
    assert kept == {d[0] for d in docs if not plain_decontamination(d[1], [x for x in items if x[1]])[4]} and ascii_words(docs[0][1])
    assert frame.columns == COLUMNS
