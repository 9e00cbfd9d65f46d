"""Operators against plain versions of what they say they do, on rows that their bounds and borders matter for."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import decontamination, language_id, license_scan, line_templates, lz_fingerprint, mixing, near_dedup, toxicity

from .common_rows import rows
from .test_operators import ascii_words, bag, lower, plain_decontamination, plain_phrases


# ---- licenses ----
def plain_detections(text):
    """(start, end, label, confidence) that stay: each rule over the whole text, then suppression by every other interval."""
    low = lower(text)
    found = [(m.start(), -m.end(), i, label, confidence) for i, _, label, regex, confidence in license_scan.rules() for m in re.finditer(regex, low)]
    kept = []
    for d in sorted(found):
        if not any(o[0] <= d[0] and -o[1] >= -d[1] for o in kept):
            kept.append(d)
    return [(s, -e, label, confidence) for s, e, _, label, confidence in kept]


def test_license_labels_by_brute_force(spark):
    rng = random.Random(1)
    parts = ["MIT License", "Apache License, Version 2.0", "GNU General\nPublic License", "gnu lesser general public license v2.1", "SPDX-License-Identifier: GPL-2.0-or-later", "CC BY-SA 4.0", "creative commons attribution 3.0", "all rights reserved", "Permission is hereby granted, free of charge, to any person obtaining a copy",
             "redistribution and use in source and binary forms, with or without modification", "neither the name", "licensed under", "example", "replace it", "mpl 2.0", "osl-3.0", "copyright (c) 2020", "in the public domain", "access", "é ünï", "cc_by", "accBy", "apache 2.0", "what the fuck", "x", "for non commercial research only", "Non-Profit Open Software License 3.0", "wx Windows Library Licence"]
    texts = [" ".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(60)]
    texts += [" ".join(rng.choices(parts, k=3000)), "y " * 4090 + "MIT License " + "z " * 3000 + "gpl 3.0", "x" * 8185 + " mit license, apache license", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in license_scan.license_scan(df).collect()}
    for i, text in enumerate(texts):
        want = plain_detections(text or "")
        assert [(s.start, s.end, s.label, s.confidence) for s in found[i].spans] == want, i
        words = ascii_words(text)
        base = {label for p, label in license_scan.BASE.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()}
        assert found[i].labels == ",".join(sorted(base | {d[2] for d in want}))
        assert found[i].score == max([d[3] for d in want] + [0.6 if base else 0.0])


def test_license_scan_is_linear_and_independent_of_ansi(spark):
    df = spark.createDataFrame([(1, "mit license " * 100_000), (2, None)], "doc_id long, text string")
    license_scan.license_scan(df.where("doc_id = 2")).collect()
    began = time.time()
    row = license_scan.license_scan(df.where("doc_id = 1")).select("n_base", "n_words", F.size("spans").alias("n")).first()
    assert tuple(row) == (100_000, 200_000, 100_000) and time.time() - began < 120
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        row = license_scan.license_scan(df.where("doc_id = 2")).first()
        assert (row.n_words, row.n_base, row.first_word, row.labels, row.score) == (0, 0, None, "", 0.0)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


# ---- benchmark passages ----
def test_a_large_set_goes_in_blocks_without_a_shuffle_of_words(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdef", k=rng.randint(1, 6)))
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 80)))) for i in range(60)]
    items = [(i, " ".join(docs[i][1].split()[3:20])) for i in range(0, 60, 3)] + [(100, "a"), (101, " ".join(word() for _ in range(30)))]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    n = ["doc_id", "key", "start", "n_words", "item"]
    one = decontamination.occurrences(df, bench)
    many = decontamination.occurrences(df, bench, set_bytes=4000)
    assert bag(many.collect(), *n) == bag(one.collect(), *n) and one.count() > 20
    plan = many._jdf.queryExecution().executedPlan().toString()
    # the set's own gates and what was found are dealt out, documents' words are not
    assert plan.count("Scan parquet") > 4 and set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan)) == {"gate", "doc_id"}
    found = decontamination.decontamination(df, bench).collect()
    assert bag(found, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == Counter((i, *plain_decontamination(t, items)) for i, t in docs)


# ---- lines ----
def plain_templates(line):
    """Templates of a line as tuples, and whether it is one word."""
    tokens = line.lower().split()
    n = len(tokens)
    if not n:
        return [], False
    unspaced = sum(0xE00 <= ord(c) <= 0xFFF or 0x1000 <= ord(c) <= 0x109F or 0x1780 <= ord(c) <= 0x17FF or 0x3040 <= ord(c) <= 0x30FF or 0x3400 <= ord(c) <= 0x9FFF or 0xF900 <= ord(c) <= 0xFAFF or 0x20000 <= ord(c) <= 0x3FFFF for c in tokens[0])
    if n == 1 and unspaced < 8:
        return [("word", tokens[0])], True
    general = ["<*>" if any(c.isdecimal() for c in t) else t for t in tokens]
    literal = sum(t != "<*>" for t in general)
    t = general if literal >= 3 else tokens
    out = [("all", n, *t)]
    if n >= 12 and literal >= 5:
        half = (n + 1) // 2
        for name, part in (("front", t[:half]), ("back", t[half:]), ("even", t[::2]), ("odd", t[1::2])):
            if sum(x != "<*>" for x in part) >= 5:
                out.append((name, n, *t[:2], *part))
    return out, False


def test_lines_against_a_plain_tree(spark):
    rng = random.Random(3)
    pool = ["Seen 12 times by 7 users", "all rights reserved", "menu", "page 3", "1 2 3", "你好世界你好世界", "你好", "", " ", *(" ".join(rng.choices("abcdefgh", k=rng.randint(1, 18))) for _ in range(30))]
    vary = lambda line: line if rng.random() < 0.6 else " ".join(str(rng.randint(0, 99)) if w.isdigit() or rng.random() < 0.1 else w for w in line.split())
    docs = [(i, "\n".join(vary(rng.choice(pool)) for _ in range(rng.randint(0, 8)))) for i in range(80)]
    held, first = defaultdict(set), {}
    for i, t in docs:
        for line in t.split("\n"):
            for key in plain_templates(line)[0]:
                held[key].add(i)
    for key, ids in held.items():
        if len(ids) >= (10 if key[0] == "word" else 2):
            first[key] = min(ids)
    want = Counter((i, "\n".join(line for line in t.split("\n") if not any(first.get(k, i) != i for k in plain_templates(line)[0]))) for i, t in docs)
    found = line_templates.deduplicated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert bag(found, "doc_id", "clean_text") == want


# ---- language, toxicity ----
def plain_vector(model, text):
    counts = np.zeros(language_id.DIMS)
    data = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in (" " + text.lower() + " ").encode())
    for n in language_id.GRAMS:
        for i in range(len(data) - n + 1):
            x = (int.from_bytes(data[i : i + n], "little") * 0x9E3779B1 + n * 0x85EBCA6B) % 2**32
            counts[((x ^ x >> 15) * 0x2C1B3C6D) % 2**32 >> 19] += 1
    v = np.log1p(counts) * model.idf
    size = lambda n: min(int(math.log2(n + 1)), language_id.SIZES - 1)
    return v / np.linalg.norm(v), size((counts > 0).sum()), size(counts.sum())


def test_language_scores_by_hand(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.fit(docs)
    texts = [r.text[:700] for r in docs.limit(40).collect()] + ["zxq " * 300, "Ein kurzer Satz.", "Ünïcode 中文"]
    texts = [t for t in texts if language_id.has_letter(t)]
    for text, (language, score, rejected) in zip(texts, model.predict(texts)):
        v, size, length = plain_vector(model, text)
        best = [max(float(v @ c) for c, o in zip(model.centroids, model.owner) if o == k) for k in range(len(model.languages))]
        order = sorted(range(len(best)), key=lambda k: -best[k])
        assert language == model.languages[order[0]] or best[order[0]] - best[model.languages.index(language)] < 1e-5
        assert score == pytest.approx(best[order[0]] / (best[order[0]] + best[order[1]]), abs=1e-4)
        limit = max(model.least[order[0], size], 0.3 * model.least[order[0], length])
        assert rejected == (best[order[0]] < limit) or abs(best[order[0]] - limit) < 1e-5


def test_short_and_rare_texts_can_be_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    # one language with few texts, of one length
    docs = docs.unionByName(docs.where("lang = 'en'").limit(12).withColumn("lang", F.lit("xx")).withColumn("doc_id", F.col("doc_id") + 10_000_000))
    model = language_id.fit(docs)
    assert "xx" in model.languages and (model.least[:, 6:] > 0).all()
    known = [r.text for r in docs.where("lang in ('de', 'fr')").limit(150).collect()]
    pieces = [" ".join(t.split()[k : k + n]) for t in known for n in (6, 12, 25) for k in (0, 30) if len(t.split()) > k + n]
    assert np.mean([r[2] for r in model.predict(pieces)]) < 0.01


def test_toxicity_scores_by_hand():
    net = toxicity.Cnn.new(3)
    net.bias[:] = 0.05
    table = net.embedding @ net.filters
    texts = ["one two three", "", None, "word", "Ärger UND viele, viele Worte " * 30]
    for text, got in zip(texts, net.logits(table, texts)):
        ids = toxicity.word_ids(text) if text else np.zeros((0, 2), int)
        words = [net.embedding[a] + net.embedding[b] for a, b in ids] or [np.zeros(toxicity.DIMS)]
        logit = net.offset
        for w, width in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                blocks = [at for wd, _, at in toxicity.COLUMNS if wd == width]
                answers = [sum(float(words[i + k] @ net.filters[:, at + f]) for k, at in enumerate(blocks) if i + k < len(words)) for i in range(len(words))]
                j = w * toxicity.FILTERS + f
                logit += max(max(answers) + net.bias[j], 0) * net.weights[j]
        assert got == pytest.approx(logit, abs=1e-4)


# ---- mixture ----
def plain_sample(docs, chance, rest, u):
    """Documents (id, size) by Pareto rank, up to the wanted words: one that goes beyond them stays if more than half of it fits."""
    mean = sum(s * math.log2(s + 2) for _, s in docs) / sum(s for _, s in docs)
    p = {i: min(chance * math.log2(s + 2) / mean, 1.0) for i, s in docs}
    rank = {i: u[i] * (1 - p[i]) / (u[i] * (1 - p[i]) + p[i] * (1 - u[i])) for i, _ in docs}
    taken, words = set(), 0
    for i, s in sorted(docs, key=lambda d: (rank[d[0]], d[0])):
        if words + s / 2 > rest:
            break
        taken.add(i)
        words += s
    return taken


def test_the_mix_is_the_pareto_sample(spark):
    rng = random.Random(4)
    docs = [(i, " ".join("w" for _ in range(rng.choice([1, 3, 10, 40, 200, 1500]))) + f" {i}", rng.choice(["a", "b", "c", "d", None])) for i in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in mixing.mix(df).collect()}
    drawn = df.select("doc_id", F.xxhash64(F.lit(1), "doc_id", F.xxhash64("text")).alias("h")).collect()
    u = {r.doc_id: (((r.h % 2**64) >> 11) + 0.5) / 2**53 for r in drawn}
    by = defaultdict(list)
    for i, t, s in docs:
        by[s].append((i, len(t.split())))
    sampled = 0
    for some in by.values():
        target, size = found[some[0][0]].target, sum(s for _, s in some)
        copies = math.floor(target / size + 1e-12)
        taken = plain_sample(some, target / size - copies, target - copies * size, u) if target / size - copies > 0 else set()
        assert {i for i, _ in some if found[i].copies == copies + 1} == taken
        sampled += bool(taken)
    assert sampled >= 2


def test_rows_alike_are_in_or_out_together(spark):
    df = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same words").alias("text"), F.lit("a").alias("source"))
    df = df.unionByName(spark.range(300).select("id", F.lit("other words here").alias("text"), F.lit("b").alias("source")).toDF("doc_id", "text", "source"))
    found = mixing.mix(df).groupBy("source", "doc_id").agg(F.countDistinct("copies").alias("n")).collect()
    assert all(r.n == 1 for r in found) and mixing.mix(df).count() == 3300


def test_many_sources(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 17 + 1).cast("int")).alias("text"), F.concat(F.lit("host"), (F.col("id") % 1300).cast("string")).alias("source"))
    got = {r.source: (r.source_size, r.target) for r in mixing.mix(df).select("source", "source_size", "target").distinct().collect()}
    from .test_operators import plain_targets

    want = plain_targets({s: n for s, (n, _) in got.items()})
    assert {s: t for s, (_, t) in got.items()} == pytest.approx(want)


# ---- near copies ----
def plain_links(docs, width, percent):
    """Components of ids by brute force; an id may have several texts."""
    sets = []
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        if w:
            sets.append((i, frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1)))))
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, s) in enumerate(sets):
        for b, t in sets[:k]:
            common = len(s & t)
            if 100 * common >= percent * (len(s) + len(t) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def test_an_id_with_several_texts_keeps_all_links(spark):
    rng = random.Random(5)
    text = lambda: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(60))
    a, b, c = text(), text(), text()
    docs = [(7, a), (7, b), (8, a + " one"), (9, b + " one"), (3, c), (12, c), (12, a), (20, text()), (20, text()), (21, None), (22, ""), (20, None)]
    found = near_dedup.near_dedup(spark.createDataFrame(docs, "doc_id long, text string"), width=3, percent=85).collect()
    want = plain_links(docs, 3, 85)
    assert all(r.component_id == want[r.doc_id] for r in found if r.n_shingles) and len(found) == len(docs)
    assert {r.doc_id: r.component_id for r in found if r.n_shingles}[9] == 3
    assert all(r.component_id == r.doc_id for r in found if not r.n_shingles)


def test_blocks_of_a_large_group_are_bounded_and_complete(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 64)
    monkeypatch.setattr(near_dedup, "ROUNDS", 0)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(900):  # one text with so many words changed that many pairs are not linked
        w = list(base)
        for at in rng.sample(range(120), rng.choice([1, 4, 6, 8])):
            w[at] = f"x{i}_{at}" if rng.random() < 0.5 else f"x{at}"
        docs.append((i, " ".join(w)))
    groups = []
    plain = near_dedup._blocks

    def watched(*args):
        out = plain(*args)
        groups.extend(r.n for r in out.groupBy("bucket", "ask_block", "block").agg(F.count("*").alias("n")).collect())
        return out

    monkeypatch.setattr(near_dedup, "_blocks", watched)
    found = near_dedup.near_dedup(spark.createDataFrame(docs, "doc_id long, text string"), width=3, percent=85).collect()
    want = plain_links(docs, 3, 85)
    assert {r.doc_id: r.component_id for r in found} == want and len(set(want.values())) > 5
    assert groups and max(groups) <= 4 * 64


# ---- fingerprints ----
def test_fingerprints_where_ids_are_shared(spark):
    rng = random.Random(7)
    text = lambda: "".join(rng.choices("abc é", k=rng.randint(0, 90)))
    docs = [(i % 5 if i < 120 else None if i < 150 else i, text()) for i in range(200)] + [(3, "the same row")] * 40 + [(None, None)] * 20
    df = spark.createDataFrame(docs, "doc_id long, text string")
    tie = {r.t: r.h for r in df.select(F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(((i, t or "") for i, t in docs), key=lambda d: (d[0] is not None, d[0] or 0, tie[d[1]]), reverse=True)
    sign = lambda t: lz_fingerprint.least(lz_fingerprint.hashes(list(plain_phrases(t.encode()))))
    want = Counter()
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        k = len(t) // 3
        edited = t[: len(t) - k] + following[:k]
        near = lz_fingerprint.likeness(sign(t), sign(edited)), lz_fingerprint.likeness(sign(t), sign(following))
        want[i, len(t), hashlib.sha256(edited.encode()).hexdigest(), sign(edited).astype(">u4").tobytes().hex(), *near] += 1
    for partitions in ("3", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        found = lz_fingerprint.lz_fingerprints(df).collect()
        assert bag(found, "doc_id", "n_chars", "edited_sha256", "edited_fingerprint", "near_edited", "near_next") == want
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert lz_fingerprint.lz_fingerprints(rows(spark)).count() == rows(spark).count()
