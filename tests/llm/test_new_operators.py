"""Maximal repeats, importance samples and periodic runs against plain versions, over rows that hold every odd case; and over an empty table."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from threadloom.llm import importance, periodic_runs, repeats

from .common_rows import rows
from .test_operators import ascii_words, bag


@pytest.fixture(scope="module")
def odd(spark):
    return rows(spark).cache()


@pytest.fixture(scope="module")
def pairs(odd):
    return [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]


# ---- repeats ----
def plain_repeats(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append((len(t), sum(gone), sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return out


def test_intervals_are_the_maximal_repeats():
    rng = random.Random(1)
    for _ in range(150):
        length = rng.choice([3, 5, 8, 9, 20])
        base = bytes(rng.choice(b"ab" + b"cdefgh" * rng.randint(0, 1)) for _ in range(60))
        some = lambda: rng.choice([base[(x := rng.randrange(40)) : x + rng.randint(1, 30)], bytes(rng.choice(b"abcdefgh") for _ in range(rng.randint(0, 15)))])  # noqa: E731, B023
        texts = [b"".join(some() for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 8))]
        found = repeats.intervals(texts, length)
        covered = [bytearray(len(t)) for t in texts]
        groups, parent = defaultdict(list), {}
        for c, start, n, group, above in found:
            covered[c][start : start + n] = b"\1" * n
            groups[group].append((c, start, n))
            parent[group] = above
        assert [sum(c) for c in covered] == [p[1] for p in plain_repeats(texts, length)]
        for group, members in groups.items():
            strings = {texts[c][s : s + n] for c, s, n in members}
            assert len(strings) == 1 and len(strings.pop()) >= length
        # a group with those below it has all occurrences of its string
        whole = defaultdict(set)
        for group, members in groups.items():
            at = group
            while at != -1:
                n = groups[at][0][2] if at in groups else None
                if n:
                    whole[at] |= {(c, s) for c, s, _ in members}
                at = parent.get(at, -1)
        for group, places in whole.items():
            c, s, n = groups[group][0]
            string = texts[c][s : s + n]
            everywhere = {(k, i) for k, t in enumerate(texts) for i in range(len(t) - n + 1) if t[i : i + n] == string}
            assert places <= everywhere


@pytest.mark.parametrize("length, contexts, block", [(200, 4000, 1 << 20), (40, 2, 2000)])
def test_repeats(odd, pairs, spark, monkeypatch, length, contexts, block):
    monkeypatch.setattr(repeats, "CONTEXTS", contexts)
    monkeypatch.setattr(repeats, "BLOCK", block)
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh é", k=rng.randint(1, 9)))
    passage = " ".join(word() for _ in range(60))
    texts = [" ".join(word() for _ in range(rng.randint(0, 60))) + passage[rng.randint(0, 40) : rng.randint(200, 400)] + " ".join(word() for _ in range(30)) for _ in range(40)]
    texts += [passage * 3, "ab" * 700, texts[0], texts[1][:150] + "#" + texts[1][150:]]
    df = odd.select("doc_id", "text", "spans", "key").union(spark.createDataFrame([(i, t, 1, 1) for i, t in enumerate(texts, 500)], "doc_id long, text string, spans int, key int"))
    every = [*pairs, *enumerate(texts, 500)]
    want = Counter((i, *p) for (i, _), p in zip(every, plain_repeats([(t or "").encode() for _, t in every], length)))
    found = repeats.without_repeats(df, length=length)
    assert {"key", "spans", "kept", "n_bytes"} <= set(found.columns)
    assert bag(repeats.summarised(found).collect(), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert repeats.summarised(repeats.without_repeats(df.limit(0), length=length)).count() == 0


def test_long_texts_go_in_pieces(spark, monkeypatch):
    rng = random.Random(9)
    part = "".join(rng.choices("abcdefghij ", k=900))
    long = "".join(rng.choices("abcdefghij ", k=repeats.PIECE - 300)) + part + "".join(rng.choices("abcdefghij ", k=repeats.PIECE + 5000))
    df = spark.createDataFrame([(1, long), (2, "x" + part + "y")], "doc_id long, text string")
    found = {r.doc_id: r for r in repeats.without_repeats(df).collect()}
    at = long.index(part)
    assert found[1].spans == [at, at + 900] and found[2].spans == [1, 901] and found[2].kept == b"xy"


# ---- importance ----
def plain_sample(docs, target):
    def grams(text):
        w = ascii_words(text)
        return w + [" ".join(w[i : i + 2]) for i in range(len(w) - 1)]

    place = lambda g: zlib.crc32(g.encode()) % 10_000
    s, t = Counter(place(g) for _, x in docs for g in grams(x)), Counter(place(g) for x in target for g in grams(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 10_000) / ((s[b] + 1.0) * (all_t + 10_000)))) for b in s}
    out = []
    for i, x in docs:
        g = grams(x)
        weight = sum(gain[place(f)] for f in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(ascii_words(x)), len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = Counter()
    for k, r in enumerate(order[: 25 * len(order) // 100], 1):
        drawn[r, k] += 1
    return Counter((r[0], r[2], r[3], r[4]) for r in out), {(r[0], r[3], r[4], k) for r, k in drawn}


def test_importance_sample(odd, pairs, spark):
    target = [t for _, t in pairs[:5]] + [None, "", "x"]
    bench = spark.createDataFrame([(t, 1) for t in target], "text string, gain int")
    found = importance.importance_sample(odd, bench).collect()
    scored, drawn = plain_sample(pairs, target)
    assert bag(found, "doc_id", "n_features", "weight", "score") == scored
    assert {(r.doc_id, r.weight, r.score, r["rank"]) for r in found if r["rank"]} == drawn
    # a text that a third of all rows share, under one id
    many = [(1, " ".join(f"w{k}" for k in range(30)))] * 40 + [(i, " ".join(f"w{(i * k) % 97}" for k in range(25))) for i in range(2, 80)]
    got = importance.importance_sample(spark.createDataFrame(many, "doc_id long, text string").repartition(5), bench).collect()
    scored, drawn = plain_sample(many, target)
    assert bag(got, "doc_id", "n_features", "weight", "score") == scored and {(r.doc_id, r.weight, r.score, r["rank"]) for r in got if r["rank"]} == drawn
    assert importance.importance_sample(odd.limit(0), bench).count() == 0
    assert importance.importance_sample(odd, bench.limit(0)).count() == len(pairs)


# ---- runs ----
def plain_runs(w, least):
    out = []
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            s, n = i, j + p - i
            if n >= max(least, 2 * p) and next(q for q in range(1, n + 1) if w[s + q : s + n] == w[s : s + n - q]) == p:
                out.append((s, n, p))
            i = max(j, i + 1) if j == i else j + 1
    return sorted(out)


def plain_summary(doc_id, text):
    w = periodic_runs.looped(doc_id, (text or "").encode().split())
    runs = plain_runs(w, 12)
    gone = {k for s, n, p in runs for k in range(s + p, s + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return doc_id, len(runs), *top, None if top[0] is None else 1000 * top[1] // top[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()


def test_runs_of_short_words_by_brute_force():
    rng = random.Random(0)
    for _ in range(150):
        docs = [[bytes([97 + rng.randrange(rng.choice([1, 2, 3, 20]))]) for _ in range(rng.choice([0, 1, 2, 5, 20, 60]))] for _ in range(rng.randint(1, 6))]
        for least in (1, 2, 12):
            for doc, (runs, _) in zip(docs, periodic_runs._worked(docs, least, 2)):
                assert sorted(runs) == plain_runs(doc, least)


def test_periodic_runs(odd, pairs, spark):
    rng = random.Random(2)
    more = [" ".join(rng.choices("abc", k=rng.randint(0, 90))) for _ in range(60)] + ["x " * 500, "a b c d " * 30 + "e " * 40 + "a b c d " * 30]
    short = [(i, t) for i, t in pairs if len((t or "").split()) < 3000]
    every = [*short, *enumerate(more, 900)]
    df = spark.createDataFrame([(i, t, 1) for i, t in every], "doc_id long, text string, runs int")
    found = periodic_runs.summarised(periodic_runs.periodic_runs(df, edit=periodic_runs.looped)).collect()
    assert bag(found, "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256") == Counter(plain_summary(i, t) for i, t in every)
    whole = periodic_runs.periodic_runs(odd).collect()
    assert len(whole) == len(pairs) and all(r.n_words == len((t or "").encode().split()) for r, (_, t) in zip(whole, pairs))
    assert periodic_runs.summarised(periodic_runs.periodic_runs(df.limit(0))).count() == 0
