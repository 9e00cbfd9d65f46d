"""Each operator against a plain version, over rows that hold every odd case; and over an empty table."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadloom.llm import binary_records, decontamination, language_id, license_scan, line_templates, lz_fingerprint, mixing, near_dedup, token_counts, token_ids, toxicity

from .common_rows import rows


@pytest.fixture(scope="module")
def odd(spark):
    return rows(spark).cache()


@pytest.fixture(scope="module")
def pairs(odd):
    return [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def ascii_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def bag(found, *columns):
    return Counter(tuple(r[c] for c in columns) for r in found)


def test_license_scan(odd, pairs, spark):
    more = ["GNU General, Public-License. cc by CC-BY 4.0", "mit license " * 300, "SPDX-License-Identifier: MPL-2.0", "Apache License, Version 2.0 and the GNU Lesser General Public License"]
    df = odd.select("doc_id", "text").union(spark.createDataFrame(enumerate(more, 100), "doc_id long, text string"))
    found = license_scan.license_scan(df).collect()
    want = Counter()
    for doc_id, text in [*pairs, *enumerate(more, 100)]:
        w = ascii_words(text)
        at = [(i, label) for p, label in license_scan.BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        want[doc_id, len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))] += 1
    assert bag(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want
    by = {r.doc_id: r for r in found}
    assert by[102].labels == "mpl-2.0" and by[103].labels == "apache,apache-2.0,lgpl"
    assert [s.label for s in by[103].spans] == ["apache-2.0", "lgpl"]  # the general one inside is suppressed
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in found)
    assert len(license_scan.rules()) > 200 and license_scan.license_scan(odd.limit(0)).count() == 0


def test_rules_are_gated_by_words_that_they_need():
    for _, keyword, label, regex, _ in license_scan.rules():
        assert re.compile(regex) and keyword and label
        for between, maybe in ((" ", ""), (" ", " "), ("\n", "-"), ("-", "")):
            plain = regex.replace(r"\W{1,6}", between).replace(r"\W{0,6}", maybe).replace("licen[cs]e", "license")
            assert re.search(license_scan.HINT, plain), (keyword, plain)
            assert keyword in plain.replace("\\", ""), (keyword, plain)


def test_token_counts(odd, pairs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    found = token_counts.token_counts(odd, path).collect()
    n = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    assert bag(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == Counter((i, len((t or "").encode()), n(t), n(t) > 512) for i, t in pairs)
    assert token_counts.token_counts(odd.limit(0), path).count() == 0


def test_token_counts_of_hard_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    hard = ["a<|endoftext|>b <|endoftext|>", "  x\n\n y\t z ", "I'LL don't we've", "\x1c\x85\xa0a", "՘\U00011de0ab", "1²½ 12345", "\r\n 　x", "…" * 50, "éé"]
    found = token_counts.token_counts(spark.createDataFrame(enumerate(hard), "doc_id long, text string"), path).collect()
    assert {r.doc_id: r.n_tokens for r in found} == {i: len(library.encode(t).ids) for i, t in enumerate(hard)}


def test_whole_tokens_are_proven():
    merges = token_counts.Merges(public_tokenizers.path("byte_bpe_50k.json"))
    assert merges.merge(b" the") == [b" the"] and merges.merge(b"qzx") != [b"qzx"]


def plain_decontamination(doc, items):
    w, hit, names = ascii_words(doc), set(), set()
    for name, text in items:
        b = ascii_words(text)
        n = min(10, len(b))
        grams = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if b else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                names.add(str(name))
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def test_decontamination(odd, pairs, spark):
    t = {i: x for i, x in pairs}
    items = [(1, " ".join(t[2].split()[2:16]).upper()), (10, t[3]), (2, "x"), (4, None), (5, ""), (6, "Straße ÄÖ"), (6, "other words"), (10, t[3])]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit(0))
    found = decontamination.decontamination(odd, bench).collect()
    assert bag(found, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == Counter((i, *plain_decontamination(x, [(a, b) for a, b in items if b])) for i, x in pairs)
    clean = decontamination.remove_documents(odd, bench)
    assert clean.columns == odd.columns and clean.count() == sum(not r.contaminated for r in found)
    spans = decontamination.remove_spans(odd, bench)
    assert spans.columns == odd.columns and spans.count() == len(pairs) and not any(r.contaminated for r in decontamination.decontamination(spans, bench.where("item_id <> 2")).collect())
    assert decontamination.decontamination(odd.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in decontamination.decontamination(odd, bench.limit(0)).collect())


def plain_lines(docs):
    held = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            for k in line_templates.template_keys(line):
                held[k].add(i)
    first = {k: min((i for i in v if i is not None), default=-1) for k, v in held.items() if len(v) > 1}
    out = Counter()
    for i, t in docs:
        lines = [] if t is None else t.split("\n")
        kept = [x for x in lines if not any(first.get(k, i) != i for k in line_templates.template_keys(x))]
        out[i, len(lines), len(lines) - len(kept), None if t is None else "\n".join(kept)] += 1
    return out


def test_line_templates(odd, pairs, spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()
    changed = [*words[:7], *"one other ending of the same length".split()]
    more = [(100, " ".join(words) + "\nonly here are words"), (101, "seen 12 times by 7 users\n\nshort"), (102, "Seen 99 times by 1 users\nshort"), (103, " ".join(changed)), (104, "1 2 3 4 5"), (105, "6 7 8 9 10"), (106, "1 2 3 4 5\n")]
    rows_ = [(i, t) for i, t in {(i, t) for i, t in pairs if i != 0 and i != 7}] + more
    df = spark.createDataFrame(rows_, "doc_id long, text string").withColumn("key", F.lit(1))
    found = line_templates.deduplicated_lines(df).collect()
    assert bag(found, "doc_id", "n_lines", "n_dropped", "clean_text") == plain_lines(rows_)
    by = {r.doc_id: r.clean_text for r in found}
    assert by[102] == "short" and by[103] == "" and by[105] == "6 7 8 9 10" and by[106] == "" and by[101].startswith("seen 12")
    assert line_templates.deduplicated_lines(odd).count() == len(pairs)
    assert line_templates.deduplicated_lines(df.limit(0)).count() == 0


def test_binary_records_round_trip(odd, pairs):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    manifest = binary_records.write_records(odd, path, partitions=3)
    found = binary_records.read_records(manifest, with_ids=True).collect()
    ids = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 1]
    assert Counter((r.doc_id, tuple(r.ids)) for r in found) == Counter((i, tuple(ids(t))) for i, t in pairs)
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.n_tokens == len(r.ids) for r in found)
    ordered = sorted(found, key=lambda r: r.start)
    assert [r.start for r in ordered] == [0, *np.cumsum([r.n_tokens for r in ordered])[:-1].tolist()]
    known = [r.doc_id for r in ordered if r.doc_id is not None]
    assert known == sorted(known)
    shard = binary_records.ShardReader(manifest.first().path)
    assert [len(shard[i][1]) for i in reversed(range(len(shard)))] == shard.index["ids"][::-1].tolist()
    assert binary_records.read_records(binary_records.write_records(odd.limit(0), path)).count() == 0


def test_a_damaged_record_is_refused():
    record = bytearray(binary_records.frame(b"payload"))
    assert bytes(binary_records.unframe(memoryview(record), 0)[0]) == b"payload"
    for at in (3, 9, 14, len(record) - 1):
        broken = bytearray(record)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            binary_records.unframe(memoryview(broken), 0)


@pytest.mark.parametrize("text", ["ΑΣ Σ", "İ ı", "\x00 a\x00", "<|endoftext|>x<|startoftext|>", "²½ª µ ß", "\x1c\x85a\xa0b", "don't WE'LL", "é", "a" * 300])
def test_piece_ids(text):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = token_ids.PieceIds(path)
    assert np.frombuffer(pieces.encode(text), pieces.dtype).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_language_id(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.language_id(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    held = found[found.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97 and held.score.between(0, 1).all() and found.rejected.mean() < 0.01
    assert (found.held_out == found.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    few = language_id.language_id(odd).collect()
    assert len(few) == odd.count() and {r.lang_pred for r in few} <= {"en", "de", "und"}
    assert all((r.lang_pred == "und") == (not language_id.has_letter(t)) for r, t in zip(few, [r.text for r in odd.select("text").collect()]))
    kept = language_id.accepted(odd)
    assert kept.columns == odd.columns and kept.where("text IS NULL OR text = '12 !?'").count() == 0
    assert language_id.language_id(odd.limit(0)).count() == 0 and language_id.accepted(odd.limit(0)).count() == 0


def test_far_texts_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(docs)
    assert [r[2] for r in model.predict(["zxq " * 400, "Привет как дела " * 60, docs.first().text, "zxq"])] == [True, True, False, False]


def test_toxicity(spark, odd):
    at = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{at}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.toxicity(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held = found[found.held_out]
    assert held[held.toxic == 1].predicted.mean() > 0.8 and held[held.toxic == 0].predicted.mean() < 0.05
    assert ((found.score >= 0.5) == (found.predicted == 1)).all()
    marks = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(3, None), (None, 1), (4, 1)], "doc_id long, toxic int").withColumn("label", F.lit(9))
    few = toxicity.toxicity(odd, marks).collect()
    assert len(few) == odd.count() and all(0 <= r.score <= 1 for r in few)
    assert all(r.score == 0 for r in toxicity.toxicity(odd, marks.where("toxic = 1")).collect())
    assert toxicity.toxicity(odd.limit(0), marks).count() == 0


def test_cnn_takes_long_texts_in_pieces():
    net = toxicity.Cnn.new()
    table = net.embedding @ net.filters
    text = " ".join(f"w{i % 977}" for i in range(20_000))
    ids = toxicity.word_ids(text)
    whole = np.zeros((len(ids) + toxicity.PAD, table.shape[1]), np.float32)
    whole[: len(ids)] = table[ids[:, 0]] + table[ids[:, 1]]
    pooled = net.answers(whole, len(ids)).max(axis=0)
    assert net.logits(table, [text])[0] == pytest.approx(np.maximum(pooled + net.bias, 0) @ net.weights + net.offset, abs=1e-4)


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    wanted, capped = 1.5 * sum(sizes.values()), set()
    while True:
        level = (wanted - sum(2 * sizes[s] for s in capped)) / max(sum(weight[s] for s in names if s not in capped), 1e-9)
        more = {s for s in names if s not in capped and level * weight[s] > 2 * sizes[s]}
        if not more:
            return {s: 2 * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= more


def test_mixing(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("source", F.when(F.col("doc_id") % 9 == 0, None).when(F.col("doc_id") % 3 == 0, "src0").otherwise(F.col("source")))
    found = mixing.mix(docs).toPandas()
    found["source"] = found.source.astype(object).where(found.source.notna(), None)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in found.itertuples():
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size
    want = plain_targets(sizes)
    assert target == pytest.approx(want)
    assert all(abs(taken[s] - target[s]) <= found[found.source.map(lambda x: x == s)]["size"].max() for s in target)
    again = mixing.mix(docs.orderBy(F.desc("doc_id")).repartition(7)).toPandas()
    assert found.set_index("doc_id").taken.sort_index().equals(again.set_index("doc_id").taken.sort_index())
    few = mixing.mix(odd).collect()
    assert Counter((r.doc_id, r.size) for r in few) == Counter((r.doc_id, len((r.text or "").encode().split())) for r in odd.select("doc_id", "text").collect())
    assert mixing.mix(odd.limit(0)).count() == 0
    mixed = mixing.mixed_rows(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r.copies for r in few)
    assert mixing.mixed_rows(odd.limit(0)).count() == 0


def test_sampling_takes_each_document_by_its_chance(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w "), F.col("id").cast("string")).alias("text"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"))
    n = Counter()
    for seed in range(3):
        for r in mixing.mix(docs, seed=seed).where("source = 'a'").collect():
            n[r.copies] += 1
    assert n[1] + n[2] == 6000 and abs(n[2] / 6000 - (mixing.mix(docs).where("source = 'a'").first().target / 4000 - 1)) < 0.01


def plain_components(docs, width, percent):
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets[i] = frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_dedup(spark, odd, pairs, width, percent):
    rng = np.random.default_rng(1)
    base = [f"w{x}" for x in rng.integers(0, 99999, 120)]
    more = []
    for i in range(150):  # copies about the threshold, enough for a large bucket
        w = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 7)):
            w[at] = f"x{rng.integers(0, 99999)}"
        more.append((1000 + i, " ".join(w)))
    for i in range(30):  # a chain
        base[(i * 7) % 120] = f"y{i}"
        more.append((2000 + i, " ".join(base)))
    more += [(3000, "One two"), (3001, "one TWO"), (3002, "one"), (3003, "É b c d e f"), (3004, "é b c d e f")]
    df = odd.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    found = near_dedup.near_dedup(df, width=width, percent=percent).collect()
    unique = {i: t for i, t in pairs if i is not None and not (i == 7 and t != pairs[7][1])}
    assert len(found) == len(pairs) + len(more)
    want = plain_components([*unique.items(), *more], width, percent)
    for r in found:
        if r.doc_id is not None and r.doc_id != 7:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert near_dedup.near_dedup(odd.limit(0)).count() == 0


def test_deduplicated_keeps_one_of_each(odd):
    kept = near_dedup.deduplicated(odd)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == odd.columns and len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})
    assert not {30, 31, 32, 33} & set(ids) and {0, 1, 2, 3} <= set(ids) and near_dedup.deduplicated(odd.limit(0)).count() == 0


def test_circulant_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    both, one, two = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (700, 150, 150))
    sign = near_dedup.Circulant(256)
    a, b = sign(np.concatenate([both, one])), sign(np.concatenate([both, two]))
    assert abs((a == b).mean() - 0.7) < 0.12


def test_word_hashes_are_those_of_words():
    h = near_dedup.word_hashes("One two\tONE  z two\n")
    assert len(h) == 5 and h[0] == h[2] and h[1] == h[4] and len(set(h.tolist())) == 3


def plain_phrases(data):
    known, word = {}, b""
    for i in range(len(data)):
        word += data[i : i + 1]
        if word not in known:
            known[word] = i + 1
            word = b""
    return known


def test_lz_fingerprint(odd, pairs, spark):
    docs = [(i, t or "") for i, t in dict(pairs).items() if i is not None and i not in (0, 7)]
    df = odd.where("doc_id IS NOT NULL AND doc_id NOT IN (0, 7)")
    found = {r.doc_id: r for r in lz_fingerprint.lz_fingerprints(df).collect()}
    order = sorted(docs, reverse=True)
    sign = lambda t: lz_fingerprint.least(lz_fingerprint.hashes(list(plain_phrases(t.encode()))))
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        k = len(t) // 3
        edited = t[: len(t) - k] + following[:k]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.edited_fingerprint == sign(edited).astype(">u4").tobytes().hex() and r.fingerprint == sign(t).astype(">u4").tobytes().hex()
        assert r.near_next == lz_fingerprint.likeness(sign(t), sign(following)) and 0 <= r.near_edited <= 1
    assert len({r.fingerprint for r in found.values() if r.n_chars > 100}) <= len({t for _, t in docs if len(t) > 100})
    whole = lz_fingerprint.lz_fingerprints(odd).collect()
    assert Counter(r.doc_id for r in whole) == Counter(i for i, _ in pairs)
    assert lz_fingerprint.lz_fingerprints(odd.limit(0)).count() == 0
    alone = lz_fingerprint.lz_fingerprints(spark.createDataFrame([(5, "abcabc")], "doc_id long, text string")).first()
    assert alone.near_next == 1.0


def test_components_of_a_path_and_a_star(spark):
    from threadloom.llm.components import components, extended

    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(None, 1), (3, None), (200, 200)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
    more = extended(found, spark.createDataFrame([(40, 139), (139, 300)], "a long, b long"))
    assert {r.component for r in more.collect()} == {0} and more.count() == 82
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_queries_and_sql_have_the_same_names():
    from threadloom.llm import queries

    assert set(queries.oracle_sql()) <= set(queries.queries()) and len(queries.queries()) == 10
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.queries()) == list(range(1, 11))


def least_text(regex, between):
    """The shortest text of a rule, `between` between its words."""
    from re import _parser as parser

    def of(parts):
        out = ""
        for kind, value in parts:
            name = str(kind)
            if name == "LITERAL":
                out += chr(value)
            elif name == "IN":
                first, held = value[0]
                out += between if "NOT_WORD" in str(held) else chr(held[0] if isinstance(held, tuple) else held) if str(first) in ("LITERAL", "RANGE") else " "
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                out += of(value[2]) * value[0]
            elif name == "SUBPATTERN":
                out += of(value[3])
            elif name == "BRANCH":
                out += of(value[1][0])
        return out

    return of(parser.parse(regex))


def test_license_rules_pass_their_gates(spark):
    for between in (" ", "\n"):
        for _, keyword, label, regex, _ in license_scan.rules():
            text = least_text(regex, between)
            assert re.search(regex, text), (label, text)
            assert keyword in text and re.search(license_scan.HINT, text), (label, text)
    texts = [(0, "Universal Permissive License", "upl-1.0"), (1, "Creative\nCommons Attribution 4.0", "cc-by-4.0"), (2, "a BSD style license", "bsd"), (3, "in the public\ndomain", "public-domain"), (4, "all\nrights reserved", "all-rights-reserved")]
    found = license_scan.license_scan(spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")).collect()
    assert {r.doc_id: r.labels for r in found} == {i: label for i, _, label in texts}


def test_short_lines_recur_too(spark):
    rows_ = [(i, t) for i, t in enumerate(["all rights reserved.\n你好世界你好世界你好\nno", "x\nAll rights reserved.\n\n你好世界你好世界你好\nno"])] + [(10 + i, "menu\nand more words of document %s" % "abcdefghijkl"[i]) for i in range(12)]
    by = {r.doc_id: r.clean_text for r in line_templates.deduplicated_lines(spark.createDataFrame(rows_, "doc_id long, text string")).collect()}
    assert by[0] == rows_[0][1] and by[1] == "x\n\nno"
    assert by[10].startswith("menu\n") and not any("menu" in by[i] for i in range(11, 22))


def test_rejection_by_length(spark):
    """Noise of many scripts from ten words on is rejected, texts of the corpus are not; limits rise with the size."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(docs)
    assert (np.diff(model.least, axis=1) >= 0).all()
    rng = random.Random(99)
    words = lambda n, a: " ".join("".join(rng.choices(a, k=rng.randint(2, 9))) for _ in range(n))
    for first, last in ((0x61, 0x7B), (0x430, 0x450), (0x10D0, 0x10F0), (0x5000, 0x5E00)):
        letters = "".join(map(chr, range(first, last)))
        for n in (10, 50, 200, 1000):
            assert sum(r[2] for r in model.predict([words(n, letters) for _ in range(30)])) >= 27, (letters[:1], n)
        assert sum(r[2] for r in model.predict(["".join(rng.choices(letters, k=1000)) for _ in range(30)])) >= 27
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(3000).collect() if language_id.has_letter(r.text)]
    assert sum(r[2] for r in model.predict(texts)) <= 0.005 * len(texts)


def test_every_language_is_learned(spark):
    words = {f"l{i}": "".join(chr(0x4E00 + 40 * i + k) for k in range(20)) for i in range(60)}
    rng = random.Random(1)
    rows_ = [(i, "".join(rng.choices(words[f"l{i % 60}"], k=80)), f"l{i % 60}") for i in range(900)]
    df = spark.createDataFrame(rows_, "doc_id long, text string, lang string")
    found = language_id.language_id(df).join(df.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(language_id.fit(df).languages) == 60 and sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)
