"""Operators on hand-made rows, at their boundaries."""

import difflib
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from threadloom.config import CAPACITY, RELAXED, STRICT
from threadloom.functions import repair
from threadloom.functions import text as T
from threadloom.functions.members import indented_length
from threadloom.operators import backends, batching, dedup, gate, graph, render, reports, tree
from threadloom.plans import flow, queries
from threadloom.sources import readers, sinks

LONG = "several quite different words stand here so that nothing of the gate objects to them today"


def reasons(spark, texts, **how):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    return [r.reason for r in gate.with_reason(df, "text", min_words=how.pop("min_words", 5), prefix="", **how).orderBy("id").collect()]


def test_gate_boundaries(spark):
    cases = [
        (LONG, None),
        ("one two three four", "too_few_words"),
        ("one two three four five", None),
        (None, "too_few_words"),
        ("abc abc abc abc abc abc abc abc abd abe", None),  # 3 of 10 is 0.3 exactly; the share of abc decides next
        ("ab cd ef gh ij kl", "too_short_words"),
        ("AAAA bbbb CCCC dddd eeee FFFF", None),  # half in capitals
        ("AAAA BBBB CCCC DDDD eeee ffff", "too_much_caps"),
        ("hello 😀 my 😀 dear 😀 friends 😀 over 😀 there", None),
        ("hello 😀 my 😀 dear 😀 friends 😀 over 😀 there 😀", "too_many_emojis"),
        ("word 中 other 文 third 字 fourth 汉 fifth 语 sixth 学", "too_many_emojis"),
        ("see reddit.com for more words", "blocked_url_pattern"),
        ("please unsubscribe from this long list", "spam_keyword"),
        ("see http://a.b and https://c.d but no more", None),
        ("see http://a.b or https://c.d and www.e.f", "too_many_urls"),
        ("a b　c\x1cd\x85e something longer follows", None),
        ('"""a """b """c """d """e', None),
        ("!!!!! ????? ..... ,,,,, ;;;;;", "too_much_punctuation"),
        ("spam spam spam spam other words here now", "too_repetitive"),
    ]
    got = reasons(spark, [t for t, _ in cases])
    want = [r for _, r in cases]
    want[4] = "too_repetitive"
    assert got == want


def test_metadata_goes_first(spark):
    rows = [(0, "p", None, 0, 5), (1, "p", 3, -1001, 5), (2, "p", 3, -1000, 0), (3, LONG, 1, -1000, 1), (4, "short", 3, 0, 1)]
    df = spark.createDataFrame(rows, "seq long, selftext string, author_account_age_days long, author_comment_karma long, score long")
    assert [r.reason for r in gate.gated_posts(df).orderBy("seq").collect()] == ["low_account_age", "low_karma", "low_score", None, "too_few_words"]


def test_strict_profile_looks_at_comment_scores(spark):
    df = spark.createDataFrame([(0, LONG, 5, 5, -11, None), (0, LONG, 5, 5, -10, -0.1), (11, LONG, 5, 5, 0, None)], "depth int, body string, author_account_age_days long, author_comment_karma long, score long, upvote_ratio double")
    assert [r.reason for r in gate.gated_comments(df, STRICT).collect()] == ["low_score", "low_upvote_ratio", "max_depth_exceeded"]
    assert [r.reason for r in gate.gated_comments(df).collect()] == [None, "low_upvote_ratio", "max_depth_exceeded"]


def test_sql_functions(spark):
    T.register(spark)
    row = spark.sql("SELECT word_count('a b  c') AS w, url_count('http://x www.y') AS u, is_blocked_url('microsoft.com') AS b, is_spam('Buy now') AS s, emoji_runs('😀😀 x 😀') AS e").first()
    assert (row.w, row.u, row.b, row.s, row.e) == (3, 2, True, True, 2)


def test_exact_dedup(spark):
    df = spark.createDataFrame([(1, " Same "), (0, "other"), (2, "same"), (3, None), (4, None)], "seq long, text string")
    assert sorted(r.seq for r in dedup.exact_dedup(df.where("text IS NOT NULL")).collect()) == [0, 1]


def plain_fuzzy(texts, history=100):
    seen, kept = [], []
    for i, t in enumerate(texts):
        form = t.lower().strip()
        if form in seen or any(difflib.SequenceMatcher(None, form, s).ratio() > 0.85 for s in seen[-history:]):
            continue
        seen.append(form)
        kept.append(i)
    return kept


def test_fuzzy_dedup_is_the_sequential_one(spark):
    rng = random.Random(1)
    texts = []
    for _ in range(60):
        base = "".join(rng.choices("abcde ", k=rng.randint(0, 60)))
        texts += [base, base[: len(base) // 2] + rng.choice("xyz") + base[len(base) // 2 :], base.upper()]
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, text string")
    for history in (100, 5):
        limits = RELAXED.__class__(history=history)
        assert sorted(r.seq for r in dedup.fuzzy_dedup(df, gate=limits).collect()) == plain_fuzzy(texts, history)
    pairs = {(r.new, r.old) for r in dedup.similar_pairs(dedup.place_of(df), reach=7).collect()}
    assert pairs == {(i, j) for i in range(len(texts)) for j in range(max(0, i - 7), i) if difflib.SequenceMatcher(None, texts[i].lower().strip(), texts[j].lower().strip()).ratio() > 0.85}


def test_fuzzy_dedup_carries_over_ranges(spark):
    rng = random.Random(3)
    bases = ["".join(rng.choices("abcdefgh ", k=rng.randint(10, 50))) for _ in range(40)]
    texts = []
    for _ in range(400):
        base = rng.choice(bases)
        at = rng.randint(0, len(base))
        texts.append(rng.choice([base, base.upper(), base[:at] + rng.choice("xyz") + base[at:], "".join(rng.choices("abcdefgh ", k=30))]))
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, text string")
    for history, size in ((100, 1500), (5, 600), (5, 1800)):
        limits = RELAXED.__class__(history=history)
        assert sorted(r.seq for r in dedup.fuzzy_dedup(df, gate=limits, range_bytes=size).collect()) == plain_fuzzy(texts, history)


def test_index_loses_no_similar_pair():
    rng = random.Random(7)
    far = kept = 0
    for _ in range(400):
        letters = rng.choice(["ab", "abcdefgh ", "etaoinshrdlucmfw. ,", "".join(map(chr, range(0x4E00, 0x4E80)))])
        n = rng.choice([3, 40, 199, 200, 600, 2000])
        a = "".join(rng.choices(letters, k=n))
        b = list(a)
        for _ in range(int(n * rng.choice([0, 0.02, 0.1, 0.2, 2]))):
            b[rng.randrange(len(b))] = rng.choice(["", rng.choice(letters), rng.choice(letters) * 2])
        b = "".join(b)
        ratio = difflib.SequenceMatcher(None, a, b).ratio()
        near = dedup.Close(a, 0.85).may_match(dedup.Close(b, 0.85))
        assert near or ratio <= 0.85, (a, b)
        assert dedup.Close(a, 0.85).to(b) == (ratio > 0.85)
        far, kept = far + (ratio <= 0.85), kept + (near and ratio <= 0.85)
    plain = ["".join(random.Random(i).choices(["the ", "and ", "tion", "ing ", "er", "on", "an", "re", "ent", "ha", "ti", "es, "], k=500)) for i in range(40)]
    texts = [dedup.Close(t, 0.85) for t in plain]
    passed = sum(a.may_match(b) for a in texts for b in texts if a is not b)
    assert passed <= 0.05 * 40 * 39  # texts of one vocabulary that are not alike


def test_walk_of_a_chain_needs_many_rounds(spark):
    base = "".join(random.Random(5).choices("abcdefghijklmnopqrstuvw ", k=150))
    texts = [base]
    for i in range(11):  # each is like the one before it, and like no other
        texts.append(texts[-1][: 12 * i] + "#" * 12 + texts[-1][12 * (i + 1) :])
    want = plain_fuzzy(texts)
    assert 3 < len(want) < 9
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, text string")
    found = dedup.walked(df.withColumn("at", F.lit(0)), range_bytes=1).collect()
    assert sorted(r.seq for r in found if r.status == dedup.KEPT) == want and len(found) == len(texts)
    assert dedup.walked(df.withColumn("at", F.lit(0)).limit(0)).count() == 0


def test_near_dup_pairs_reaches_the_whole_history(spark, tmp_path):
    from threadloom.plans import queries

    texts = ["".join(random.Random(i).choices("abcdefghijklmnop ", k=40)) for i in range(180)]
    texts[70], texts[110], texts[171] = (texts[10] + c for c in "xyz")  # up to 100 places apart, and from 101
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {(r.new, r.old) for r in queries.QUERIES["near_dup_pairs"](spark, str(tmp_path)).collect()}
    assert found == {(70, 10), (110, 10), (110, 70), (171, 110)}


def test_common_subsequence():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = _step(row, x, b)
        return row[-1]

    def _step(row, x, b):
        out = [0]
        for j, y in enumerate(b):
            out.append(row[j] + 1 if x == y else max(row[j + 1], out[-1]))
        return out

    rng = random.Random(2)
    for _ in range(200):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 12))) for _ in range(2))
        assert dedup.Close(a, 0.85).common(b) == plain(a, b)


TREE = [{"author": "bob", "score": 1, "body": "hi", "replies": [{"author": "cy", "score": 0, "body": "yo", "replies": []}, {"author": "di", "body": "oh"}]}, {"author": "ed", "score": 2, "body": "x"}]


def test_trees(spark):
    flat = tree.flatten_comments(spark.createDataFrame([(0, "p1", json.dumps(TREE)), (1, "p2", None), (2, "p3", "[]"), (3, "p4", "no list")], "seq long, post_id string, comments string"))
    rows = {tuple(r.path): r for r in flat.collect()}
    assert set(rows) == {(0,), (0, 0), (0, 1), (1,)} and rows[(0, 1)].author == "di" and rows[(0, 1)].depth == 1
    judged = flat.withColumn("reason", F.when(F.col("author") == "bob", "bad"))
    assert [list(r.path) for r in tree.surviving(judged).collect()] == [[1]]
    nested = json.loads(tree.renest(flat).first().comments)
    assert [c["author"] for c in nested] == ["bob", "ed"] and [c["author"] for c in nested[0]["replies"]] == ["cy", "di"]


def odd_value(rng, level=0):
    r = rng.random()
    if r < 0.3:
        return "".join(rng.choices('ab{}[]",:\\\n \u00e9\u0001', k=rng.randint(0, 12)))
    if r < 0.4:
        return rng.choice([1, 2.5, None, True, -3, 10**20])
    if level == 3:
        return "s"
    if r < 0.6:
        return [odd_value(rng, level + 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice("xyzwv") + str(i): odd_value(rng, level + 1) for i in range(rng.randint(0, 3))}


def odd_comment(rng, level=0, deepest=5):
    c = {"author": rng.choice(["a", None, "b"]), "x": odd_value(rng), "body": str(odd_value(rng, 3)), "score": rng.choice([1, None])}
    if rng.random() < 0.8:
        c["replies"] = [odd_comment(rng, level + 1, deepest) for _ in range(rng.randint(0, 2))] if level < deepest else []
    if rng.random() < 0.5:
        c["after"] = odd_value(rng)
    return c


def odd_posts(n, seed=1, deepest=5):
    rng = random.Random(seed)
    return [{"post_id": rng.choice([f"p{i}", None, "same"]), "e": odd_value(rng), "comments": [odd_comment(rng, 0, deepest) for _ in range(rng.randint(0, 3))], "z": odd_value(rng)} for i in range(n)]


def test_arrays_are_read_in_pieces_of_any_size(spark, tmp_path):
    posts = odd_posts(36)
    (tmp_path / "a.json").write_text("[]")
    (tmp_path / "b.json").write_text(json.dumps(posts[:24], indent=2))
    (tmp_path / "c.json").write_text(json.dumps(posts[24:], ensure_ascii=False))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "2500"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = readers.json_posts(spark, str(tmp_path / "*.json")).orderBy("seq").collect()
            assert [json.loads(r.raw) for r in rows] == posts and [r.seq for r in rows] == list(range(36))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(posts)], "seq long, v string")
    sinks.write_json_array(df.repartition(4), "seq", str(tmp_path / "array"))
    rows = readers.json_elements(spark, str(tmp_path / "array")).orderBy("seq").collect()
    assert [json.loads(json.loads(r.value)["v"]) for r in rows] == posts
    sinks.write_json_array(df.limit(0), "seq", str(tmp_path / "none"))
    assert readers.json_elements(spark, str(tmp_path / "none")).count() == 0


def test_lines_are_numbered_by_file_and_place(spark, tmp_path):
    posts = odd_posts(40)
    (tmp_path / "a.json").write_text("".join(json.dumps(p) + "\n" for p in posts[:3]))
    (tmp_path / "b.json").write_text("\n\n".join(json.dumps(p) for p in posts[3:]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "700"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = readers.json_posts(spark, str(tmp_path), lines=True).orderBy("seq").collect()
            assert [json.loads(r.raw) for r in rows] == posts and [r.seq for r in rows] == list(range(40))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def plain_prune(comments, bad, path=()):
    kept = []
    for i, c in enumerate(comments):
        if bad((*path, i), c):
            continue
        kept.append({**c, "replies": plain_prune(c["replies"], bad, (*path, i))} if "replies" in c else c)
    return kept


def test_trees_pass_through_and_are_pruned_whole(spark):
    posts = odd_posts(40, seed=2, deepest=15)
    df = spark.createDataFrame([(i, p["post_id"], json.dumps(p["comments"]), json.dumps(p)) for i, p in enumerate(posts)], "seq long, post_id string, comments string, raw string")
    flat = tree.flatten_comments(df, levels=None)
    assert "Python" not in flat._jdf.queryExecution().executedPlan().toString()
    back = dict(tree.renest(flat).collect())
    assert all(json.loads(back.get(i, "[]")) == p["comments"] for i, p in enumerate(posts))
    bad = lambda path, c: len(path) > 11 or (sum(path) * 7 + len(path)) % 5 == 0 and len(path) > 1
    judged = tree.flatten_comments(df).withColumn("reason", F.when((F.aggregate("path", F.lit(0), lambda a, x: a + x) * 7 + F.size("path")) % 5 == 0, F.when(F.size("path") > 1, "bad")))
    kept = tree.surviving(judged)
    back = dict(tree.renest(kept).collect())
    for i, p in enumerate(posts):
        assert json.loads(back.get(i, "[]")) == plain_prune(p["comments"], bad), i
    stats = spark.createDataFrame([(i, 2, 1) for i in range(len(posts))], "seq long, original_comments int, kept_comments int")
    for r in flow.whole_posts(df, kept, stats).collect():
        want = {**posts[r.seq], "comments": plain_prune(posts[r.seq]["comments"], bad), "_filter_stats": {"original_comments": 2, "kept_comments": 1}}
        got = json.loads(r.post_json)
        assert got == want and list(got) == list(want)


def test_indented_length(spark):
    values = [*odd_posts(40, seed=3), {}, [], [[]], {"a": {}}, "x", 1]
    df = spark.createDataFrame([(json.dumps(v, ensure_ascii=False, separators=(",", ":")), len(json.dumps(v, ensure_ascii=False, indent=2))) for v in values], "j string, n int")
    assert df.where(indented_length(F.col("j")) != F.col("n")).count() == 0


def test_posts_without_an_id_and_with_a_shared_one_keep_their_comments(spark, tmp_path):
    other, third = " ".join(reversed(LONG.split())), " ".join(sorted(LONG.split()))
    say = lambda x: f"{x} these words stand below one of the posts"
    meta = {"author_account_age_days": 9, "author_comment_karma": 9, "score": 9}
    posts = [{"selftext": LONG, **meta, "comments": [{"body": say("aaa")}], "flair": "f"}, {"post_id": "x", "selftext": other, **meta, "comments": [{"body": say("entirely bbb"), "more": [1]}]}, {"post_id": "x", "selftext": third, **meta, "comments": [{"body": say("something of ccc")}]}]
    (tmp_path / "p.json").write_text(json.dumps(posts))
    read = readers.json_posts(spark, str(tmp_path))
    run = flow.filter_run(read, tree.flatten_comments(read), RELAXED.__class__(similarity=1.0))
    good, kept = run.kept()
    whole = [json.loads(r.post_json) for r in flow.whole_posts(good, kept, run.stats()).orderBy("seq").collect()]
    assert whole == [{**p, "_filter_stats": {"original_comments": 1, "kept_comments": 1}} for p in posts]
    assert tuple(run.comment_summary().first()) == (3, 3, 0)
    m = run.metrics().first()
    assert (m.original_posts, m.kept_posts, m.rejected_posts, m.original_comments, m.kept_comments, m.rejection_reasons) == (3, 3, 0, 3, 3, [])
    texts = [r.post_text for r in render.with_text(good, kept).orderBy("seq").collect()]
    assert ["aaa" in texts[0], "bbb" in texts[1], "ccc" in texts[2]] == [True] * 3


def test_post_text(spark):
    post = spark.createDataFrame([(0, "p1", "ann", "T", 3, "hello")], "seq long, post_id string, author string, title string, score long, selftext string")
    flat = tree.flatten_comments(spark.createDataFrame([(0, "p1", json.dumps([{**TREE[0], "replies": TREE[0]["replies"][:1]}]))], "seq long, post_id string, comments string"))
    text = render.with_text(post, flat).first().post_text
    assert text == "[POST]\nID: p1\nAuthor: ann\nTitle: T\nScore: 3\nBody: hello\n[COMMENTS]\n[COMMENT]\nAuthor: bob\nScore: 1\nBody: hi\n  [COMMENT]\n  Author: cy\n  Score: 0\n  Body: yo\n  [/COMMENT]\n[/COMMENT]\n[/COMMENTS]\n[/POST]\n"


def plain_pack(sizes, capacity):
    left, out = [], []
    for s in sizes:
        fits = [(x - s, i) for i, x in enumerate(left) if x >= s]
        i = min(fits)[1] if fits else len(left)
        if not fits:
            left.append(capacity)
        left[i] -= s
        out.append(i)
    return out


def test_packing():
    assert [b for b, _ in batching.pack([9000, 8000, 7000, 6000], CAPACITY)] == [0, 1, 0, 1]
    rng = random.Random(4)
    for _ in range(50):
        sizes = sorted((rng.randint(1, 100) for _ in range(rng.randint(0, 80))), reverse=True)
        assert [b for b, _ in batching.pack(sizes, 100)] == plain_pack(sizes, 100)


def test_packing_by_counts_is_the_walk():
    rng = random.Random(6)
    for i in range(300):
        capacity = rng.choice([10, 20, 100])
        sizes = sorted((rng.choice([1, 2, 3, capacity // 2, capacity // 3 + 1, rng.randint(0, capacity)]) for _ in range(rng.randint(0, 80))), reverse=True)
        found = [None] * len(sizes)
        for place, n, each, first, pos in batching.pack_counts(sorted(Counter(sizes).items(), reverse=True), capacity):
            for k in range(n):
                found[place + k] = (first + k // each, pos + k % each)
        assert found == batching.pack(sizes, capacity)


def test_packed(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([16000, 16001, 1, 8000, 8000, 5])], "seq long, tokens long")
    one = batching.packed(df).collect()
    assert len(one) == 5 and {r.batch_index for r in one} == {1, 2, 3}
    rng = random.Random(7)
    # ids far apart and a size that a third of all posts have
    posts = [(i * 60_000, 3000 if i % 3 == 0 else rng.randint(0, 17_000)) for i in range(500)]
    order = sorted(((t, i) for i, t in posts if t <= CAPACITY), key=lambda x: (-x[0], x[1]))
    want = {i: (b + 1, p) for (_, i), (b, p) in zip(order, batching.pack([t for t, _ in order], CAPACITY))}
    found = batching.packed(spark.createDataFrame(posts, "seq long, tokens long"))
    assert {r.seq: (r.batch_index, r.pos) for r in found.collect()} == want
    sums = batching.rolled_up(found).collect()
    assert all(r.total_tokens <= CAPACITY for r in sums) and sorted(r.batch_index for r in sums) == list(range(1, len(sums) + 1))
    assert batching.utilisation(batching.packed(df.limit(0))).first().utilisation == 0


@pytest.mark.parametrize(
    "answer, names",
    [
        ('```json\n{"entities":[{"name":"A","type":"T"}],"relations":[]}\n```', ["A"]),
        ('Sure: {"entities":[{"name":"A","type":"T"}],"relations":[]}', ["A"]),
        ('{"entities":[{"name":"A","type":"T"}],"relations":[{"source":"A","target":"B","relation":"r"},{"source":"C","tar', ["A"]),
        ('{"entities":[{"name":"A","type":"T"},{"na', []),
        ("no json", []),
        ('{"entities":[{"name":"A"}]}', []),
        ("", []),
    ],
)
def test_extraction(spark, answer, names):
    row = spark.createDataFrame([(answer,)], "a string").select(repair.extraction(F.col("a")).alias("e")).first().e
    assert [e.name for e in row.entities] == names
    if "tar" in answer and names:
        assert [r.source for r in row.relations] == ["A"]


def merge_rows(spark):
    rows = [(1, "A", "B", "r1", "e1", "Unknown", "Person"), (2, "B", "A", "r2", "e2", "Person", "Org"), (3, "A", "B", "r3", "e3", "Org", "Person"), (4, "A", "A", "r4", "", "Org", "Org")]
    return spark.createDataFrame(rows, "seq long, source string, target string, relation string, evidence string, s_type string, t_type string")


def test_merges(spark):
    rows = merge_rows(spark)
    edges = {(r.source, r.target): (r.relation, r.evidence, r.weight) for r in graph.edge_merge(rows).collect()}
    assert edges == {("A", "A"): ("r4", "", 1), ("A", "B"): ("r1", "e1", 2), ("B", "A"): ("r2", "e2", 1)}
    assert {r.name: (r.type, r["count"]) for r in graph.vertex_merge(rows).collect()} == {"A": ("Unknown", 4), "B": ("Person", 2)}
    assert {r.name: r.strength for r in graph.node_strength(graph.edge_merge(rows)).collect()} == {"A": 5, "B": 3}
    assert graph.undirected(graph.edge_merge(rows)).count() == 2


def test_relation_validity(spark):
    rows = [("", "n", "t", "r"), (None, None, "t", "r"), ("s", None, "", "r"), ("s", None, "t", "  "), ("s", None, "t", "r")]
    df = spark.createDataFrame(rows, "source string, name string, target string, relation string")
    row = graph.counters(df).first()
    assert (row.added, row.skipped) == (2, 3)


def test_metrics_of_a_known_graph(spark):
    made = graph.metrics(F.lit(19), F.lit(13))
    row = spark.range(1).select(*(F.round(c, 4).alias(k) for k, c in made.items())).first()
    assert (row.average_degree, row.density) == (1.3684, 0.076)


def test_reports(spark):
    edges = graph.edge_merge(merge_rows(spark))
    found = flow.report_of(graph.vertex_merge(merge_rows(spark)), edges).collect()
    assert [r.lens for r in sorted(found, key=lambda r: r.place)] == [x[0] for x in reports.LENSES] and all(r.error is None for r in found)

    class Broken:
        def generate(self, system, user):
            raise RuntimeError

    bad = reports.lens_reports(graph.summary_lines(graph.top_edges(edges, graph.vertex_merge(merge_rows(spark)), 50)), Broken()).collect()
    assert {r.error for r in bad} == {"json_parse_failed"} and {r.raw_analysis for r in bad} == {backends.FAILED}
    assert reports.scenario_context(spark.createDataFrame([(0, "power", "s", "k", None, None)], "place int, lens string, summary string, key_insight string, risk_level string, error string")).first().context == "--- POWER LENS ---\nRisk Level: Unknown\nSummary: s\nKey Insight: k"


def test_page_escapes(spark):
    nodes = spark.createDataFrame([("</script><b>",)], "id string")
    edges = spark.createDataFrame([("a<", "b", "</script>", 1)], "source string, target string, reason string, weight int")
    page = sinks.graph_page(nodes, edges)
    assert page.count("</script>") == 1 and "a&lt;" in page


def test_network_page(spark):
    edges = graph.render_edges(graph.undirected(graph.edge_merge(merge_rows(spark))))
    assert {(r.a, r.b, r.title, r.value) for r in edges.collect()} == {("A", "A", "r4", 1.0), ("A", "B", "r2", 1.0)}
    nodes = spark.createDataFrame([("A", "A</script>", "#fff", 25.0), ("B", "B", "#fff", 75.0)], "name string, title string, colour string, size double")
    page = sinks.network_page(nodes, edges, push=10.0)
    data = json.loads(page.split("id=data>")[1].split("</script>")[0])
    assert page.count("</script>") == 2 and data["nodes"][0]["title"] == "A</script>" and data["physics"]["push"] == 10.0 and data["physics"]["steps"] == sinks.PHYSICS["steps"]


def test_streams(spark, tmp_path):
    from threadloom.streaming import gate as stream

    rows = spark.createDataFrame([(i, f"2024-01-01 0{i}:00:00", t) for i, t in enumerate([LONG, LONG.upper(), "short", LONG + " more"])], "doc_id long, time string, text string").withColumn("time", F.to_timestamp("time"))
    rows.write.parquet(str(tmp_path / "in"))
    live = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))

    def run(df, name, mode="append"):
        df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / name)).start().awaitTermination()
        return spark.table(name).collect()

    firsts = {r.text for r in run(stream.first_texts(live(), "time"), "firsts")}
    assert len(firsts) == 3 and {"short", LONG + " more"} < firsts
    counts = run(stream.windowed_reasons(stream.gated(live()), "time", "12 hours"), "reasons", "complete")
    assert sum(r["count"] for r in counts) == 4
    typed = merge_rows(spark)
    merge = stream.merge_into_graph(str(tmp_path / "graph"))
    for batch, part in ((0, typed.where("seq <= 2")), (1, typed.where("seq > 2")), (1, typed.where("seq > 2"))):
        merge(part, batch)
    edges = stream.edges_of(spark.read.parquet(str(tmp_path / "graph")))
    assert {(r.source, r.target): (r.relation, r.weight) for r in edges.collect()} == {("A", "A"): ("r4", 1), ("A", "B"): ("r1", 2), ("B", "A"): ("r2", 1)}


def test_tokens_by_a_rank_file(spark, tmp_path):
    import base64

    ranks = [bytes([i]) for i in range(256)] + [b"ab"]
    (tmp_path / "ranks").write_text("\n".join(f"{base64.b64encode(t).decode()} {i}" for i, t in enumerate(ranks)))
    count = batching.tiktoken_tokens(str(tmp_path / "ranks"), r"\S+|\s+")
    assert [r.n for r in spark.createDataFrame([("ab ab",), ("",), (None,)], "t string").select(count("t").alias("n")).collect()] == [3, 0, 0]


def test_json_source(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"post_id": "p", "score": 3, "selftext": "x", "comments": TREE, "other": 1}, {"post_id": "q"}]))
    rows = readers.json_posts(spark, str(tmp_path)).orderBy("seq").collect()
    assert [r.post_id for r in rows] == ["p", "q"] and json.loads(rows[0].comments)[0]["author"] == "bob" and rows[1].comments is None
    with pytest.raises(Exception):
        readers.json_posts(spark, str(tmp_path / "none")).count()


def test_retry_and_resume(spark):
    calls = []

    def step():
        calls.append(1)
        if len(calls) < 3:
            raise ValueError
        return "done"

    assert flow.retried(step, 3, 0)() == "done"
    with pytest.raises(ValueError):
        calls.clear()
        flow.retried(step, 2, 0)()


def test_filter_rejects_near_copies_of_posts_and_comments(spark):
    """Against the sequential run: a post, then its top-level comments, all compared with the same accepted texts."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(4, 9))) for _ in range(400)]
    pool = [" ".join(rng.sample(words, 16)) for _ in range(12)]
    some = lambda: rng.choice([" ".join(rng.sample(words, 16)), rng.choice(pool), rng.choice(pool) + " more", rng.choice(pool).title()])
    posts = [(i, i, some(), 9, 0, 9) for i in range(60)]
    comments = [(i, str(i), [j], 0, "a", 1, some(), None, "{", "}") for i in range(60) for j in range(i % 3)]
    reasons, kept_comments, texts = {}, set(), []

    def duplicate(text):
        form = text.lower().strip()
        if form in texts or any(difflib.SequenceMatcher(None, form, t).ratio() > 0.85 for t in texts[-100:]):
            return True
        texts.append(form)
        return False

    for i, _, text, *_ in posts:
        reasons[i] = "duplicate_post" if duplicate(text) else None
        if reasons[i] is None:
            kept_comments |= {(c[1], c[2][0]) for c in comments if c[0] == i and not duplicate(c[6])}
    p = spark.createDataFrame(posts, "seq long, post_id long, selftext string, author_account_age_days int, author_comment_karma int, score int")
    c = spark.createDataFrame(comments, tree.FLAT)
    assert {r.seq: r.reason for r in flow.final_reasons(p, c).collect()} == reasons
    good, kept = flow.filtered(p, c)
    assert {r.seq for r in good.collect()} == {i for i, r in reasons.items() if r is None}
    assert {(r.post_id, r.path[0]) for r in kept.collect()} == kept_comments
    assert flow.comment_summary(p, c).collect() == [(len(comments), len(kept_comments), len(comments) - len(kept_comments))]
    stats = {int(r.post_id): (r.original_comments, r.kept_comments) for r in flow.post_stats(p, c).collect()}
    assert stats == {i: (i % 3, sum(k[0] == str(i) for k in kept_comments)) for i, r in reasons.items() if r is None}


def test_comments_of_rejected_posts_are_not_seen(spark):
    other = " ".join(reversed(LONG.split()))
    posts = [(1, 1, LONG, 9, 0, 9), (2, 2, LONG, 9, 0, 9), (3, 3, other, 9, 0, 9)]
    words = "these words stand below two posts of which one is an exact copy"
    comments = [(2, "2", [0], 0, "a", 1, words, None, "{", "}"), (3, "3", [0], 0, "a", 1, words, None, "{", "}"), (3, "3", [1], 0, "b", 1, words.upper(), None, "{", "}")]
    p = spark.createDataFrame(posts, "seq long, post_id long, selftext string, author_account_age_days int, author_comment_karma int, score int")
    c = spark.createDataFrame(comments, tree.FLAT)
    assert [(r.post_id, list(r.path)) for r in flow.filtered(p, c)[1].collect()] == [("3", [0])]
    assert {(r.post_id, r.original_comments, r.kept_comments) for r in flow.post_stats(p, c).collect()} == {("1", 0, 0), ("3", 2, 1)}
    assert flow.comment_summary(p, c).collect() == [(3, 1, 2)]


def test_the_gate_works_words_out_once(spark):
    df = spark.createDataFrame([(0, LONG, 5, 5, 9)], "seq long, selftext string, author_account_age_days int, author_comment_karma int, score int")
    judged = gate.gated_posts(df)
    for rows in (judged.where("reason IS NULL").select("seq"), judged.where("reason IS NOT NULL").groupBy("reason").count(), judged):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("split(") == 1 and plan.count("too_repetitive") == 1


def test_repeats_is_the_share_of_the_most_frequent_word(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice(["aaa", "bbb", "ccc", "ddd", "e", "fff", "ggg"][: rng.randint(1, 7)]) for _ in range(rng.randint(0, 40))]) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, w array<string>")
    w = F.col("w")
    found = df.select(T.repeats(T.long_words(w), F.size(w), 0.3).alias("a"), F.coalesce(T.max_word_freq(w) > 0.3, F.lit(False)).alias("b")).collect()
    assert all(r.a == r.b for r in found) and 50 < sum(r.a for r in found) < 350


def test_a_run_stops_at_a_failed_batch_and_goes_on(spark, tmp_path):
    from threadloom.plans import progress

    path, done, broken = str(tmp_path / "p"), [], [True]
    batches = spark.range(1, 8).select(F.col("id").cast("int").alias("batch_index"))

    def step(rows):
        got = sorted(r.batch_index for r in rows.collect())
        if 5 in got and broken:
            raise ValueError("broken")
        done.append(got)

    at, failure = progress.run(batches, step, path, at_once=2)
    assert done == [[1], [2, 3]] and at == 4 and isinstance(failure, ValueError)
    broken.clear()
    assert progress.run(batches, step, path, at_once=2) == (8, None) and done == [[1], [2, 3], [4, 5], [6, 7]]
    assert progress.run(batches, step, path) == (8, None)


def test_rule_backend_keeps_all_that_it_finds(spark):
    names = [f"Name{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    text = " meets ".join(names) + " and a very long way of saying what is between them for once " + "Zed"
    row = backends.extract(spark.createDataFrame([(1, text), (2, None)], "batch_index int, text_for_llm string")).orderBy("batch_index").collect()
    assert len(row[0].entities) == 61 and len(row[0].relations) == 60 and len(row[0].relations[-1].relation) > 40 and row[1].entities == []

    class ByText:
        def generate(self, system, user):
            return backends.RuleBackend().generate(system, user)

    again = backends.extract(spark.createDataFrame([(1, text)], "batch_index int, text_for_llm string"), ByText()).first()
    assert again.entities == row[0].entities and [r.target for r in again.relations] == [r.target for r in row[0].relations]


def test_a_blank_relation_is_none(spark):
    df = spark.createDataFrame([("s", "t", "\t\n\u00a0"), ("s", "t", " r ")], "source string, target string, relation string")
    assert [r.valid for r in graph.with_validity(df).collect()] == [False, True]


def test_no_local_folder_on_a_cluster(spark):
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        sinks.shared_path(Session(), "x")


def test_files(spark, tmp_path):
    posts = spark.createDataFrame([("p1", "ann", 'T"', None, "x\ny", 1, 2)], "post_id string, author string, title string, score long, selftext string, author_account_age_days long, author_comment_karma long")
    whole = posts.select(render.post_json(F.lit(json.dumps(TREE))).alias("value"))
    assert json.loads(whole.first().value) == {"post_id": "p1", "author": "ann", "title": 'T"', "score": None, "selftext": "x\ny", "author_account_age_days": 1, "author_comment_karma": 2, "comments": TREE}
    pretty = whole.select(batching.pretty_json("value").alias("v")).first().v
    assert pretty == json.dumps(json.loads(whole.first().value), ensure_ascii=False, indent=2)
    sinks.write_text_lines(whole, str(tmp_path / "lines"))
    read = readers.json_posts(spark, str(tmp_path / "lines"), lines=True)
    assert read.first().title == 'T"' and tree.flatten_comments(read).count() == 4
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text(json.dumps([{"post_id": f"{name}{i}"} for i in range(3)]))
    many = readers.json_posts(spark, str(tmp_path / "*.json")).orderBy("seq").collect()
    assert [(r.seq, r.post_id) for r in many] == list(enumerate(["a0", "a1", "a2", "b0", "b1", "b2"]))
    lenses = spark.createDataFrame([("power", 's"', None), ("ethics", "t", "json_parse_failed")], "lens string, summary string, error string")
    sinks.write_text(sinks.json_object(lenses, "lens"), str(tmp_path / "lenses"))
    assert {(r.lens, r.summary, r.error) for r in readers.lens_report(spark, str(tmp_path / "lenses")).collect()} == {("power", 's"', None), ("ethics", "t", "json_parse_failed")}
    sinks.write_json_lines(lenses, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2


def test_whole_flow(spark, sf):
    from threadloom.plans import tables

    batches = flow.prepared(tables.posts(spark, sf), tables.comments(spark, sf))
    rows = batches.collect()
    assert rows and all(r.original_tokens <= CAPACITY for r in rows)


def test_stream_equals_batch(spark, tmp_path, sf):
    from threadloom.streaming import gate as stream

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs.write.parquet(str(tmp_path / "in"))
    live = stream.gated(spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in")))
    q = live.writeStream.format("memory").queryName("gated").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination()
    assert spark.table("gated").exceptAll(gate.with_reason(docs, "text", min_words=RELAXED.post_min_words)).count() == 0


def test_every_query_has_a_name_and_most_have_sql():
    assert set(queries.SQL) <= set(queries.QUERIES) and len(queries.SQL) >= 40


def test_progress(spark, tmp_path):
    from threadloom.plans import progress

    path = str(tmp_path / "progress")
    assert progress.next_index(spark, path) == 0
    progress.save(spark, path, 4, 9)
    assert progress.next_index(spark, path) == 5 and progress.left_over(spark.range(9).withColumnRenamed("id", "batch_index"), spark, path).count() == 4
    progress.clear(spark, path)
    assert progress.next_index(spark, path) == 0
    (tmp_path / "damaged").mkdir()
    (tmp_path / "damaged" / "part-0.parquet").write_bytes(b"PAR1 no table PAR1")
    assert progress.next_index(spark, str(tmp_path / "damaged")) == 0


def test_filter_stats(spark):
    posts = spark.createDataFrame([(1,), (2,)], "seq long")
    stats = spark.createDataFrame([(1, 3, 2)], "seq long, original_comments int, kept_comments int")
    assert {r.seq: r._filter_stats and tuple(r._filter_stats) for r in flow.with_filter_stats(posts, stats).collect()} == {1: (3, 2), 2: None}
