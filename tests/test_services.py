"""Streams with state, tables in buckets, services and table functions."""

import json
import os
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from threadloom.config import RELAXED
from threadloom.functions import repair, udtfs
from threadloom.operators import dedup, graph, render, service, tree
from threadloom.sources import buckets

from .test_core import TREE, merge_rows


# ---- the deduplicator on a stream ----
def test_a_stream_is_the_walk_also_after_a_restart(spark, tmp_path):
    from threadloom.streaming import dedup as stream

    rng = random.Random(3)
    bases = ["".join(rng.choices("abcdefgh ", k=rng.randint(10, 50))) for _ in range(20)]
    items = []
    for seq in range(90):
        for at in range(rng.choice([1, 1, 3])):
            base, k = rng.choice(bases), rng.randint(0, 9)
            items.append((seq, at, rng.choice([base, base.upper(), base[:k] + "z" + base[k:], "".join(rng.choices("abcdefgh ", k=30)), None])))
    schema = "seq long, at int, text string"
    limits = RELAXED.__class__(history=7)
    key, provider = stream.STORE
    before = spark.conf.get(key)
    spark.conf.set(key, provider)
    try:
        for part, bounds in enumerate(((0, 30), (30, 31), (31, 70), (70, 90))):
            rows = [i for i in items if bounds[0] <= i[0] < bounds[1]]
            rng.shuffle(rows)
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            # a query of its own for each part: it starts again from the checkpoint
            live = stream.walked(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), limits=limits)
            live.writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
            assert part >= 0
    finally:
        spark.conf.set(key, before)
    found = {(r.seq, r["at"]): r.status for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {(r.seq, r["at"]): r.status for r in dedup.walked(spark.createDataFrame(items, schema), gate=limits, range_bytes=300).collect()}
    assert found == want and len(set(want.values())) == 4


# ---- buckets ----
def size_of(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))


def test_an_upsert_writes_what_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.range(4000).select(F.col("id").alias("batch_index"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    buckets.create(old, path, ["batch_index"], 16)
    first = size_of(f"{path}/rows")
    new = spark.createDataFrame([(5, "new"), (4001, "more")], "batch_index long, v string")
    assert buckets.upsert(new, path, ["batch_index"], buckets.merge_by(["batch_index"])) == 1
    assert size_of(f"{path}/rows") - first < 0.25 * first
    found = {r.batch_index: r.v for r in buckets.read(spark, path).collect()}
    assert len(found) == 4001 and found[5] == "new" and found[4001] == "more"
    assert buckets.read(spark, path, 0).count() == 4000

    # a merge that dies half-way leaves the version before it
    def broken(old, new):
        return old.unionByName(new).withColumn("v", F.when(F.col("v") == "boom", F.raise_error(F.lit("dies"))).otherwise(F.col("v")))

    with pytest.raises(Exception, match="dies"):
        buckets.upsert(spark.createDataFrame([(5, "boom")], "batch_index long, v string"), path, ["batch_index"], broken)
    assert {r.batch_index: r.v for r in buckets.read(spark, path).collect()} == found
    with pytest.raises(FileNotFoundError):
        buckets.read(spark, str(tmp_path / "none"))


def test_edges_merge_in_buckets(spark, tmp_path):
    rows, path = merge_rows(spark), str(tmp_path / "edges")
    buckets.create(graph.edge_merge(rows.where("seq <= 2")), path, ["source", "target"], 4)
    buckets.upsert(graph.edge_merge(rows.where("seq > 2")), path, ["source", "target"], lambda old, new: graph.merged_edges(old, new))
    whole = {(r.source, r.target): (r.relation, r.weight) for r in buckets.read(spark, path).collect()}
    assert whole == {(r.source, r.target): (r.relation, r.weight) for r in graph.edge_merge(rows).collect()}


# ---- services ----
class Slow:
    lock, now, most = threading.Lock(), 0, 0

    def generate(self, system, user):
        cls = type(self)
        with cls.lock:
            cls.now += 1
            cls.most = max(cls.most, cls.now)
        time.sleep(0.02)
        with cls.lock:
            cls.now -= 1
        return f"{user} {cls.most}"


class Failing:
    """Fails for some prompts always, and at the first try of others."""

    lock, tried = threading.Lock(), {}

    def generate(self, system, user):
        with self.lock:
            n = self.tried[user] = self.tried.get(user, 0) + 1
        if user.endswith("7") or (n == 1 and user.endswith("3")):
            raise ValueError(f"no {user}")
        return user.upper()


class Mended:
    def generate(self, system, user):
        return "again " + user


def prompts(spark, n):
    return spark.range(n).select("id", F.concat(F.lit("p"), F.col("id").cast("string")).alias("user"))


def test_several_requests_are_in_flight_and_rows_stay(spark):
    limits = service.Limits(tasks=2, in_flight=6)
    rows = service.answered(prompts(spark, 60), F.lit("s"), F.col("user"), Slow(), limits).collect()
    assert sorted(r.id for r in rows) == list(range(60)) and all(r.answer.split()[0] == f"p{r.id}" and r.error is None for r in rows)
    assert 2 <= max(int(r.answer.split()[1]) for r in rows) <= 6
    assert service.answered(prompts(spark, 0), F.lit("s"), F.col("user"), Slow(), limits).count() == 0


def test_failures_are_rows_and_are_asked_again(spark, tmp_path):
    path, limits = str(tmp_path / "answers"), service.Limits(tasks=2, in_flight=3, attempts=2, delay=0.01)
    rows = prompts(spark, 40)
    first = {r.id: r.answer for r in service.run(rows, "id", F.lit("s"), F.col("user"), Failing(), path, limits).collect()}
    bad = {i for i in range(40) if i % 10 == 7}
    assert set(first) == set(range(40)) - bad and first[3] == "P3"
    found = {r.id: (r.error, r.attempts) for r in service.failures(rows, "id", path).collect()}
    assert set(found) == bad and found[7] == ("ValueError: no p7", 2)
    second = {r.id: r.answer for r in service.run(rows, "id", F.lit("s"), F.col("user"), Mended(), path, limits).collect()}
    assert {i: a for i, a in second.items() if i not in bad} == first and second[17] == "again p17"
    assert service.failures(rows, "id", path).count() == 0


def test_a_bucket_bounds_the_rate():
    now = [0.0]
    bucket = service.Bucket(5.0, 2, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(12):
        bucket.take()
    assert 1.99 <= now[0] <= 2.01  # two at once, then five a second
    bucket.close_for(3.0)
    bucket.take()
    assert now[0] >= 4.99

    class Throttling:
        calls = 0

        def generate(self, system, user):
            self.calls += 1
            if self.calls < 3:
                raise service.Throttled(2.0)
            return "ok"

    start = now[0]
    assert service.asked(Throttling(), "", "", service.Limits(attempts=4), bucket) == ("ok", None, 3) and now[0] - start >= 4.0


# ---- table functions ----
def test_table_functions(spark):
    udtfs.register(spark)
    posts = spark.createDataFrame([(0, "a", json.dumps(TREE)), (1, "b", json.dumps(TREE[1:])), (2, "c", "[]")] + [(i, "d", json.dumps(TREE * 3)) for i in range(3, 6)], "seq long, post_id string, comments string")
    flat = tree.flatten_comments(posts)
    flat.createOrReplaceTempView("flat")
    found = {r.post_seq: (r.n_comments, r.text) for r in spark.sql("SELECT * FROM threads(TABLE(SELECT * FROM flat), 'post_seq')").collect()}
    want = {r.post_seq: r.text for r in render.comment_blocks(flat).collect()}
    assert {k: t for k, (_, t) in found.items()} == want and found[0][0] == 4 and found[3][0] == 12
    assert spark.sql("SELECT * FROM threads(TABLE(SELECT * FROM flat WHERE false), 'post_seq')").count() == 0
    with pytest.raises(Exception, match="needs the columns"):
        spark.sql("SELECT * FROM threads(TABLE(SELECT post_seq FROM flat), 'post_seq')").collect()
    spark.createDataFrame([(1, "Ann Lee meets Bob. Nothing."), (2, None)], "id int, t string").createOrReplaceTempView("texts")
    assert [tuple(r) for r in spark.sql("SELECT id, r.source, r.relation, r.target FROM texts, LATERAL relations_in(t) r").collect()] == [(1, "Ann Lee", "meets", "Bob")]
    assert spark.sql("SELECT id, e.name FROM texts, LATERAL entities_in(t) e").count() == 3


# ---- JSON that was cut short ----
def test_mending_in_one_pass_is_mending_by_trial():
    def trial(text):
        body = text.strip()
        tries = (body[: len(body) - drop] + closer for drop in range(min(len(body), repair.REACH)) for closer in repair.CLOSERS)
        for candidate in (body, *tries) if body else ():
            try:
                return json.dumps(json.loads(candidate), ensure_ascii=False, separators=(",", ":"))
            except ValueError:
                continue
        return None

    rng = random.Random(1)

    def value(level=0):
        r = rng.random()
        if r < 0.25:
            return "".join(rng.choices('ab{}[]",:\\\n é\u0001u0', k=rng.randint(0, 12)))
        if r < 0.45:
            return rng.choice([1, 2.5, None, True, -3, 10**20, 1e-7, 0, -0.0, 1e30, False, float("nan"), float("-inf"), 12345])
        if level > 3:
            return "s"
        if r < 0.7:
            return [value(level + 1) for _ in range(rng.randint(0, 3))]
        return {rng.choice("xyzwv") + str(i): value(level + 1) for i in range(rng.randint(0, 3))}

    mended = 0
    for _ in range(6000):
        text = json.dumps(value(), ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, None, 2]))
        text = text[: rng.randint(0, len(text))]
        if rng.random() < 0.25 and text:
            p = rng.randrange(len(text))
            text = text[:p] + rng.choice('"{}[],:0-.eE+ \\tn') + text[p + rng.randint(0, 1) :]
        found = repair.mended(text)
        assert found == trial(text), text
        mended += found is not None
    assert mended > 2000
    long = '{"entities":[' + ",".join('{"name":"n%d","type":"t"}' % i for i in range(4000))
    assert repair.mended(long) is not None and repair.mended("{" * 100_000) is None and repair.mended(None) is None
