"""Near-duplicate documents by circulant MinHash.

Sketch. Every shingle is hashed to 64 bits; one permutation (a bijective mixer) places it on a circle of 2^20 places, the other permutation,
drawn once, orders the places. Coordinate k of a signature is the least order number among the document's places after the circle was shifted by
k, so all coordinates come from the two permutations. Bands of `rows` coordinates are hashed to buckets; `bands` is such that two
documents at the threshold miss each other in all bands with a chance below `miss`.

Links. Documents with equal shingle sets are one class, and only its smallest id goes on. Classes that share a bucket are candidates:

1. in a bucket of at most SMALL classes each with each; in a larger one each with a few centres, the same in all buckets;
2. exact Jaccard similarity of full sets confirms or refutes, and components of the confirmed links are found;
3. large buckets that still hold several components get a further centre, from outside their largest component, ROUNDS times;
4. what is still open then: each member outside its bucket's largest component is compared, on full sets, with every member of another component. Both sides are cut
   into blocks, so a task holds some 2 x BLOCK sets; a pair is compared in one bucket only, the first open one that both are in. Blocks report a link for each pair
   of components at most.

So no group is expanded into all pairs, and no link of two different components that meet in a bucket is lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches, small
from .components import components, extended

PLACES = 1 << 20
#: Classes of a bucket that are compared each with each.
SMALL = 12
#: Centres of a larger bucket.
CENTRES = 3
#: Further centres of a bucket that is still open; members of a block in step 4, on either side.
ROUNDS, BLOCK = 2, 512
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2^64, n at least."""
    if len(_POWERS.get("up", ())) < n:
        n = max(1 << 16, 1 << (n - 1).bit_length())
        base = 0x9E3779B97F4A7C15
        for name, factor in (("up", base), ("down", pow(base, -1, 1 << 64))):
            out = np.full(n, factor, np.uint64)
            out[0] = 1
            _POWERS[name] = np.multiply.accumulate(out)
    return _POWERS["up"], _POWERS["down"]


_LETTERS = mix64(np.arange(1, 257, dtype=np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words (runs of anything but ASCII white space, A-Z in lower case) of a text, in order."""
    data = np.frombuffer(text.encode().translate(ASCII_LOWER), np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.diff(inside.view(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * up[: len(data)], out=sums[1:])
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles of `width` words; of all its words as one shingle if they are fewer; empty without words."""
    words = word_hashes(text) if text else np.empty(0, np.uint64)
    if not len(words):
        return words
    width = min(width, len(words))
    out = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - width + 1 + i])
    return np.unique(out + np.uint64(width))


def banding(threshold: float, miss: float = 1e-7, rows: int | None = None) -> tuple[int, int]:
    """Rows of a band and bands."""
    rows = rows or (6 if threshold >= 0.83 else 5)
    return rows, math.ceil(math.log(miss) / math.log(1 - threshold**rows))


class Circulant:
    """Signatures of `size` coordinates from two permutations."""

    def __init__(self, size: int, seed: int = 1):
        order = np.random.default_rng(seed).permutation(PLACES).astype(np.int32)
        self.rows = np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[:size]]), size)
        self.first = np.uint64(0xA0761D6478BD642F + 2 * seed)
        self.size = size

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        places = (mix64(hashes ^ self.first) & np.uint64(PLACES - 1)).astype(np.int64)
        out = np.full(self.size, PLACES, np.int32)
        for i in range(0, len(places), 2048):
            np.minimum(out, self.rows[places[i : i + 2048]].min(axis=0), out=out)
        return out


def sketches(docs: DataFrame, width: int, rows: int, bands: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, set_key (two hashes of the whole set; null if empty), buckets."""
    state: dict = {}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not state:
            state["signature"] = Circulant(rows * bands)
            state["band"] = mix64(np.arange(1, bands + 1, dtype=np.uint64))
        n, keys, buckets = [], [], []
        for text in batch.column(1).to_pylist():
            hashes = shingle_set(text, width)
            n.append(len(hashes))
            if not len(hashes):
                keys.append(None)
                buckets.append(None)
                continue
            keys.append(mix64(hashes).sum(dtype=np.uint64).tobytes() + np.bitwise_xor.reduce(mix64(hashes + np.uint64(0x632BE59BD9B4E019))).tobytes())
            parts = state["signature"](hashes).astype(np.uint64).reshape(bands, rows)
            band = state["band"].copy()
            for i in range(rows):
                band = mix64(band * np.uint64(0xD6E8FEB86659FD93) + parts[:, i])
            buckets.append(band.view(np.int64))
        columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_key", "buckets"])

    rows_of = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows_of, work, "doc_id long, n_shingles long, set_key binary, buckets array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """node, shingles (sorted hashes) of the documents whose id is in wanted (node); a row for each different set of an id."""
    n = wanted.count()
    rows = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text")).join(small(wanted, n), "node", "left_semi")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, width).view(np.int64) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    sets = cut(map_batches(rows, work, "node long, shingles array<long>"), "sets")
    # only rows that share an id can be alike
    return cut(sets.dropDuplicates(["node", "shingles"]), "sets") if sets.count() > n else sets


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of which some full sets have 100 x intersection >= percent x union."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    n, m = F.size("of_a").cast("long"), F.size("of_b").cast("long")
    near = pairs.join(left, "a").join(right, "b").where(100 * F.least(n, m) >= percent * F.greatest(n, m))
    common = F.size(F.array_intersect("of_a", "of_b"))
    return near.where(100 * common >= percent * (n + m - common)).select("a", "b").distinct()


def _block_links(percent: int):
    """For a block (bucket, asking and answering members): a link for each two components that have one."""

    def work(table: pa.Table) -> pa.Table:
        node, comp, asks, main = (table.column(c).to_numpy() for c in ("node", "component", "asks", "main"))
        bucket = table.column("bucket")[0].as_py()
        shingles = table.column("shingles").combine_chunks()
        values, ends = shingles.values.to_numpy(), shingles.offsets.to_numpy()
        sizes = np.diff(ends).astype(np.int64)
        _, dense = np.unique(values, return_inverse=True)
        members = np.flatnonzero(~asks)
        # open buckets by band, 0 where none: two members' first common one is where they are compared
        open_in = np.array(table.column("open_in").to_pylist(), np.int64).reshape(table.num_rows, -1)
        flat = np.concatenate([dense[ends[i] : ends[i + 1]] for i in members]) if len(members) else np.empty(0, int)
        starts = np.concatenate([[0], np.cumsum(sizes[members])[:-1]]).astype(int) if len(members) else np.empty(0, int)
        mark, found = np.zeros(len(values) + 1, np.int64), {}
        for q in np.flatnonzero(asks) if len(members) else ():
            same = (open_in[members] == open_in[q]) & (open_in[q] != 0)
            first = open_in[q][same.argmax(axis=1)]
            # of two that both ask, one does
            wanted = (comp[members] != comp[q]) & (first == bucket) & ((comp[members] == main[members]) | (node[members] > node[q]))
            if not wanted.any():
                continue
            mine = dense[ends[q] : ends[q + 1]]
            mark[mine] = 1
            common = np.add.reduceat(mark[flat], starts)
            mark[mine] = 0
            hit = wanted & (100 * common >= percent * (sizes[q] + sizes[members] - common))
            for i in members[hit]:
                found.setdefault((comp[q], comp[i]), (node[q], node[i]))
        ends_of = list(found.values())
        return pa.table({"a": pa.array([int(x) for x, _ in ends_of], pa.int64()), "b": pa.array([int(y) for _, y in ends_of], pa.int64())})

    return work


def _open(large: DataFrame, found: DataFrame) -> DataFrame:
    """bucket, node, component, main (the bucket's largest component), n, n_asks (members outside it) of the members of buckets that hold several components."""
    labelled = large.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sums = labelled.groupBy("bucket", "component").agg(F.count("*").alias("of_it"))
    main = sums.groupBy("bucket").agg(F.max_by("component", F.struct("of_it", "component")).alias("main"), F.max("of_it").alias("most"), F.sum("of_it").alias("n"), F.count("*").alias("kinds"))
    main = cut(main.where("kinds > 1").select("bucket", "main", "n", (F.col("n") - F.col("most")).alias("n_asks")), "main")
    return cut(labelled.join(small(main, main.count()), "bucket"), "open")


def _blocks(open_: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """What step 4 compares: rows of (bucket, ask_block, block) groups, some BLOCK that ask and BLOCK that answer."""
    blocks = lambda n: F.greatest(F.ceil(F.col(n) / BLOCK), F.lit(1)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    dealt = lambda salt, n: F.pmod(F.xxhash64("node", F.lit(salt)), blocks(n)).cast("int")
    kept = ["bucket", "node", "component", "main"]
    asks = open_.where("component <> main").select(*kept, F.lit(True).alias("asks"), dealt(1, "n_asks").alias("ask_block"), every("n").alias("block"))
    answers = open_.select(*kept, F.lit(False).alias("asks"), every("n_asks").alias("ask_block"), dealt(2, "n").alias("block"))
    # bands of a node whose bucket is open
    open_of = open_.groupBy("node").agg(F.collect_set("bucket").alias("open"))
    in_open = nodes.join(open_of, "node").select("node", F.transform("buckets", lambda b: F.when(F.array_contains("open", b), b).otherwise(0)).alias("open_in"))
    in_open = in_open.groupBy("node").agg(F.max("open_in").alias("open_in"))
    return asks.unionByName(answers).join(sets.join(in_open, "node"), "node").select(*kept, "asks", "ask_block", "block", "open_in", "shingles")


def links(docs: DataFrame, nodes: DataFrame, *, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(node, component) of the nodes (node, buckets) that have a link."""
    rows = nodes.select(F.explode("buckets").alias("bucket"), "node")
    counted = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("least"), F.max("node").alias("most"))
    counted = cut(counted.where("least < most"), "buckets")
    member = cut(rows.join(counted.select("bucket", "n"), "bucket"), "members")
    few = member.where(F.col("n") <= SMALL)
    each = few.select("bucket", F.col("node").alias("a")).join(few.select("bucket", F.col("node").alias("b")), "bucket").where("a < b").select("a", "b")
    large = member.where(F.col("n") > SMALL).select("bucket", "node")
    centres = large.groupBy("bucket").agg(*(F.min(F.struct(F.xxhash64("node", F.lit(i)), "node")).alias(f"c{i}") for i in range(CENTRES))).select("bucket", F.explode(F.array_distinct(F.array(*(F.col(f"c{i}.node") for i in range(CENTRES))))).alias("centre"))
    ends = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    centres = cut(centres, "centres")
    stars = large.join(small(centres, centres.count()), "bucket").where("node <> centre").select(*ends("node", "centre"))
    pairs = cut(each.union(stars).distinct(), "candidates")
    wanted = cut(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted")
    sets = full_sets(docs, wanted, width, id_col, text_col)
    found = components(cut(confirmed(pairs, sets, percent), "links"))
    if large.isEmpty():
        return found
    open_ = _open(large, found)
    if open_.isEmpty():
        return found
    ids = cut(open_.select("node").distinct(), "open-ids")
    sets = cut(sets.join(small(ids, ids.count()), "node", "left_semi"), "open-sets")  # open members only grow fewer
    for i in range(ROUNDS):
        further = open_.where("component <> main").groupBy("bucket").agg(F.min(F.struct(F.xxhash64("node", F.lit(CENTRES + i)), F.col("node").alias("centre"), F.col("component").alias("of"))).alias("c")).select("bucket", "c.centre", "c.of")
        further = cut(further, "centres")
        stars = open_.join(small(further, further.count()), "bucket").where(F.col("component") != F.col("of")).select(*ends("node", "centre")).distinct()
        more = cut(confirmed(stars, sets, percent), "more-links")
        if not more.isEmpty():
            found = extended(found, more)
            open_ = _open(large, found)
            if open_.isEmpty():
                return found
    more = cut(_blocks(open_, nodes, sets).groupBy("bucket", "ask_block", "block").applyInArrow(_block_links(percent), "a long, b long"), "more-links")
    return found if more.isEmpty() else extended(found, more)


def _same_ids(sketch: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges between the classes that an id with several different texts is in."""
    several = sketch.groupBy("doc_id").agg(F.min("set_key").alias("least"), F.max("set_key").alias("most")).where("least <> most").select("doc_id")
    held = sketch.select("doc_id", "set_key").join(several, "doc_id").join(classes.select("set_key", "node"), "set_key").select("doc_id", "node").distinct()
    first = held.groupBy("doc_id").agg(F.min("node").alias("a"))
    return held.join(first, "doc_id").where("a <> node").select("a", F.col("node").alias("b")).distinct()


def near_dedup(docs: DataFrame, *, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", rows: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs.

    A null, empty or blank text has no shingles, is linked with nothing and is its own component. Rows that share an id and a text get
    equal results; an id with several texts is linked with what any of them is linked with, and all its texts with words get one component. A null id keeps a null component and is kept.
    An empty table gives no rows. Other columns are not read.
    """
    rows, bands = banding(percent / 100, rows=rows)
    sketch = cut(sketches(docs, width, rows, bands, id_col, text_col), "sketches")
    full = sketch.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    classes = cut(full.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")), "classes")
    nodes = full.select(F.col("doc_id").alias("node"), "set_key", "buckets").join(classes, ["set_key", "node"]).select("node", "set_key", "buckets").dropDuplicates(["set_key", "node"]).drop("set_key")
    nodes = cut(nodes, "nodes")  # read several times
    found = links(docs, nodes, width=width, percent=percent, id_col=id_col, text_col=text_col)
    same = cut(_same_ids(full, classes), "same-ids")
    found = found if same.isEmpty() else extended(found, same)
    linked = classes.join(found, "node", "left").where("copies > 1 OR component IS NOT NULL").select("set_key", F.coalesce("component", "node").alias("component"))
    # narrow rows on both sides, so this is no broadcast at any size; rows without a set or an id do not take part
    out = full.select("doc_id", "n_shingles", "set_key").join(linked, "set_key", "left").select("doc_id", "n_shingles", "component")
    out = out.unionByName(sketch.where("set_key IS NULL OR doc_id IS NULL").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component")))
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, *, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, of which one of each component stays: that of the smallest id. Of rows that share an id one stays; rows with a null id stay."""
    report = cut(near_dedup(docs, width=width, percent=percent, id_col=id_col, text_col=text_col).select("doc_id", "kept"), "report")
    gone = report.where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    out = docs.join(small(gone, gone.count()), docs[id_col].cast("long") == F.col("__gone"), "left_anti")
    twice = report.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__twice")).agg(F.count("*").alias("__n")).where("__n > 1").select("__twice")
    n = twice.count()
    if not n:
        return out
    same = out[id_col].cast("long") == F.col("__twice")
    return out.join(small(twice, n), same, "left_anti").unionByName(out.join(small(twice, n), same, "left_semi").dropDuplicates([id_col]))
