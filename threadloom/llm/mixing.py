"""Mixing sources to target weights by Pareto order sampling.

A source whose target is r times its size takes every document floor(r) times for certain. What is left is a sample without repeats with unequal
chances: those of longer documents are somewhat larger (`weight_of`). Documents are ranked by their random odds u / (1 - u), divided by the odds of their
inclusion chance, and taken in that order until the words that are still wanted are reached, so the sample's size is fixed and only its members are random.

No source is sorted in one task. The rank is cut into 4096 bins twice over; sums by bin find the bin where the wanted words are
reached, and only that bin's documents (one in 16 million) are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import CHUNK, cut, small

BINS = 4096


def _rank(doc_id: str, key: str, seed: int, chance: Column) -> Column:
    """q / (1 + q) of the Pareto rank q = (u / (1 - u)) / (chance / (1 - chance)): the same order, within (0, 1]."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id, key), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return u * (1 - chance) / (u * (1 - chance) + chance * (1 - u))


def weight_of(size: Column) -> Column:
    """What a document's inclusion chance goes by within its source."""
    return F.log2(size + 2.0)


def _chance(size: Column) -> Column:
    """The inclusion chance of a document, so that chances times sizes sum to the rest that its source wants, but for those cut at 1."""
    return F.least(F.col("chance") * weight_of(size) / F.col("mean_weight"), F.lit(1.0))


def _placed(sources: DataFrame) -> DataFrame:
    """Adds the place (from 0) of each source in code point order, null last. Ranges are counted and numbered from their offsets, so no task sees all sources."""
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ranges come from a sample, so they are written once
    ranged = cut(sources.repartitionByRange(parts, F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "mix-ranges")
    counts = ranged.groupBy("part").agg(F.count("*").alias("n"))  # a row for each range
    before = counts.select(F.col("part").alias("of_part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    return ranged.withColumn("inside", inside).join(F.broadcast(before), F.col("part") == F.col("of_part")).withColumn("place", F.col("before") + F.col("inside")).drop("part", "of_part", "before", "inside")


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Adds weight, target, copies, chance and rest to (source, source_size, mean_weight), one row for each source.

    Sources in code point order, null last, get the weights in turn. Targets are weight x level, at most `most` x size, and sum to `share` x all sizes. The level is found
    by filling: sources that a level caps keep their caps, the rest is shared again, until no more are capped; each round is one aggregation to one row.
    """
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    out = cut(_placed(sources).withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most))), "mix-weights")
    wanted = float(out.agg(F.sum("source_size")).first()[0] or 0) * share
    level, n_capped = 0.0, -1
    while True:
        capped = F.col("cap") < F.col("weight") * F.lit(level)
        sums = out.agg(F.count_if(capped).alias("n"), F.sum(F.when(capped, F.col("cap"))).alias("caps"), F.sum(F.when(~capped, F.col("weight"))).alias("open")).first()
        if sums.n == n_capped or not sums.open:
            break
        n_capped, level = sums.n, (wanted - (sums.caps or 0.0)) / sums.open
    # if the caps together are below what is wanted, all are reached
    target = F.least("cap", F.col("weight") * F.lit(level)) if sums.open else F.col("cap")
    out = out.withColumn("target", target)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        out.withColumn("copies", F.floor(ratio + 1e-12).cast("int"))
        .withColumn("chance", F.greatest(ratio - F.col("copies"), F.lit(0.0)))
        .withColumn("rest", F.col("chance") * F.col("source_size"))
        .select("source", "source_size", "mean_weight", "weight", "target", "copies", "chance", "rest")
    )


def plan(base: DataFrame, *, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 1) -> DataFrame:
    """The mix, one row for each source: target, copies, chance, and `last`, the (rank, doc_id, key) of the last document that is taken once more.

    base: doc_id, source, size, key (a hash of the text). Rows alike in all four have one rank and are in or out together.
    """
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.try_divide(F.sum(F.col("size") * weight_of(F.col("size"))), F.sum("size")).alias("mean_weight"))
    sources = cut(targets(sizes, weights, share, most), "mix-sources")
    n = sources.count()
    drawn = (
        base.withColumnRenamed("source", "of")
        .join(small(sources.where("rest > 0").select("source", "chance", "rest", "mean_weight"), n), F.col("of").eqNullSafe(F.col("source")))
        .withColumn("rank", _rank("doc_id", "key", seed, _chance(F.col("size"))))
        .select("source", "rest", "doc_id", "key", "size", "rank", F.floor(F.col("rank") * BINS).alias("bin_0"), (F.floor(F.col("rank") * BINS * BINS) % BINS).alias("bin_1"))
    )
    at, begun = drawn, F.lit(0)
    for level in (0, 1):
        name = f"bin_{level}"
        sums = at.withColumn("begun", begun).groupBy("source", "rest", "begun", name).agg(F.sum("size").alias("words"))
        upto = F.col("begun") + F.sum("words").over(Window.partitionBy("source").orderBy(name))
        edge = sums.withColumn("upto", upto).withColumn("begun", F.col("upto") - F.col("words"))
        edge = edge.where((F.col("begun") < F.col("rest")) & (F.col("upto") >= F.col("rest")) & (F.col("words") > 0)).select(F.col("source").alias("of"), F.col(name).alias("edge"), F.col("begun").alias("from"))
        at = at.drop("begun").join(small(edge, n), F.col("source").eqNullSafe(F.col("of")) & (F.col(name) == F.col("edge"))).withColumnRenamed("from", "begun").drop("of", "edge")
        begun = F.col("begun")
    at = at.groupBy("source", "rest", "begun", "doc_id", "key", "rank").agg(F.sum("size").alias("size"))  # rows alike, however many, are one
    before = F.col("begun") + F.sum("size").over(Window.partitionBy("source").orderBy("rank", "doc_id", "key").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    edge_0 = F.floor(F.col("rank") * BINS * BINS)
    last = (
        at.withColumn("before", before)
        .withColumn("inside", F.col("before") + F.col("size") / 2 <= F.col("rest"))
        .groupBy(F.col("source").alias("of"))
        .agg(
            F.coalesce(
                F.max(F.when(F.col("inside"), F.struct("rank", "doc_id", "key"))),
                F.struct(F.min(edge_0.cast("double") / (BINS * BINS)).alias("rank"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("key")),
            ).alias("last")
        )
    )
    return cut(sources.join(small(last, n), F.col("source").eqNullSafe(F.col("of")), "left").drop("of"), "mix-plan")


def _copies(rank: Column) -> Column:
    taken = F.struct(rank.alias("rank"), F.col("doc_id"), F.col("key")) <= F.col("last")
    return F.col("copies") + F.when(F.col("last").isNotNull() & (F.col("chance") > 0) & taken, 1).otherwise(0)


def size_of(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(text_col, F.lit(CHUNK)), F.lit(0)).cast("long")


def base_of(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), size_of(text_col).alias("size"), F.xxhash64(text_col).alias("key"))


def mix(docs: DataFrame, *, seed: int = 1, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, **columns: str) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and source of each row of docs.

    A null text has size 0; a null source is a source of its own, the last; a null id is a value like others. Repeated rows are taken
    equally. An empty table gives no rows. Other columns are not read. The same rows and seed give the same mix, whatever their order.
    """
    base = cut(base_of(docs, **columns), "mix-sizes")
    made = plan(base, seed=seed, weights=weights, share=share, most=most)
    rows = base.withColumnRenamed("source", "of").join(small(made, made.count()), F.col("of").eqNullSafe(F.col("source")))
    rows = rows.withColumn("copies", _copies(_rank("doc_id", "key", seed, _chance(F.col("size")))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", F.col("of").alias("source"))


def mixed_rows(docs: DataFrame, *, seed: int = 1, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs, all columns, each as many times as the mix takes it."""
    made = plan(cut(base_of(docs, id_col=id_col, source_col=source_col, text_col=text_col), "mix-sizes"), seed=seed, **how)
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("key"), F.col(source_col).alias("of"), size_of(text_col).alias("size"))
    rows = rows.join(small(made, made.count()), F.col("of").eqNullSafe(F.col("source")))
    copies = _copies(_rank("doc_id", "key", seed, _chance(F.col("size"))))
    return rows.select("row", F.explode(F.array_repeat(F.lit(1), copies))).select("row.*")
