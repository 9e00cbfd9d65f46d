"""Resampling documents towards a target text by importance weights of hashed word n-grams. DataFrame operations only.

Every run of one to `most` consecutive words is a feature and falls by its crc32 into one of `buckets`. What a bucket gains is the logarithm of its share among the target's features over
its share among all documents' features; a document's weight is the mean gain of its features. Gumbel noise from a hash of the id turns the greatest scores into a draw without replacement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import once
from .common import WORD, ascii_lower, cut

#: Buckets, longest n-gram, words that a document must have to be drawn, percent of those that are drawn, salt of the noise.
BUCKETS, MOST, LEAST_WORDS, PERCENT, SALT = 10_000, 2, 20, 25, 7


def _with_words(rows: DataFrame, text_col: str) -> DataFrame:
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(WORD), F.lit(0))
    return once(rows, __words=words)


def _features(most: int) -> Column:
    """All n-grams of __words, shorter ones first."""
    words = F.col("__words")

    def runs(n: int) -> Column:
        starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0)))
        return F.transform(starts, lambda w, i: F.concat_ws(" ", w, *(words[i + k] for k in range(1, n))))

    return F.concat(words, *(runs(n) for n in range(2, most + 1)))


def _bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def bucket_counts(rows: DataFrame, text_col: str = "text", *, buckets: int = BUCKETS, most: int = MOST) -> DataFrame:
    """bucket, n of the buckets that any feature falls into: at most `buckets` rows, summed up in each task first."""
    exploded = _with_words(rows.select(text_col), text_col).select(F.explode(_features(most)).alias("feature"))
    return exploded.groupBy(_bucket(F.col("feature"), buckets).alias("bucket")).agg(F.count("*").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", *, target_text: str = "text", buckets: int = BUCKETS, most: int = MOST) -> DataFrame:
    """bucket, gain: floor(1000 ln(share in the target / share in the documents)), shares with one added to each bucket. A row for each bucket that documents use."""
    s = bucket_counts(docs, text_col, buckets=buckets, most=most).select("bucket", F.col("n").alias("s"))
    t = bucket_counts(target, target_text, buckets=buckets, most=most).select("bucket", F.col("n").alias("t"))
    both = s.join(t, "bucket", "full").select("bucket", F.coalesce("s", F.lit(0)).cast("double").alias("s"), F.coalesce("t", F.lit(0)).cast("double").alias("t"))
    both = cut(both, "bucket-counts")  # read twice: for the sums and for the rows
    sums = both.agg(F.coalesce(F.sum("s"), F.lit(0.0)).alias("all_s"), F.coalesce(F.sum("t"), F.lit(0.0)).alias("all_t"))
    share = (F.col("t") + 1) * (F.col("all_s") + buckets) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    return both.join(F.broadcast(sums)).select("bucket", F.floor(1000 * F.log(share)).alias("gain"))  # one row


def weighted(docs: DataFrame, gain: DataFrame, text_col: str = "text", id_col: str = "doc_id", *, buckets: int = BUCKETS, most: int = MOST) -> DataFrame:
    """doc_id, n_words, n_features, weight, same, of rows that are alike in id and text and were read by one task: `same` of them, in one row.

    A row is known by its id and 128 bits of hash of its text, so repeated ids do not mix; rows alike are one group for each task that reads them, however many there are.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), F.spark_partition_id().alias("task"))
    rows = _with_words(rows, "text").withColumn("n_words", F.size("__words").cast("long"))
    exploded = rows.select("doc_id", "h1", "h2", "task", "n_words", F.posexplode_outer(_features(most)).alias("at", "feature"))
    exploded = exploded.select("doc_id", "h1", "h2", "task", "n_words", (F.coalesce("at", F.lit(0)) == 0).cast("long").alias("head"), _bucket(F.col("feature"), buckets).alias("bucket"))
    gain = F.broadcast(gain.select(F.col("bucket").alias("__bucket"), "gain"))  # at most `buckets` rows
    found = exploded.join(gain, F.col("bucket") == F.col("__bucket"), "left").groupBy("doc_id", "h1", "h2", "task", "n_words")
    found = found.agg(F.sum("head").alias("same"), F.count("bucket").alias("features"), F.coalesce(F.sum("gain"), F.lit(0)).alias("gains"))
    weight = F.when(F.col("features") > 0, F.expr("(gains - pmod(gains, features)) div features")).otherwise(F.lit(0).cast("long"))
    return found.select("doc_id", "n_words", F.expr("features div same").alias("n_features"), weight.alias("weight"), "same", "h1", "h2", "task")


def importance_sample(
    docs: DataFrame, target: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", target_text: str = "text", buckets: int = BUCKETS, most: int = MOST,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, salt: int = SALT,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of each row of docs; rank is 1, 2, 3, ... over the drawn ones by score, greatest first, ties by id, and null for the rest.

    Texts are read twice and never shuffled: once for the counts of buckets, once for the weights. The drawn ones come from a distributed sort: ranges of scores, written in order, each
    numbered from the count of those before it. Null and empty texts have no features and weight 0; a null id counts as an empty one and comes last in ties; rows alike are drawn
    as often as they stand there. Without target texts all buckets gain by the documents alone; without documents the result is empty.
    """
    spark = docs.sparkSession
    gain = gains(docs, target, text_col, target_text=target_text, buckets=buckets, most=most)
    rows = weighted(docs, gain, text_col, id_col, buckets=buckets, most=most)
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    # rows that stand for several go back to one each, with a number, so that many alike are no single key of the sort
    scored = cut(rows.withColumn("score", F.col("weight") + noise).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("same")))), "importance-scores")
    fit = scored.where(F.col("n_words") >= least_words)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("h1"), F.col("h2"), F.col("task"), F.col("copy")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = fit.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = cut(ranged.select("doc_id", "n_words", "n_features", "weight", "score", F.spark_partition_id().alias("range"), place.alias("place")), "importance-ranges")
    sizes = ranged.groupBy("range").agg(F.count("*").alias("n"))  # a row for each range
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    offsets = sizes.select(F.col("range").alias("of"), before.alias("before"), F.sum("n").over(Window.partitionBy()).alias("total"))
    rank = F.col("before") + F.col("place") + 1
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    drawn = ranged.join(F.broadcast(offsets), F.col("range") == F.col("of")).select(*columns, F.when(rank <= F.expr(f"total * {int(percent)} div 100"), rank).alias("rank"))
    rest = scored.where(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(rest)
