"""The driver's tables as posts, comments and relations.

documents are posts (seq = post_id = doc_id, selftext = text, author = source, title = lang, score = quality or 0, karma = 1000 - n_chars, age = doc_id mod 4);
conversations are chains of comments under the post of the same number; events, each with the next one of its user, are relations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.tree import chains, own_texts
from ..sources.readers import dealt_out


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return dealt_out(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    docs = read(spark, sf_dir, "documents").join(quality, "doc_id", "left")
    return docs.select(
        F.col("doc_id").alias("seq"), F.col("doc_id").alias("post_id"), F.col("source").alias("author"), F.col("lang").alias("title"), F.coalesce("quality", F.lit(0)).cast("long").alias("score"),
        F.col("text").alias("selftext"), F.pmod("doc_id", F.lit(4)).alias("author_account_age_days"), (1000 - F.length("text")).cast("long").alias("author_comment_karma"),
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("author"), F.col("text").alias("body"))
    ratio = F.when(F.col("turn") % 3 != 0, (F.col("conv_id") % 7 - 1) / 10.0)
    rows = turns.withColumn("upvote_ratio", ratio).withColumn("score", F.col("turn"))
    flat = chains(rows, "conv_id", "turn").select("post_seq", "post_id", "path", "depth", "author", "score", "body", "upvote_ratio")
    return own_texts(flat, "author", "score", "body", "upvote_ratio")


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, batch_index, source, target, relation, evidence; the last event of a user has no target."""
    e = read(spark, sf_dir, "events").withColumn("source", F.concat_ws("_", "event_type", (F.col("user_id") % 10).cast("string")))
    following = F.lead("source").over(Window.partitionBy("user_id").orderBy("event_id"))
    return e.select(F.col("event_id").alias("seq"), F.floor(F.col("event_id") / 100).cast("int").alias("batch_index"), "source", following.alias("target"), F.col("event_type").alias("relation"), F.col("props").alias("evidence"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """batch_index, pos, name, type of the events of even ids."""
    e = read(spark, sf_dir, "events").where("event_id % 2 = 0")
    kind = F.when(F.col("event_type") == "view", "Concept").when(F.col("event_type") == "signup", "Person").when(F.col("event_type") == "purchase", "Organization").otherwise("Event")
    return e.select(F.floor(F.col("event_id") / 100).cast("int").alias("batch_index"), F.col("event_id").alias("pos"), F.concat_ws("_", "event_type", (F.col("user_id") % 10).cast("string")).alias("name"), kind.alias("type"))
