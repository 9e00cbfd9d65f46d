"""Posts and comments as compact text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import once
from ..functions.members import object_of, with_members


def _line(label: str, value: Column, default: str, pad: Column | None = None) -> Column:
    return F.concat(pad if pad is not None else F.lit(""), F.lit(f"{label}: "), F.coalesce(value.cast("string"), F.lit(default)))


def comment_blocks(comments: DataFrame) -> DataFrame:
    """post_seq, text: all comments of a post in reading order, indented by depth.

    A comment opens before its replies and closes after them, so each gives two lines, sorted by path: the opening one under its own path, the closing
    one under its path with a last element greater than any reply's.
    """
    pad = F.repeat(F.lit("  "), F.col("depth"))
    opening = F.concat_ws("\n", F.concat(pad, F.lit("[COMMENT]")), _line("Author", F.col("author"), "N/A", pad), _line("Score", F.col("score"), "0", pad), _line("Body", F.col("body"), "", pad))
    closing = F.concat(pad, F.lit("[/COMMENT]"))
    last = F.lit(2147483647)
    lines = F.array(F.struct(F.col("path").alias("key"), opening.alias("line")), F.struct(F.array_append("path", last).alias("key"), closing.alias("line")))
    exploded = comments.select("post_seq", F.explode(lines).alias("l"))
    return exploded.groupBy("post_seq").agg(F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["line"]), "\n").alias("text"))


def post_text(comments_text: Column | None = None) -> Column:
    """A post as text; with its comments' text between their marks, if it has any."""
    head = [F.lit("[POST]"), _line("ID", F.col("post_id"), "N/A"), _line("Author", F.col("author"), "N/A"), _line("Title", F.col("title"), "N/A"), _line("Score", F.col("score"), "0"), _line("Body", F.col("selftext"), "")]
    inner = [] if comments_text is None else [F.when(comments_text.isNotNull() & (comments_text != ""), F.concat(F.lit("[COMMENTS]\n"), comments_text, F.lit("\n[/COMMENTS]")))]
    return F.concat_ws("\n", *head, *inner, F.lit("[/POST]\n"))


#: Fields of a post that its JSON has, in this order; comments follow.
POST_FIELDS = ("post_id", "author", "title", "score", "selftext", "author_account_age_days", "author_comment_karma")


def post_json(comments: Column | None = None, stats: Column | None = None) -> Column:
    """A post's fields as JSON, with its comments (JSON text of the trees) and filter counts if there are any."""
    own = F.to_json(F.struct(*POST_FIELDS), {"ignoreNullFields": "false"})
    trees = F.lit("[]") if comments is None else F.coalesce(comments, F.lit("[]"))
    counts = [] if stats is None else [F.lit(',"_filter_stats":'), F.to_json(stats)]
    return F.concat(own.substr(F.lit(1), F.length(own) - 1), F.lit(',"comments":'), trees, *counts, F.lit("}"))


def with_json(posts: DataFrame, comments: Column | None = None, stats: Column | None = None, name: str = "post_json") -> DataFrame:
    """posts with their JSON. Posts that came as JSON (column raw) keep every field that they came with, in its place; only comments and _filter_stats are set, at the end if they were not
    there. Posts of a table have POST_FIELDS."""
    if "raw" not in posts.columns:
        return once(posts, **{name: post_json(comments, stats)})
    trees = F.lit("[]") if comments is None else F.coalesce(comments, F.lit("[]"))
    staged = once(posts, __trees_=trees, **({} if stats is None else {"__stats_": F.to_json(stats)}))
    parted = with_members(staged, F.col("raw"), "__members")
    change = {"comments": F.col("__trees_")} | ({} if stats is None else {"_filter_stats": F.col("__stats_")})
    return once(parted, **{name: object_of(F.col("__members"), change)}).drop("__members", "__trees_", "__stats_")


def with_text(posts: DataFrame, comments: DataFrame | None = None) -> DataFrame:
    """posts with `post_text`."""
    if comments is None:
        return posts.withColumn("post_text", post_text())
    blocks = comment_blocks(comments).select(F.col("post_seq").alias("__post"), F.col("text").alias("__comments"))
    joined = posts.join(blocks, F.col("seq") == F.col("__post"), "left")
    return joined.withColumn("post_text", post_text(F.col("__comments"))).drop("__post", "__comments")


def batch_texts(placed: DataFrame, posts: DataFrame, seq: str = "seq") -> DataFrame:
    """batch_index, post_count, original_tokens, text_for_llm: a batch's post texts in packing order. A batch is bounded by its capacity."""
    rows = placed.join(posts.select(F.col(seq).alias("__seq"), "post_text"), F.col("seq") == F.col("__seq"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "post_text"))), lambda x: x["post_text"]), "\n")
    return rows.groupBy("batch_index").agg(F.count("*").alias("post_count"), F.sum("tokens").alias("original_tokens"), text.alias("text_for_llm"))
