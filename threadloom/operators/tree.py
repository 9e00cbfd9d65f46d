"""Comment trees as flat tables: a row for each comment with (post_seq, path): the place of its post among all posts, and the positions from the root down. post_id is data only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import RELAXED, Gate
from ..functions.columns import once
from ..functions.members import object_of, with_members

#: opening and closing are the comment as JSON text, up to where its replies stand and from there on, with all fields that it came with.
FLAT = "post_seq long, post_id string, path array<int>, depth int, author string, score long, body string, upvote_ratio double, opening string, closing string"
#: Levels that are taken apart in one go: those that the gate looks at, and one more, whose comments it rejects together with all below.
LEVELS = RELAXED.comment_max_depth + 2
_NODES = "array<struct<path:array<int>,node:string>>"


def flatten_comments(posts: DataFrame, comments_json: str = "comments", *, seq: str = "seq", post_id: str = "post_id", levels: int | None = LEVELS) -> DataFrame:
    """Flat comments of posts whose comment trees stand as JSON text, `levels` deep (None: all; then an action looks for deeper ones after each LEVELS levels).

    Spark's types cannot recurse, so a level is the replies of the level above, taken out as texts; all levels of a post come from one projection, without a join or a shuffle. What is
    no JSON list gives no rows; an element that is no object has no fields.
    """
    roots = F.transform(F.from_json(comments_json, "array<string>"), lambda n, i: F.struct(F.array(i).alias("path"), n.alias("node")))
    rows = posts.select(F.col(seq).cast("long").alias("post_seq"), F.col(post_id).cast("string").alias("post_id"), F.coalesce(roots, F.array().cast(_NODES)).alias("roots"))
    found = None
    while True:
        staged, names = rows, ["roots"]
        for k in range(1, min(levels or LEVELS, LEVELS)):
            below = F.flatten(F.transform(names[-1], _replies))
            staged = once(staged, **{f"level{k}": F.coalesce(below, F.array().cast(_NODES))})
            names.append(f"level{k}")
        nodes = staged.select("post_seq", "post_id", F.explode(F.concat(*names)).alias("n")).select("post_seq", "post_id", "n.path", "n.node")
        found = nodes if found is None else found.unionByName(nodes)
        if levels is not None:
            break
        last = staged.select("post_seq", "post_id", F.flatten(F.transform(names[-1], _replies)).alias("roots")).where(F.size("roots") > 0)
        if last.isEmpty():
            break
        rows = last
    kind = "author string, score long, body string, upvote_ratio double"
    found = once(found, __f=F.from_json("node", kind))
    found = with_texts(found, F.col("node"))
    return found.select("post_seq", "post_id", "path", (F.size("path") - 1).alias("depth"), "__f.*", "opening", "closing")


def _replies(node: Column) -> Column:
    replies = F.from_json(node["node"], "struct<replies:array<string>>")["replies"]
    below = F.transform(replies, lambda r, i: F.struct(F.concat(node["path"], F.array(i)).alias("path"), r.alias("node")))
    return F.coalesce(below, F.array().cast(_NODES))


def with_texts(comments: DataFrame, node: Column) -> DataFrame:
    """comments with opening and closing of a comment's JSON. Replies stay where they stood among the members; a comment that came without them gets none."""
    parted = with_members(comments, node, "__members")
    members = F.coalesce("__members", F.array().cast("array<struct<key:string,value:string>>"))
    parted = once(parted, __at=F.array_position(F.transform(members, lambda m: m["key"]), "replies"), __all=members)
    at = F.col("__at").cast("int")
    before = object_of(F.slice("__all", F.lit(1), F.greatest(at - 1, F.lit(0))))
    after = object_of(F.slice("__all", at + 1, F.size("__all")))
    body = lambda text: text.substr(F.lit(2), F.length(text) - 2)
    comma = lambda text, first: F.when(F.length(text) == 2, "").otherwise(F.concat(body(text), F.lit(",")) if first else F.concat(F.lit(","), body(text)))
    whole = object_of(F.col("__all"))
    opening = F.when(at > 0, F.concat(F.lit("{"), comma(before, True), F.lit('"replies":['))).otherwise(whole.substr(F.lit(1), F.length(whole) - 1))
    closing = F.when(at > 0, F.concat(F.lit("]"), comma(after, False), F.lit("}"))).otherwise(F.lit("}"))
    return once(parted, opening=opening, closing=closing).drop("__members", "__at", "__all")


def own_texts(comments: DataFrame, *fields: str) -> DataFrame:
    """comments of a table as JSON: opening and closing from columns; a null is left out, replies come last."""
    own = F.to_json(F.struct(*fields))
    head = F.when(F.length(own) > 2, F.concat(own.substr(F.lit(1), F.length(own) - 1), F.lit(","))).otherwise(F.lit("{"))
    return comments.withColumn("opening", F.concat(head, F.lit('"replies":['))).withColumn("closing", F.lit("]}"))


def chains(turns: DataFrame, post_id: str, turn: str) -> DataFrame:
    """Conversation turns as comments that each answer the one before: path [0, 0, ...], depth = turn."""
    path = F.array_repeat(F.lit(0), F.col(turn).cast("int") + 1)
    return turns.select("*", F.col(post_id).cast("long").alias("post_seq"), path.alias("path"), F.col(turn).cast("int").alias("depth"), F.col(post_id).cast("string").alias("post_id"))


def surviving(comments: DataFrame, gate: Gate = RELAXED, reason: str = "reason") -> DataFrame:
    """Comments that are valid and all of whose ancestors are valid; an invalid one takes its whole subtree along.

    In the order of paths the last comment of a lesser depth is a comment's ancestor at that depth. So one sort of each top-level comment's tree tells all: one shuffle, no join. Comments below
    the depth limit are invalid by rule. A comment whose parent is not there counts by the ancestors that are.
    """
    shallow = comments.where(F.size("path") <= gate.comment_max_depth + 1)
    before = Window.partitionBy("post_seq", F.col("path")[0]).orderBy("path").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lost = F.col(reason).isNotNull()
    staged = shallow
    for d in range(gate.comment_max_depth):
        here = F.struct(F.col("path").alias("path"), F.col(reason).isNotNull().alias("bad"))
        staged = staged.withColumn(f"__a{d}", F.last(F.when(F.col("depth") == d, here), ignorenulls=True).over(before))
        above = F.col(f"__a{d}")
        lost = lost | ((F.col("depth") > d) & F.coalesce(above["bad"] & (above["path"] == F.slice("path", 1, d + 1)), F.lit(False)))
    return staged.where(~lost).select(*comments.columns)


def thread_stats(comments: DataFrame) -> DataFrame:
    """For each post: comments, roots, greatest depth, distinct authors."""
    return comments.groupBy("post_id").agg(
        F.count("*").alias("n_comments"), F.count_if(F.col("depth") == 0).alias("n_roots"), F.max("depth").alias("max_depth"), F.countDistinct("author").alias("n_authors")
    )


#: Stands before each comment; no JSON text holds it as it is.
_MARK = "\u0001"


def renest(comments: DataFrame) -> DataFrame:
    """post_seq, comments: each post's trees as JSON again, children in path order, each comment with the fields that it came with (columns opening and closing, or those of FLAT).

    A comment opens before its replies and closes after them, so each gives two texts, sorted by path: one shuffle by post, one sort, one join of texts.
    """
    if "opening" not in comments.columns:
        comments = own_texts(comments, "author", "score", "body", "upvote_ratio")
    last = F.lit(2147483647)
    texts = F.array(F.struct(F.col("path").alias("key"), F.concat(F.lit(_MARK), F.col("opening")).alias("text")), F.struct(F.array_append("path", last).alias("key"), F.col("closing").alias("text")))
    rows = comments.select("post_seq", F.explode(texts).alias("t")).groupBy("post_seq").agg(F.array_sort(F.collect_list("t")).alias("t"))
    joined = F.concat(F.lit("["), F.array_join(F.transform("t", lambda x: x["text"]), ""), F.lit("]"))
    # the first of a list has no comma before it
    return rows.select("post_seq", F.translate(F.replace(joined, F.lit("[" + _MARK), F.lit("[")), _MARK, ",").alias("comments"))
