"""The three runs: posts to batches, batches to graph and reports, graph to what is drawn. And how a run survives failures."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CAPACITY, RELAXED, Gate
from ..operators import backends, batching, dedup, gate, graph, render, reports, tree
from ..sources.sinks import cut

log = logging.getLogger(__name__)


def retried(step: Callable, attempts: int = 3, delay: float = 5.0) -> Callable:
    """step, tried `attempts` times in all; the last failure is raised."""

    def run(*args, **kwargs):
        for i in range(1, attempts + 1):
            try:
                return step(*args, **kwargs)
            except Exception:
                log.warning("%s failed, attempt %d of %d", getattr(step, "__name__", step), i, attempts, exc_info=True)
                if i == attempts:
                    raise
                time.sleep(delay)

    return run


def undone(batches: DataFrame, done: DataFrame) -> DataFrame:
    """Batches whose index is not among the done ones: what is left after a crash."""
    return batches.join(done.select("batch_index").distinct(), "batch_index", "left_anti")


@dataclass(frozen=True)
class Run:
    """What one filter run found; every figure of it reads these tables and walks nothing again.

    posts with the final `reason`; all top-level comments by post_seq (`original`); and the comments of posts that the gate passes, with their `reason` and `post_kept`.
    """

    posts: DataFrame
    comments: DataFrame
    original: DataFrame

    def reasons(self) -> DataFrame:
        """seq, post_id, reason of every post: the gate's, or duplicate_post."""
        return self.posts.select("seq", "post_id", "reason")

    def kept(self) -> tuple[DataFrame, DataFrame]:
        """(posts, comments) that pass, without those below a comment that does not."""
        return self.posts.where("reason IS NULL").drop("reason"), tree.surviving(self.comments.where("post_kept")).drop("reason", "post_kept")

    def stats(self) -> DataFrame:
        """seq, post_id, original_comments, kept_comments of each post that passes: its top-level comments, and those of them that pass."""
        kept = self.comments.where("depth = 0 AND post_kept AND reason IS NULL").groupBy(F.col("post_seq").alias("__k")).agg(F.count("*").alias("kept"))
        good = self.posts.where("reason IS NULL").select("seq", F.col("post_id").cast("string").alias("post_id"))
        counts = good.join(self.original, F.col("seq") == F.col("__o"), "left").join(kept, F.col("seq") == F.col("__k"), "left")
        return counts.select("seq", "post_id", F.coalesce("original", F.lit(0)).alias("original_comments"), F.coalesce("kept", F.lit(0)).alias("kept_comments"))

    def comment_summary(self) -> DataFrame:
        """One row: total, kept and rejected top-level comments. Those of a rejected post are all rejected; replies are not counted."""
        total = self.original.agg(F.coalesce(F.sum("original"), F.lit(0)).alias("total_comments"))
        kept = self.comments.where("depth = 0 AND post_kept AND reason IS NULL").agg(F.count("*").alias("kept_comments"))
        return total.join(F.broadcast(kept)).withColumn("rejected_comments", F.col("total_comments") - F.col("kept_comments"))  # one row and one

    def metrics(self) -> DataFrame:
        """One row: posts and top-level comments, all, kept and rejected, and the reasons by how often they were given (ties by name)."""
        posts = self.posts.agg(F.count("*").alias("original_posts"), F.count_if(F.col("reason").isNull()).alias("kept_posts"), F.count_if(F.col("reason").isNotNull()).alias("rejected_posts"))
        counts = self.posts.where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))
        listed = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("back"), "reason"))), lambda x: F.struct(x["reason"].alias("reason"), (-x["back"]).alias("n")))
        names = {"total_comments": "original_comments"}
        return posts.join(F.broadcast(self.comment_summary().withColumnsRenamed(names))).join(F.broadcast(counts.agg(listed.alias("rejection_reasons"))))  # one row each


def filter_run(posts: DataFrame, comments: DataFrame, limits: Gate = RELAXED) -> Run:
    """The gate, then exact and fuzzy deduplication of posts and their top-level comments as one sequence.

    posts: seq, post_id, selftext, metadata; comments: flat, by post_seq. A post comes before its comments, posts in order of seq; the comments of a rejected post are not looked at.
    Replies are never deduplicated. post_id is data only: it may be missing, and posts may share one.
    """
    # gated once, read several times
    posts = cut(gate.gated_posts(posts, limits), "gated-posts")
    original = comments.where("depth = 0").groupBy(F.col("post_seq").alias("__o")).agg(F.count("*").alias("original"))
    good = posts.where("reason IS NULL").select(F.col("seq").alias("__good"))
    comments = cut(gate.gated_comments(comments, limits).join(good, F.col("post_seq") == F.col("__good"), "left_semi"), "gated-comments")
    at = (F.col("path")[0] + 1).cast("int")
    heads = posts.where("reason IS NULL").select("seq", F.lit(0).alias("at"), F.col("selftext").alias("text"))
    roots = comments.where("depth = 0 AND reason IS NULL").select(F.col("post_seq").alias("seq"), at.alias("at"), F.col("body").alias("text"))
    kept = dedup.walked(heads.unionByName(roots), gate=limits).where(F.col("status") == dedup.KEPT)
    kept_posts = kept.where("at = 0").select(F.col("seq").alias("__seq"), F.lit(True).alias("post_kept"))
    kept_roots = kept.where("at > 0").select(F.col("seq").alias("__seq"), F.col("at").alias("__at"), F.lit(True).alias("__kept"))
    posts = posts.join(kept_posts, F.col("seq") == F.col("__seq"), "left").withColumn("reason", F.coalesce("reason", F.when(F.col("post_kept").isNull(), "duplicate_post"))).drop("__seq", "post_kept")
    comments = comments.join(kept_roots, (F.col("post_seq") == F.col("__seq")) & (F.col("depth") == 0) & (at == F.col("__at")), "left").drop("__seq", "__at")
    comments = comments.withColumn("reason", F.coalesce("reason", F.when((F.col("depth") == 0) & F.col("__kept").isNull(), "duplicate_comment"))).drop("__kept")
    comments = comments.join(kept_posts, F.col("post_seq") == F.col("__seq"), "left").drop("__seq").withColumn("post_kept", F.coalesce("post_kept", F.lit(False)))
    return Run(posts, comments, original)


def judged_texts(posts: DataFrame, comments: DataFrame, limits: Gate = RELAXED) -> tuple[DataFrame, DataFrame]:
    """(posts, comments) with the final `reason`; only comments whose post the gate passes, with post_kept."""
    run = filter_run(posts, comments, limits)
    return run.posts, run.comments


def filtered(posts: DataFrame, comments: DataFrame, limits: Gate = RELAXED) -> tuple[DataFrame, DataFrame]:
    """(posts, comments) that pass: the gate, then exact and fuzzy deduplication of posts and their top-level comments as one sequence, then the loss of subtrees."""
    return filter_run(posts, comments, limits).kept()


def post_stats(posts: DataFrame, comments: DataFrame, limits: Gate = RELAXED) -> DataFrame:
    """seq, post_id, original_comments, kept_comments of each post that passes."""
    return filter_run(posts, comments, limits).stats()


def whole_posts(posts: DataFrame, comments: DataFrame, stats: DataFrame) -> DataFrame:
    """posts with `post_json`: what is left of them with the comments that are left (flat) and the filter counts, every field that they came with included."""
    nested = tree.renest(comments).select(F.col("post_seq").alias("__of"), F.col("comments").alias("__trees"))
    joined = with_filter_stats(posts, stats).join(nested, F.col("seq") == F.col("__of"), "left")
    return render.with_json(joined, F.col("__trees"), F.col("_filter_stats")).drop("__of", "__trees")


def prepared(posts: DataFrame, comments: DataFrame, limits: Gate = RELAXED, capacity: int = CAPACITY) -> DataFrame:
    """Batches ready for a model: batch_index, post_count, original_tokens, text_for_llm, compressed_tokens, tokens_saved, percent_saved. Posts are packed by the tokens of their
    indented JSON with all their fields, comments and filter counts; the compact text is what a batch holds."""
    run = filter_run(posts, comments, limits)
    good, kept = run.kept()
    kept = cut(kept, "kept-comments")
    whole = whole_posts(render.with_text(good, kept), kept, run.stats())
    texts = cut(whole.select("seq", "post_text", batching.estimated_json_tokens(F.col("post_json")).alias("tokens")), "post-texts")
    batches = render.batch_texts(batching.packed(texts.select("seq", "tokens"), capacity), texts)
    batches = batches.withColumn("compressed_tokens", batching.estimated_tokens(F.col("text_for_llm")))
    saved, percent = batching.savings(F.col("original_tokens"), F.col("compressed_tokens"))
    return batches.withColumn("tokens_saved", saved).withColumn("percent_saved", percent)


def graph_of(batches: DataFrame, backend: backends.Backend | None = None) -> tuple[DataFrame, DataFrame]:
    """(vertices, edges). The graph is built from the extraction table, in which a batch stands once, so a batch that is run twice counts once."""
    found = backends.extract(batches, backend)
    valid = graph.with_validity(backends.relations_of(found)).where("valid")
    typed = graph.with_types(valid, backends.entities_of(found))
    return graph.vertex_merge(typed), graph.edge_merge(typed)


def report_of(vertices: DataFrame, edges: DataFrame, backend: backends.Backend | None = None) -> DataFrame:
    """The lens reports on the 50 heaviest edges."""
    return reports.lens_reports(graph.summary_lines(graph.top_edges(edges, vertices, 50)), backend)


def completion(batches: DataFrame, relations: DataFrame, seconds: float | None = None, backup: str | None = None) -> DataFrame:
    """One row: status, completed_at, total_batches_processed, total_relations_added, duration_seconds, seconds_per_batch, backup_file."""
    n = batches.agg(F.count("*").alias("total_batches_processed"))
    added = graph.counters(relations).select(F.col("added").alias("total_relations_added"))
    spent = F.lit(seconds).cast("double")
    return n.join(F.broadcast(added)).select(  # one row and one
        F.lit("completed").alias("status"), F.current_timestamp().alias("completed_at"), "total_batches_processed", "total_relations_added", spent.alias("duration_seconds"),
        F.try_divide(spent, F.col("total_batches_processed")).alias("seconds_per_batch"), F.lit(backup).cast("string").alias("backup_file"),
    )


def final_reasons(posts: DataFrame, comments: DataFrame, limits: Gate = RELAXED) -> DataFrame:
    """seq, post_id, reason of every post: the gate's, or duplicate_post."""
    return filter_run(posts, comments, limits).reasons()


def comment_summary(posts: DataFrame, comments: DataFrame, limits: Gate = RELAXED) -> DataFrame:
    """One row: total, kept and rejected top-level comments."""
    return filter_run(posts, comments, limits).comment_summary()


def with_filter_stats(posts: DataFrame, stats: DataFrame) -> DataFrame:
    """posts with _filter_stats (original_comments, kept_comments) from a table of those by seq."""
    counted = stats.select(F.col("seq").alias("__post"), F.struct("original_comments", "kept_comments").alias("_filter_stats"))
    return posts.join(counted, F.col("seq") == F.col("__post"), "left").drop("__post")
