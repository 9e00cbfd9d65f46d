"""The quality and spam gate: one CASE, whose order decides which reason is given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RELAXED, Gate
from ..functions import text as T
from ..functions.columns import once


def with_reason(rows: DataFrame, text_col: str = "text", *, min_words: int, gate: Gate = RELAXED, before: Column | None = None, prefix: str = "content_quality: ", name: str = "reason") -> DataFrame:
    """Adds the first reason to reject a text; null if it passes. `before` is a reason that goes first (from metadata).

    Words, their lower-cased forms and the reason itself are worked out once for a row (`once`), whatever filters follow. A text that metadata rejects is not cut into words; what
    stands in one arm only is worked out if the arms before it did not decide.
    """
    first = before if before is not None else F.lit(None).cast("string")
    text = F.coalesce(F.col(text_col), F.lit(""))
    staged = once(rows, __meta=first, __c=T.strip(text))
    staged = once(staged, __w=F.when(F.col("__meta").isNull(), T.words(F.col("__c"))))
    w, c = F.col("__w"), F.col("__c")
    early = F.when(F.col("__meta").isNotNull(), F.col("__meta")).when(F.size(w) < min_words, "too_few_words")
    staged = once(staged, __early=early, __long=F.when(early.isNull(), T.long_words(w)), __low=F.when(early.isNull(), F.lower(text)))
    long, low, n = F.col("__long"), F.col("__low"), F.size(w)
    distinct, upper = F.col("__distinct"), F.col("__upper")
    staged = once(staged, __distinct=F.size(F.array_distinct(long)), __upper=F.when(F.col("__early").isNull(), T.upper_count(c)))
    content = (
        F.when(F.col(text_col).isNull() | (F.col(text_col) == ""), "empty_text")
        .when(F.lower(c).isin("[removed]", "[deleted]", ""), "removed_or_deleted")
        .when(n == 0, "no_words")
        .when((distinct > 0) & (distinct / n < gate.min_unique_ratio), "low_unique_words")
        .when((upper > 0) & (upper / T.alpha_count(c) > gate.max_caps_ratio), "too_much_caps")
        .when(T.emoji_runs(c) > gate.max_emoji_runs, "too_many_emojis")
        .when(T.punct_ratio(c) > gate.max_punct_ratio, "too_much_punctuation")
        .when(T.avg_word_len(w) < gate.min_avg_word_len, "too_short_words")
        .when(T.repeats(long, n, gate.max_repeat_ratio), "too_repetitive")
        .when(T.url_count_of(low) > gate.max_urls, "too_many_urls")
        .when(T.any_in(low, gate.blocked_urls), "blocked_url_pattern")
        .when(T.any_in(low, gate.spam_keywords), "spam_keyword")
    )
    reason = F.when(F.col("__early").isNotNull(), F.col("__early")).otherwise(F.concat(F.lit(prefix), content))
    return once(staged, **{name: reason}).drop("__meta", "__c", "__w", "__early", "__long", "__low", "__distinct", "__upper")


def post_metadata_reason(gate: Gate = RELAXED, age: str = "author_account_age_days", karma: str = "author_comment_karma", score: str = "score") -> Column:
    """A missing or null value counts as 0."""
    value = lambda c: F.coalesce(F.col(c), F.lit(0))
    return F.when(value(age) < gate.post_min_age_days, "low_account_age").when(value(karma) < gate.post_min_karma, "low_karma").when(value(score) < gate.post_min_score, "low_score")


def gated_posts(posts: DataFrame, gate: Gate = RELAXED) -> DataFrame:
    """posts with `reason`: metadata, words, quality, spam, in this order."""
    return with_reason(posts, "selftext", min_words=gate.post_min_words, gate=gate, before=post_metadata_reason(gate))


def comment_metadata_reason(gate: Gate = RELAXED) -> Column:
    reason = F.when(F.col("depth") > gate.comment_max_depth, "max_depth_exceeded")
    if gate.comment_min_age_days is not None:
        reason = reason.when(F.coalesce(F.col("author_account_age_days"), F.lit(0)) < gate.comment_min_age_days, "low_account_age")
    if gate.comment_min_karma is not None:
        reason = reason.when(F.coalesce(F.col("author_comment_karma"), F.lit(0)) < gate.comment_min_karma, "low_karma")
    reason = reason.when(F.col("upvote_ratio") < gate.comment_min_upvote_ratio, "low_upvote_ratio")
    if gate.comment_min_score is not None:
        reason = reason.when(F.coalesce(F.col("score"), F.lit(0)) < gate.comment_min_score, "low_score")
    return reason


def gated_comments(comments: DataFrame, gate: Gate = RELAXED) -> DataFrame:
    """Flat comments (depth, upvote_ratio, body, ...) with `reason`."""
    return with_reason(comments, "body", min_words=gate.comment_min_words, gate=gate, before=comment_metadata_reason(gate))
