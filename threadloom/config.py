"""Limits of the text gate and the packing. Profiles are frozen; a changed copy comes from dataclasses.replace."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Gate:
    # Thresholds and lists that decide which posts and comments pass.
    post_min_age_days: int = 1
    post_min_karma: int = -1000
    post_min_score: int = 1
    post_min_words: int = 15
    comment_min_words: int = 5
    comment_min_upvote_ratio: float = 0.0
    comment_max_depth: int = 10
    min_unique_ratio: float = 0.3
    max_caps_ratio: float = 0.5
    max_emoji_runs: int = 5
    max_punct_ratio: float = 0.3
    min_avg_word_len: float = 2.5
    max_repeat_ratio: float = 0.3
    max_urls: int = 2
    blocked_urls: tuple[str, ...] = ("bit.ly", "t.co", "tinyurl", "linktr.ee")
    spam_keywords: tuple[str, ...] = ("subscribe", "follow me", "check out my", "buy now", "free money")
    similarity: float = 0.85
    history: int = 100
    # Limits that only the strict profile applies to comments.
    comment_min_age_days: int | None = None
    comment_min_karma: int | None = None
    comment_min_score: int | None = None


RELAXED = Gate()
STRICT = Gate(comment_min_age_days=1, comment_min_karma=-1000, comment_min_score=-10)
#: Tokens of a batch.
CAPACITY = 16_000
