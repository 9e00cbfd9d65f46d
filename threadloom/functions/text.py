"""The text kernel: columns from built-in functions only, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..config import RELAXED, Gate

#: White space as Unicode has it, with the four ASCII separators: the set on which str.isspace() is true.
WS = r"[\t-\r\x1c-\x1f\x85\p{Z}]"
#: The same set as its characters.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
URL = r"https?://\S+|www\.\S+"
#: Six ranges whose runs count as emojis; the last also covers CJK, kana and Hangul.
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]+"
#: Fixed value: the characters that count as punctuation.
PUNCTUATION = r"!@#$%^&*()_+-=[]{}|;:',.<>?/~`"
PUNCT = "[" + "".join("\\" + c for c in PUNCTUATION) + "]"
NO_PUNCT = PUNCT.replace("[", "[^", 1) + "+"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{WS}+"), "")


def word_count(text: Column) -> Column:
    return F.size(F.coalesce(words(text), F.array().cast("array<string>")))


def lowered(ws: Column) -> Column:
    return F.transform(ws, F.lower)


def urls(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(URL), F.lit(0))


def url_count(text: Column) -> Column:
    return url_count_of(F.lower(text))


def url_count_of(low: Column) -> Column:
    """URLs of a text that is in lower case already."""
    return F.when(F.contains(low, F.lit("http")) | F.contains(low, F.lit("www.")), F.regexp_count(low, F.lit(URL))).when(low.isNotNull(), 0)


def emoji_runs(text: Column) -> Column:
    """An all-ASCII text has none and is not searched."""
    return F.when(F.octet_length(text) > F.length(text), F.regexp_count(text, F.lit(EMOJI))).when(text.isNotNull(), 0)


def long_words(ws: Column) -> Column:
    """The lower-cased words of more than two characters."""
    return F.transform(F.filter(ws, lambda w: F.length(w) > 2), F.lower)


def unique_long(ws: Column) -> Column:
    """How many distinct ones there are."""
    return F.size(F.array_distinct(long_words(ws)))


def unique_ratio(ws: Column) -> Column:
    return F.try_divide(unique_long(ws).cast("double"), F.size(ws))


def alpha_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"\P{L}+", ""))


def upper_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"\P{Lu}+", ""))


def caps_ratio(text: Column) -> Column:
    return F.try_divide(upper_count(text).cast("double"), alpha_count(text))


def punct_ratio(text: Column) -> Column:
    return F.try_divide(F.length(F.regexp_replace(text, NO_PUNCT, "")).cast("double"), F.length(text))


def avg_word_len(ws: Column) -> Column:
    return F.try_divide(F.length(F.array_join(ws, "")).cast("double"), F.size(ws))


def max_word_count(ws: Column) -> Column:
    """Occurrences of the most frequent lower-cased word of more than two characters; runs of the sorted words are counted in one pass."""
    ordered = F.array_sort(F.transform(F.filter(ws, lambda w: F.length(w) > 2), F.lower))
    none = F.struct(F.lit("").alias("word"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, word: Column) -> Column:
        run = F.when(acc["word"] == word, acc["run"] + 1).otherwise(1)
        return F.struct(word.alias("word"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(ordered, none, step, lambda acc: acc["best"])


def max_word_freq(ws: Column) -> Column:
    """Its share of all words; null for five words or fewer."""
    return F.when(F.size(ws) > 5, F.try_divide(max_word_count(ws).cast("double"), F.size(ws)))


def repeats(long: Column, n: Column, share: float) -> Column:
    """Has any of the long words more than `share` of n occurrences. In sorted order such a word's run is longer than that, so it holds one of a few places, and
    the word at each of these is looked up: no word is counted."""
    least = F.floor(n * share).cast("int") + 1
    run = least + F.when(F.try_divide(least, n) <= share, 1).otherwise(0)  # a product that was rounded down
    ordered = F.sort_array(long)

    def at(i: int) -> Column:
        word = F.try_element_at(ordered, run * i)
        return F.coalesce(F.try_element_at(ordered, (F.array_position(ordered, word) + run - 1).cast("int")) == word, F.lit(False))

    out = at(1)
    for i in range(2, int(1 / share) + 1):
        out = out | at(i)
    return (n > 5) & out


def any_of(text: Column, patterns: tuple[str, ...]) -> Column:
    """Does the lower-cased text contain any of the strings, anywhere."""
    return any_in(F.lower(text), patterns)


def any_in(low: Column, patterns: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | F.contains(low, F.lit(p))
    return out


def fence_stripped(text: Column) -> Column:
    """What a Markdown code fence holds: after ```json up to the next fence, else between the first two fences, else the text."""
    tagged = F.element_at(F.split(text, "```json", 2), -1)
    return F.trim(F.when(F.contains(text, F.lit("```json")), F.split(tagged, "```", 2)[0]).when(F.contains(text, F.lit("```")), F.try_element_at(F.split(text, "```", 3), F.lit(2))).otherwise(text))


def from_brace(text: Column) -> Column:
    """The text from its first { on; null without one."""
    at = F.instr(text, "{")
    return F.when(at > 0, text.substr(at, F.length(text)))


def preview(text: Column, n: int) -> Column:
    return F.concat(F.substring(text, 1, n), F.lit("..."))


def linear(value: Column, low: float, high: float, to_low: float, to_high: float) -> Column:
    """Linear scale, held at its ends."""
    return F.lit(float(to_low)) + (F.greatest(F.lit(low), F.least(F.lit(high), value.cast("double"))) - low) * (to_high - to_low) / (high - low)


def register(spark: SparkSession, gate: Gate = RELAXED) -> None:
    """Names these functions in SQL, as SQL functions over built-ins: word_count(text), url_count(text), emoji_runs(text), is_blocked_url(text), is_spam(text)."""
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    like = lambda patterns: " OR ".join(f"contains(lower(text), {quote(p)})" for p in patterns)
    for name, kind, body in (
        ("word_count", "INT", f"coalesce(size(filter(split(text, {quote(WS + '+')}), w -> w <> '')), 0)"),
        ("url_count", "INT", f"regexp_count(lower(text), {quote(URL)})"),
        ("emoji_runs", "INT", f"regexp_count(text, {quote(EMOJI)})"),
        ("is_blocked_url", "BOOLEAN", like(gate.blocked_urls)),
        ("is_spam", "BOOLEAN", like(gate.spam_keywords)),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS {kind} RETURN {body}")
