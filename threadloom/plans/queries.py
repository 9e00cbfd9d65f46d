"""A query for each operator, with the SQL that says the same for a check by another engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CAPACITY, RELAXED, Gate
from ..functions import text as T
from ..functions.columns import once
from ..functions.members import quoted
from ..functions import udtfs
from ..functions.repair import mended_json
from ..operators import backends, batching, dedup, gate, graph, render, reports, tree
from ..sources import buckets, readers, sinks
from . import flow, tables

#: The gate with exact copies only, which SQL can say too: no similarity is above 1.
EXACT = Gate(similarity=1.0)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# ---- SQL pieces ----
_WS = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]"
_PUNCT = T.PUNCT.replace("'", "''")


def _strip(t: str) -> str:
    return f"regexp_replace({t}, '^{_WS}+|{_WS}+$', '', 'g')"


def _count(t: str, pattern: str) -> str:
    return f"len(regexp_extract_all({t}, '{pattern}'))"


def _any(t: str, patterns: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower({t}), '{p}')" for p in patterns) + ")"


def _features(table: str, key: str, text: str) -> str:
    """A row for each text with everything that the gate looks at."""
    return f"""
  SELECT {key}, t, c, w, len(w) AS n,
    len(list_distinct(lw)) AS n_long, len(list_distinct(lw)) / nullif(len(w), 0) AS unique_ratio,
    {_count("c", r"\p{Lu}")} / nullif({_count("c", r"\p{L}")}, 0) AS caps_ratio,
    {_count("c", T.EMOJI)} AS emoji_runs,
    {_count("c", _PUNCT)} / nullif(length(c), 0) AS punct_ratio,
    list_sum(list_transform(w, lambda x: length(x))) / nullif(len(w), 0) AS avg_word_len,
    CASE WHEN len(w) > 5 THEN coalesce(list_max(map_values(list_histogram(lw))), 0) / len(w) END AS max_word_freq,
    {_count("lower(t)", T.URL)} AS n_urls, {_any("t", RELAXED.blocked_urls)} AS blocked_url, {_any("t", RELAXED.spam_keywords)} AS spam_keyword
  FROM (SELECT *, list_transform(list_filter(w, lambda x: length(x) > 2), lambda x: lower(x)) AS lw
    FROM (SELECT *, list_filter(string_split_regex(c, '{_WS}+'), lambda x: x <> '') AS w
      FROM (SELECT {key}, coalesce({text}, '') AS t, {_strip(f"coalesce({text}, '')")} AS c FROM {table})))"""


def _reason(min_words: int, before: str = "") -> str:
    p = "content_quality: "
    return f"""CASE {before} WHEN n < {min_words} THEN 'too_few_words'
    WHEN n_long > 0 AND unique_ratio < 0.3 THEN '{p}low_unique_words' WHEN caps_ratio > 0.5 THEN '{p}too_much_caps' WHEN emoji_runs > 5 THEN '{p}too_many_emojis'
    WHEN punct_ratio > 0.3 THEN '{p}too_much_punctuation' WHEN avg_word_len < 2.5 THEN '{p}too_short_words' WHEN max_word_freq > 0.3 THEN '{p}too_repetitive'
    WHEN n_urls > 2 THEN '{p}too_many_urls' WHEN blocked_url THEN '{p}blocked_url_pattern' WHEN spam_keyword THEN '{p}spam_keyword' END"""


_DOCS = f"feature AS ({_features('documents', 'doc_id', 'text')}), judged AS (SELECT *, {_reason(15)} AS reason FROM feature)"
_POSTS = """post AS (SELECT d.doc_id, d.text, coalesce(l.quality, 0) AS score, d.doc_id % 4 AS age, 1000 - length(d.text) AS karma, d.source, d.lang
  FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l USING (doc_id))"""
_META = "WHEN age < 1 THEN 'low_account_age' WHEN karma < -1000 THEN 'low_karma' WHEN score < 1 THEN 'low_score'"
_GATED = f"{_POSTS}, feature AS ({_features('post', 'doc_id, score, age, karma, source, lang', 'text')}), gated AS (SELECT *, {_reason(15, _META)} AS reason FROM feature)"
_TURNS = "turn_ AS (SELECT conv_id, turn, role, text AS body, CASE WHEN turn % 3 <> 0 THEN (conv_id % 7 - 1) / 10.0 END AS ratio FROM conversations)"
_JUDGED_TURNS = f"""{_TURNS}, cf AS ({_features('turn_', 'conv_id, turn, role, body, ratio', 'body')}),
  cj AS (SELECT *, {_reason(5, "WHEN turn > 10 THEN 'max_depth_exceeded' WHEN ratio < 0 THEN 'low_upvote_ratio'")} AS reason FROM cf)"""
_SURVIVING = f"""{_JUDGED_TURNS}, alive AS (SELECT conv_id, turn FROM cj WHERE turn = 0 AND reason IS NULL
  UNION ALL SELECT c.conv_id, c.turn FROM cj c JOIN alive a ON c.conv_id = a.conv_id AND c.turn = a.turn + 1 WHERE c.reason IS NULL)"""
_REL = """ev AS (SELECT *, event_type || '_' || (user_id % 10) AS source FROM events),
  rel0 AS (SELECT event_id AS seq, event_id // 100 AS batch_index, source, lead(source) OVER (PARTITION BY user_id ORDER BY event_id) AS target, event_type AS relation, props AS evidence FROM ev),
  rel AS (SELECT * FROM rel0 WHERE target IS NOT NULL),
  ent AS (SELECT event_id // 100 AS batch_index, event_id AS pos, source AS name, CASE event_type WHEN 'view' THEN 'Concept' WHEN 'signup' THEN 'Person' WHEN 'purchase' THEN 'Organization' ELSE 'Event' END AS type FROM ev WHERE event_id % 2 = 0),
  ft AS (SELECT batch_index, name, arg_min(type, pos) AS type FROM ent GROUP BY ALL),
  typed AS (SELECT r.*, coalesce(s.type, 'Unknown') AS s_type, coalesce(t.type, 'Unknown') AS t_type FROM rel r
    LEFT JOIN ft s ON s.batch_index = r.batch_index AND s.name = r.source LEFT JOIN ft t ON t.batch_index = r.batch_index AND t.name = r.target),
  vertex AS (SELECT name, arg_min(type, seq * 2 + side) AS type, min(seq) AS first_seen, nullif(count(*) - 1, 0) AS count
    FROM (SELECT seq, 0 AS side, source AS name, s_type AS type FROM typed UNION ALL SELECT seq, 1, target, t_type FROM typed) GROUP BY name),
  edge AS (SELECT source, target, arg_min(relation, seq) AS relation, arg_min(evidence, seq) AS evidence, count(*) AS weight FROM rel GROUP BY source, target),
  top AS (SELECT * FROM edge ORDER BY weight DESC, source, target LIMIT 100),
  und AS (SELECT least(source, target) AS a, greatest(source, target) AS b, arg_max(relation, r) AS relation, arg_max(weight, r) AS weight
    FROM (SELECT *, row_number() OVER (ORDER BY weight DESC, source, target) AS r FROM top) GROUP BY 1, 2),
  strength AS (SELECT name, sum(w) AS strength FROM (SELECT source AS name, weight AS w FROM top UNION ALL SELECT target, weight FROM top) GROUP BY name)"""
_TOPV = "SELECT e.source, e.target, e.relation, e.evidence, e.weight, s.type AS s_type, t.type AS t_type FROM edge e JOIN vertex s ON s.name = e.source JOIN vertex t ON t.name = e.target ORDER BY weight DESC, e.source, e.target LIMIT"
_TEXT = "'[POST]' || chr(10) || 'ID: ' || doc_id || chr(10) || 'Author: ' || source || chr(10) || 'Title: ' || lang || chr(10) || 'Score: ' || score || chr(10) || 'Body: ' || text || chr(10) || '[/POST]' || chr(10)"
_SUM = "CAST({} AS BIGINT)"


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _docs(spark, d):
    return tables.read(spark, d, "documents")


def _staged(spark, d):
    return _docs(spark, d).select("doc_id", "text", T.strip(F.col("text")).alias("c")).withColumn("w", T.words(F.col("c")))


def _r(c):
    return F.round(c, 6)


# ---- text kernel ----
@query(f"WITH {_DOCS} SELECT doc_id, n AS n_words FROM feature")
def word_count(spark, d):
    return _docs(spark, d).select("doc_id", T.word_count(F.col("text")).alias("n_words"))


@query(f"SELECT doc_id, {_count('lower(text)', T.URL)} AS n_urls, coalesce(regexp_extract(lower(text), '{T.URL}'), '') AS first_url FROM documents")
def url_extract(spark, d):
    return _docs(spark, d).select("doc_id", T.url_count(F.col("text")).alias("n_urls"), F.coalesce(F.try_element_at(T.urls(F.col("text")), F.lit(1)), F.lit("")).alias("first_url"))


@query(f"WITH {_DOCS} SELECT doc_id, emoji_runs FROM feature")
def emoji_runs(spark, d):
    return _docs(spark, d).select("doc_id", T.emoji_runs(T.strip(F.col("text"))).alias("emoji_runs"))


@query(f"WITH {_DOCS} SELECT doc_id, n_long, round(unique_ratio, 6) AS unique_ratio FROM feature")
def unique_ratio(spark, d):
    return _staged(spark, d).select("doc_id", T.unique_long(F.col("w")).alias("n_long"), _r(T.unique_ratio(F.col("w"))).alias("unique_ratio"))


@query(f"WITH {_DOCS} SELECT doc_id, round(caps_ratio, 6) AS caps_ratio FROM feature")
def caps_ratio(spark, d):
    return _staged(spark, d).select("doc_id", _r(T.caps_ratio(F.col("c"))).alias("caps_ratio"))


@query(f"WITH {_DOCS} SELECT doc_id, round(punct_ratio, 6) AS punct_ratio FROM feature")
def punct_ratio(spark, d):
    return _staged(spark, d).select("doc_id", _r(T.punct_ratio(F.col("c"))).alias("punct_ratio"))


@query(f"WITH {_DOCS} SELECT doc_id, round(avg_word_len, 6) AS avg_word_len FROM feature")
def avg_word_len(spark, d):
    return _staged(spark, d).select("doc_id", _r(T.avg_word_len(F.col("w"))).alias("avg_word_len"))


@query(f"WITH {_DOCS} SELECT doc_id, round(max_word_freq, 6) AS max_word_freq FROM feature")
def max_word_freq(spark, d):
    return _staged(spark, d).select("doc_id", _r(T.max_word_freq(F.col("w"))).alias("max_word_freq"))


@query(f"WITH {_DOCS} SELECT doc_id, n_urls, blocked_url, spam_keyword FROM feature")
def spam_patterns(spark, d):
    t = F.col("text")
    return _docs(spark, d).select("doc_id", T.url_count(t).alias("n_urls"), T.any_of(t, RELAXED.blocked_urls).alias("blocked_url"), T.any_of(t, RELAXED.spam_keywords).alias("spam_keyword"))


def _judged(spark, d):
    return gate.with_reason(_docs(spark, d).select("doc_id", "text"), "text", min_words=RELAXED.post_min_words)


@query(f"WITH {_DOCS} SELECT coalesce(reason, 'ok') AS reason, count(*) AS n FROM judged GROUP BY 1")
def gate_reasons(spark, d):
    return _judged(spark, d).groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"WITH {_DOCS} SELECT doc_id FROM judged WHERE reason IS NULL")
def gate_filter(spark, d):
    return _judged(spark, d).where("reason IS NULL").select("doc_id")


@query(f"WITH {_GATED} SELECT doc_id, reason FROM gated")
def post_metadata_gate(spark, d):
    return gate.gated_posts(tables.posts(spark, d)).select(F.col("seq").alias("doc_id"), "reason")


# ---- duplicates, summaries ----
_FIRST = f"first AS (SELECT min(doc_id) AS doc_id FROM (SELECT doc_id, lower({_strip('text')}) AS f FROM documents) GROUP BY f)"


@query(f"WITH {_FIRST} SELECT doc_id FROM first")
def exact_dedup(spark, d):
    return dedup.exact_dedup(_docs(spark, d), "text", "doc_id").select("doc_id")


# posts and their top-level comments in order, each looked at once with what was kept before it
_SEQUENCE = f"""{_POSTS}, feature AS MATERIALIZED ({_features('post', 'doc_id, score, age, karma, source, lang', 'text')}), gated AS MATERIALIZED (SELECT *, {_reason(15, _META)} AS reason FROM feature),
  {_JUDGED_TURNS.replace("cj AS (", "cj AS MATERIALIZED (")},
  item AS MATERIALIZED (SELECT row_number() OVER (ORDER BY seq, at_) AS rn, seq, at_, f FROM (
    SELECT doc_id AS seq, 0 AS at_, md5(lower(c)) AS f FROM gated WHERE reason IS NULL
    UNION ALL SELECT conv_id, 1, md5(lower(cj.c)) FROM cj JOIN gated g ON g.doc_id = cj.conv_id WHERE turn = 0 AND cj.reason IS NULL AND g.reason IS NULL)),
  walk AS (SELECT CAST(0 AS BIGINT) AS rn, CAST(-1 AS BIGINT) AS seq, 0 AS at_, CAST([] AS VARCHAR[]) AS seen, false AS head, false AS ok
    UNION ALL SELECT rn, seq, at_, CASE WHEN ok THEN list_append(seen, f) ELSE seen END, CASE WHEN at_ = 0 THEN ok ELSE head END, ok
    FROM (SELECT i.rn, i.seq, i.at_, i.f, w.seen, w.head, (i.at_ = 0 OR w.head) AND NOT list_contains(w.seen, i.f) AS ok FROM walk w JOIN item i ON i.rn = w.rn + 1)),
  kept AS MATERIALIZED (SELECT seq, at_ FROM walk WHERE ok),
  final AS MATERIALIZED (SELECT g.doc_id, coalesce(g.reason, CASE WHEN k.seq IS NULL THEN 'duplicate_post' END) AS reason FROM gated g LEFT JOIN kept k ON k.seq = g.doc_id AND k.at_ = 0)"""


def _both(spark, d):
    return tables.posts(spark, d), tables.comments(spark, d)


def _summary(reasons):
    return reasons.agg(F.count("*").alias("total_posts"), F.count_if(F.col("reason").isNull()).alias("kept_posts"), F.count_if(F.col("reason").isNotNull()).alias("rejected_posts"))


def _histogram(reasons):
    return reasons.where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


def _post_stats(stats):
    return stats.select(F.col("post_id").cast("long").alias("post_id"), "original_comments", "kept_comments")


@query()
def filter_summary(spark, d):
    return _summary(flow.final_reasons(*_both(spark, d)))


@query()
def rejection_histogram(spark, d):
    return _histogram(flow.final_reasons(*_both(spark, d)))


@query()
def per_post_stats(spark, d):
    return _post_stats(flow.post_stats(*_both(spark, d)))


@query()
def comment_summary(spark, d):
    return flow.comment_summary(*_both(spark, d))


@query(f"WITH RECURSIVE {_SEQUENCE} SELECT count(*) AS total_posts, count(*) FILTER (reason IS NULL) AS kept_posts, count(*) FILTER (reason IS NOT NULL) AS rejected_posts FROM final")
def filter_summary_exact(spark, d):
    return _summary(flow.final_reasons(*_both(spark, d), EXACT))


@query(f"""WITH RECURSIVE {_SEQUENCE}, c AS (SELECT count(*) AS n, count(k.seq) AS kept FROM cj LEFT JOIN kept k ON k.seq = cj.conv_id AND k.at_ = 1 WHERE turn = 0),
  r AS (SELECT reason, count(*) AS n FROM final WHERE reason IS NOT NULL GROUP BY reason)
  SELECT count(*) AS original_posts, count(*) FILTER (reason IS NULL) AS kept_posts, count(*) FILTER (reason IS NOT NULL) AS rejected_posts, (SELECT n FROM c) AS original_comments, (SELECT kept FROM c) AS kept_comments,
    (SELECT n - kept FROM c) AS rejected_comments, (SELECT string_agg(reason || ': ' || n, ', ' ORDER BY n DESC, reason) FROM r) AS reasons FROM final""")
def filter_metrics_exact(spark, d):
    """The figures that a filter run reports, all from one run."""
    found = flow.filter_run(*_both(spark, d), EXACT).metrics()
    listed = F.array_join(F.transform("rejection_reasons", lambda r: F.concat(r["reason"], F.lit(": "), r["n"].cast("string"))), ", ")
    return found.withColumn("reasons", listed).drop("rejection_reasons")


@query(f"WITH RECURSIVE {_SEQUENCE} SELECT reason, count(*) AS n FROM final WHERE reason IS NOT NULL GROUP BY reason")
def rejection_histogram_exact(spark, d):
    return _histogram(flow.final_reasons(*_both(spark, d), EXACT))


@query(f"""WITH RECURSIVE {_SEQUENCE} SELECT f.doc_id AS post_id, count(c.conv_id) AS original_comments, count(k.seq) AS kept_comments
  FROM final f LEFT JOIN (SELECT * FROM cj WHERE turn = 0) c ON c.conv_id = f.doc_id LEFT JOIN kept k ON k.seq = f.doc_id AND k.at_ = 1 WHERE f.reason IS NULL GROUP BY 1""")
def per_post_stats_exact(spark, d):
    return _post_stats(flow.post_stats(*_both(spark, d), EXACT))


@query(f"WITH RECURSIVE {_SEQUENCE} SELECT count(*) AS total_comments, count(k.seq) AS kept_comments, count(*) - count(k.seq) AS rejected_comments FROM cj LEFT JOIN kept k ON k.seq = cj.conv_id AND k.at_ = 1 WHERE turn = 0")
def comment_summary_exact(spark, d):
    return flow.comment_summary(*_both(spark, d), EXACT)


@query(f"""WITH RECURSIVE {_SEQUENCE} SELECT cj.conv_id AS post_id, coalesce(cj.reason, CASE WHEN k.seq IS NULL THEN 'duplicate_comment' END) AS reason
  FROM cj JOIN final f ON f.doc_id = cj.conv_id AND f.reason IS NULL LEFT JOIN kept k ON k.seq = cj.conv_id AND k.at_ = 1 WHERE turn = 0""")
def comment_dedup(spark, d):
    """Top-level comments of posts that pass, with the reason to reject them."""
    judged = flow.judged_texts(*_both(spark, d), EXACT)[1].where("depth = 0 AND post_kept")
    return judged.select(F.col("post_id").cast("long").alias("post_id"), "reason")


@query()
def fuzzy_dedup(spark, d):
    return dedup.fuzzy_dedup(_docs(spark, d), "text", "doc_id").select("doc_id")


@query()
def near_dup_pairs(spark, d):
    """(new, old) of documents within the gate's history of each other whose similarity exceeds the threshold."""
    return dedup.similar_pairs(dedup.place_of(_docs(spark, d).select("doc_id", "text"), "doc_id"), "text", "doc_id")


# ---- trees ----
def _comments(spark, d):
    return tables.comments(spark, d).withColumn("post_id", F.col("post_id").cast("long"))


@query(f"WITH {_TURNS} SELECT conv_id AS post_id, turn AS depth, turn + 1 AS path_length, role AS author, ratio AS upvote_ratio FROM turn_")
def comment_flatten(spark, d):
    return _comments(spark, d).select("post_id", "depth", F.size("path").alias("path_length"), "author", "upvote_ratio")


@query(f"WITH {_JUDGED_TURNS} SELECT conv_id AS post_id, turn AS depth, reason FROM cj")
def comment_gate(spark, d):
    return gate.gated_comments(_comments(spark, d)).select("post_id", "depth", "reason")


@query(f"WITH RECURSIVE {_SURVIVING} SELECT conv_id AS post_id, turn AS depth FROM alive")
def subtree_prune(spark, d):
    return tree.surviving(gate.gated_comments(_comments(spark, d))).select("post_id", "depth")


@query("SELECT conv_id AS post_id, turn AS depth FROM conversations WHERE turn <= 10")
def depth_cap(spark, d):
    return _comments(spark, d).where(F.col("depth") <= RELAXED.comment_max_depth).select("post_id", "depth")


@query("SELECT conv_id AS post_id, count(*) AS n_comments, count(*) FILTER (turn = 0) AS n_roots, max(turn) AS max_depth, count(DISTINCT role) AS n_authors FROM conversations GROUP BY 1")
def thread_stats(spark, d):
    return tree.thread_stats(_comments(spark, d))


_JSON_TURN = """'{"author":' || to_json(role) || ',"score":' || turn || ',"body":' || to_json(body) || coalesce(',"upvote_ratio":' || CAST(CAST(ratio AS DOUBLE) AS VARCHAR), '') || ',"replies":['"""


@query(f"WITH {_TURNS} SELECT conv_id AS post_id, '[' || string_agg({_JSON_TURN}, '' ORDER BY turn) || string_agg(']}}', '') || ']' AS comments FROM turn_ GROUP BY 1")
def renest_comments(spark, d):
    """Trees nested to JSON, flattened, and nested again."""
    nested = tree.renest(tables.comments(spark, d)).withColumn("post_id", F.col("post_seq"))
    again = tree.renest(tree.flatten_comments(nested, seq="post_seq", levels=None))
    return again.select(F.col("post_seq").alias("post_id"), "comments")


# ---- batches ----
def _texts(spark, d):
    texts = render.with_json(render.with_text(tables.posts(spark, d)))
    return once(texts, tokens=batching.estimated_json_tokens(F.col("post_json"))).drop("post_json")


_JSON_FIELDS = (("post_id", "doc_id"), ("author", "source"), ("title", "lang"), ("score", "score"), ("selftext", "text"), ("author_account_age_days", "age"), ("author_comment_karma", "karma"))
_JSON = "'{' || chr(10) || " + " || ".join(f"""'  "{k}": ' || coalesce(CAST(to_json({v}) AS VARCHAR), 'null') || ',' || chr(10)""" for k, v in _JSON_FIELDS) + """ || '  "comments": []' || chr(10) || '}'"""
_T = f"{_POSTS}, txt AS (SELECT doc_id, {_TEXT} AS t, {_JSON} AS j FROM post), tok AS MATERIALIZED (SELECT doc_id, t, CAST(ceil(length(j) / 4) AS BIGINT) AS tokens FROM txt)"
# best fit decreasing, an item at a time: bins holds what is left of each
_PLACED = f"""{_T}, item AS MATERIALIZED (SELECT row_number() OVER (ORDER BY tokens DESC, doc_id) AS rn, doc_id, tokens FROM tok WHERE tokens <= {CAPACITY}),
  bfd AS (SELECT CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS bin, CAST([] AS BIGINT[]) AS bins
    UNION ALL SELECT rn, CASE WHEN best IS NULL THEN len(bins) + 1 ELSE list_position(bins, best) END,
      CASE WHEN best IS NULL THEN list_append(bins, {CAPACITY} - tokens) ELSE list_transform(bins, lambda x, i: CASE WHEN i = list_position(bins, best) THEN x - tokens ELSE x END) END
    FROM (SELECT i.rn, i.tokens, b.bins, list_min(list_filter(b.bins, lambda x: x >= i.tokens)) AS best FROM bfd b JOIN item i ON i.rn = b.rn + 1)),
  placed AS MATERIALIZED (SELECT i.doc_id AS seq, i.tokens, CAST(b.bin AS INTEGER) AS batch_index, row_number() OVER (PARTITION BY b.bin ORDER BY b.rn) - 1 AS pos FROM bfd b JOIN item i ON i.rn = b.rn)"""
_BATCHES = f"{_PLACED}, bt AS (SELECT batch_index, count(*) AS post_count, CAST(sum(p.tokens) AS BIGINT) AS original_tokens, string_agg(t, chr(10) ORDER BY pos) AS text_for_llm FROM placed p JOIN tok ON doc_id = seq GROUP BY 1)"


@query(f"WITH {_T} SELECT doc_id, tokens FROM tok")
def token_counts(spark, d):
    return _texts(spark, d).select(F.col("seq").alias("doc_id"), F.col("tokens").cast("long").alias("tokens"))


@query(f"WITH {_T} SELECT doc_id, tokens FROM tok WHERE tokens > 2000")
def oversize_for_small_batches(spark, d):
    return batching.oversize(_texts(spark, d), 2000).select(F.col("seq").alias("doc_id"), F.col("tokens").cast("long").alias("tokens"))


@query(f"WITH {_T} SELECT doc_id, tokens FROM tok WHERE tokens > {CAPACITY}")
def oversize_filter(spark, d):
    return batching.oversize(_texts(spark, d)).select(F.col("seq").alias("doc_id"), F.col("tokens").cast("long").alias("tokens"))


def _placed(spark, d):
    return batching.packed(_texts(spark, d).select("seq", "tokens"))


@query(f"WITH RECURSIVE {_PLACED} SELECT seq, tokens, batch_index, pos FROM placed")
def bfd_batches(spark, d):
    return _placed(spark, d).select("seq", "tokens", "batch_index", "pos")


@query(f"WITH RECURSIVE {_PLACED} SELECT batch_index, CAST(sum(tokens) AS BIGINT) AS total_tokens, count(*) AS post_count, string_agg(CAST(seq AS VARCHAR), ',' ORDER BY pos) AS posts FROM placed GROUP BY 1")
def batch_rollup(spark, d):
    return batching.rolled_up(_placed(spark, d)).withColumn("posts", F.array_join(F.col("posts").cast("array<string>"), ","))


@query(f"WITH RECURSIVE {_PLACED} SELECT count(DISTINCT batch_index) AS batches, CAST(sum(tokens) AS BIGINT) AS tokens, round(sum(tokens) * 100.0 / (count(DISTINCT batch_index) * {CAPACITY}), 6) AS utilisation FROM placed")
def utilisation(spark, d):
    return batching.utilisation(_placed(spark, d)).withColumn("utilisation", _r(F.col("utilisation")))


@query(f"WITH {_T} SELECT doc_id, t AS post_text FROM tok")
def compress_posts(spark, d):
    return render.with_text(tables.posts(spark, d)).select(F.col("seq").alias("doc_id"), "post_text")


_PAD = "repeat('  ', turn)"


@query(f"""SELECT conv_id AS post_id, string_agg({_PAD} || '[COMMENT]' || chr(10) || {_PAD} || 'Author: ' || role || chr(10) || {_PAD} || 'Score: ' || turn || chr(10) || {_PAD} || 'Body: ' || text, chr(10) ORDER BY turn)
  || chr(10) || string_agg({_PAD} || '[/COMMENT]', chr(10) ORDER BY turn DESC) AS text FROM conversations GROUP BY 1""")
def comment_blocks(spark, d):
    return render.comment_blocks(tables.comments(spark, d)).withColumnRenamed("post_seq", "post_id")


@query(f"WITH RECURSIVE {_BATCHES} SELECT batch_index, post_count, original_tokens, text_for_llm FROM bt")
def batch_text(spark, d):
    texts = _texts(spark, d)
    return render.batch_texts(batching.packed(texts.select("seq", "tokens")), texts)


@query(f"WITH RECURSIVE {_BATCHES} SELECT batch_index, original_tokens - CAST(ceil(length(text_for_llm) / 4) AS BIGINT) AS saved, round((original_tokens - ceil(length(text_for_llm) / 4)) * 100.0 / nullif(original_tokens, 0), 6) AS percent FROM bt")
def savings(spark, d):
    """Of each batch, what its compact text saves against the JSON of its posts."""
    texts = _texts(spark, d)
    batches = render.batch_texts(batching.packed(texts.select("seq", "tokens")), texts)
    saved, percent = batching.savings(F.col("original_tokens"), batching.estimated_tokens(F.col("text_for_llm")).cast("long"))
    return batches.select("batch_index", saved.alias("saved"), _r(percent).alias("percent"))


@query()
def prepared_batches(spark, d):
    return flow.prepared(tables.posts(spark, d), tables.comments(spark, d))


# ---- graph ----
def _rel(spark, d):
    return graph.with_validity(tables.relations(spark, d)).where("valid").drop("valid")


def _typed(spark, d):
    return graph.with_types(_rel(spark, d), tables.entities(spark, d))


def _edges(spark, d):
    return graph.edge_merge(_rel(spark, d))


def _vertices(spark, d):
    return graph.vertex_merge(_typed(spark, d))


def _top100(spark, d):
    return _edges(spark, d).orderBy(F.desc("weight"), "source", "target").limit(100)


@query(f"WITH {_REL} SELECT count(*) FILTER (target IS NOT NULL) AS added, count(*) FILTER (target IS NULL) AS skipped FROM rel0")
def relation_validity(spark, d):
    return graph.counters(tables.relations(spark, d))


@query(f"WITH {_REL} SELECT seq, source, target, s_type, t_type FROM typed")
def type_lookup(spark, d):
    return _typed(spark, d).select("seq", "source", "target", "s_type", "t_type")


@query(f"WITH {_REL} SELECT name, type, first_seen, count FROM vertex")
def vertex_merge(spark, d):
    return _vertices(spark, d)


@query(f"WITH {_REL} SELECT source, target, relation, evidence, weight FROM edge")
def edge_merge(spark, d):
    return _edges(spark, d)


@query(f"WITH {_REL} SELECT source, target, relation, evidence, weight FROM edge")
def graph_incremental(spark, d):
    """The first half of the relations, then the second merged into it: the same graph."""
    rows = _rel(spark, d)
    half = rows.agg((F.max("seq") / 2).alias("half")).first().half
    return graph.merged_edges(graph.edge_merge(rows.where(F.col("seq") <= half)), graph.edge_merge(rows.where(F.col("seq") > half)))


@query(f"WITH {_REL} SELECT name, type, first_seen, count FROM vertex")
def vertex_incremental(spark, d):
    rows = _typed(spark, d)
    half = rows.agg((F.max("seq") / 2).alias("half")).first().half
    return graph.merged_vertices(graph.vertex_merge(rows.where(F.col("seq") <= half)), graph.vertex_merge(rows.where(F.col("seq") > half)))


@query("SELECT event_id // 100 AS batch_index, count(*) AS n, CASE WHEN (event_id // 100) % 2 = 0 THEN 'new' ELSE 'old' END AS version FROM events GROUP BY ALL")
def upsert_latest(spark, d):
    rows = tables.relations(spark, d).groupBy("batch_index").agg(F.count("*").alias("n"))
    return graph.upsert_latest(rows.withColumn("version", F.lit("old")), rows.where("batch_index % 2 = 0").withColumn("version", F.lit("new")))


@query("SELECT event_id // 100 AS batch_index, count(*) AS n FROM events WHERE (event_id // 100) % 3 <> 0 GROUP BY 1")
def resume_anti_join(spark, d):
    rows = tables.relations(spark, d).groupBy("batch_index").agg(F.count("*").alias("n"))
    return flow.undone(rows, rows.where("batch_index % 3 = 0"))


@query(f"WITH {_REL} {_TOPV} 50")
def top50_edges(spark, d):
    return graph.top_edges(_edges(spark, d), _vertices(spark, d), 50)


@query(f"WITH {_REL} {_TOPV} 100")
def top100_edges(spark, d):
    return graph.top_edges(_edges(spark, d), _vertices(spark, d), 100)


@query(f"WITH {_REL}, t AS ({_TOPV} 50) SELECT string_agg(source || ' (' || s_type || ') --[' || relation || ']--> ' || target || ' (' || t_type || ')', chr(10) ORDER BY weight DESC, source, target) AS summary FROM t")
def graph_summary_lines(spark, d):
    return graph.summary_lines(graph.top_edges(_edges(spark, d), _vertices(spark, d), 50))


@query(f"WITH {_REL} SELECT a, b, relation, weight FROM und")
def undirected_collapse(spark, d):
    return graph.undirected(_top100(spark, d))


@query(f"WITH {_REL} SELECT name, {_SUM.format('strength')} AS strength FROM strength")
def node_strength(spark, d):
    return graph.node_strength(_top100(spark, d))


@query(f"WITH {_REL}, m AS (SELECT min(strength) AS lo, max(strength) AS hi FROM strength) SELECT name, {_SUM.format('strength')} AS strength, round(25 + (strength - lo) / coalesce(nullif(hi - lo, 0), 1) * 50, 6) AS size FROM strength, m")
def node_sizes(spark, d):
    return graph.node_sizes(graph.node_strength(_top100(spark, d))).withColumn("size", _r(F.col("size")))


@query(f"WITH {_REL}, c AS (SELECT (SELECT count(*) FROM strength) AS n, (SELECT count(*) FROM und) AS e) SELECT n AS n_nodes, e AS n_edges, round(2.0 * e / greatest(n, 1), 6) AS average_degree, round(CASE WHEN e = 0 OR n <= 1 THEN 0 ELSE 2.0 * e / (n * (n - 1)) END, 6) AS density FROM c")
def graph_metrics(spark, d):
    out = graph.graph_metrics(graph.undirected(_top100(spark, d)))
    return out.select("n_nodes", "n_edges", _r(F.col("average_degree")).alias("average_degree"), _r(F.col("density")).alias("density"))


@query(f"WITH {_REL} SELECT CASE WHEN source = 'view_1' THEN target ELSE source END AS other, relation, weight FROM edge WHERE source = 'view_1' OR target = 'view_1'")
def neighbourhood(spark, d):
    return graph.neighbourhood(_edges(spark, d), "view_1")


_COLOURS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in graph.COLOURS.items())


@query(f"WITH {_REL}, m AS (SELECT min(strength) AS lo, max(strength) AS hi FROM strength) SELECT s.name, s.name || chr(10) || 'Type: ' || type AS title, type AS kind, CASE type {_COLOURS} ELSE '#95A5A6' END AS colour, round(25 + (strength - lo) / coalesce(nullif(hi - lo, 0), 1) * 50, 6) AS size FROM strength s JOIN vertex v ON v.name = s.name, m")
def render_nodes(spark, d):
    return graph.render_nodes(graph.node_sizes(graph.node_strength(_top100(spark, d))), _vertices(spark, d)).withColumn("size", _r(F.col("size")))


@query(f"WITH {_REL} SELECT 'e' || (row_number() OVER (ORDER BY source, target) - 1) AS id, source, target, relation AS reason, weight, CAST(greatest(1, least(5, weight)) AS DOUBLE) AS width FROM top")
def render_elements(spark, d):
    return graph.element_edges(_top100(spark, d))


@query(f"WITH {_REL} SELECT source, target, relation, weight FROM top ORDER BY weight DESC, source, target LIMIT 5")
def sample_edges(spark, d):
    return _top100(spark, d).orderBy(F.desc("weight"), "source", "target").limit(5).select("source", "target", "relation", "weight")


@query(f"WITH {_REL} SELECT a, b, relation AS title, relation AS label, weight, CAST(weight AS DOUBLE) AS value FROM und")
def render_edges(spark, d):
    return graph.render_edges(graph.undirected(_top100(spark, d)))


@query(f"WITH {_REL} SELECT name FROM strength ORDER BY name LIMIT 10")
def sample_head(spark, d):
    return graph.node_strength(_top100(spark, d)).select("name").orderBy("name").limit(10)


# ---- models, reports ----
_CUT = "left(props, greatest(length(props) - 7, 1))"


@query(f"""WITH p AS (SELECT event_id, trim({_CUT}) AS s FROM events WHERE props IS NOT NULL),
  t AS (SELECT event_id, [s] || flatten(list_transform(range(least(length(s), 500)), lambda d: list_transform(['}}', ']', ']}}'], lambda c: left(s, length(s) - d) || c))) AS tries FROM p),
  m AS (SELECT event_id, list_filter(tries, lambda x: json_valid(x))[1] AS j FROM t)
  SELECT event_id, CAST(json(j) AS VARCHAR) AS mended FROM m""")
def json_repair(spark, d):
    """The props of events, cut short by seven characters and mended."""
    rows = tables.read(spark, d, "events").where("props IS NOT NULL")
    return rows.select("event_id", mended_json(F.expr("substring(props, 1, greatest(length(props) - 7, 1))")).alias("mended"))


def _extractions(spark, d):
    return backends.extract(_docs(spark, d).select(F.col("doc_id").cast("int").alias("batch_index"), F.col("text").alias("text_for_llm")))


# spans of capitalised words: \w is letters, numbers and the underscore
_WORD = r"[\p{L}\p{N}_''-]"
_SPAN = f"[A-ZÀ-Þ]{_WORD}*(?: [A-ZÀ-Þ]{_WORD}*)*"
_ENDS = " ".join(f"WHEN string_split(lower(name), ' ')[-1] IN ({', '.join(repr(x) for x in ends)}) THEN '{kind}'" for kind, ends in backends.RuleBackend.KINDS)


@query(f"""WITH s AS (SELECT doc_id, unnest(regexp_extract_all(text, '{_SPAN}')) AS name FROM documents), c AS (SELECT doc_id, name, count(*) AS n FROM s GROUP BY ALL)
  SELECT CAST(doc_id AS INTEGER) AS batch_index, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, name) - 1 AS INTEGER) AS pos, name,
    CASE {_ENDS} WHEN length(name) - length(replace(name, ' ', '')) = 1 THEN 'Person' ELSE 'Concept' END AS type FROM c""")
def extract_entities(spark, d):
    return backends.entities_of(_extractions(spark, d))


@query(f"""WITH s AS (SELECT doc_id, unnest(string_split_regex(text, '[.!?\\n]+')) AS s, unnest(range(len(string_split_regex(text, '[.!?\\n]+')))) AS k FROM documents),
  p AS (SELECT doc_id, s, k, regexp_extract_all(s, '{_SPAN}') AS spans, string_split_regex(s, '{_SPAN}') AS gaps FROM s),
  r AS (SELECT *, unnest(range(1, len(spans))) AS i FROM p WHERE len(spans) > 1)
  SELECT CAST(doc_id AS INTEGER) AS batch_index, doc_id * 2147483648 + row_number() OVER (PARTITION BY doc_id ORDER BY k, i) - 1 AS seq, spans[i] AS source, spans[i + 1] AS target,
    coalesce(nullif(trim(gaps[i + 1], ' ,;:|'), ''), 'with') AS relation, {_strip("s")} AS evidence, CAST(NULL AS VARCHAR) AS name FROM r""")
def extract_relations(spark, d):
    return backends.relations_of(_extractions(spark, d))


_LENS = ", ".join(f"({i}, '{lens}', '{role}', '{focus}')" for i, (lens, role, focus) in enumerate(reports.LENSES))


@query(f"SELECT place, lens, 'You are an expert ' || role || '. ' || focus AS system FROM (VALUES {_LENS}) AS l(place, lens, role, focus)")
def lens_matrix(spark, d):
    return reports.lens_prompts(graph.summary_lines(graph.top_edges(_edges(spark, d), _vertices(spark, d), 50))).select("place", "lens", "system")


# what the rule backend answers: counts of lines, the first of them
_REPORTS = f"""{_REL}, t AS ({_TOPV} 50), line AS (SELECT row_number() OVER (ORDER BY weight DESC, source, target) AS rn, source || ' (' || s_type || ') --[' || relation || ']--> ' || target || ' (' || t_type || ')' AS line FROM t),
  said AS (SELECT (SELECT count(*) FROM line) AS n, (SELECT line FROM line WHERE rn = 1) AS first),
  report AS (SELECT place, lens, n || ' relations.' AS summary, coalesce(first, 'N/A') AS key_insight, CASE WHEN n > 40 THEN 'High' WHEN n > 10 THEN 'Medium' ELSE 'Low' END AS risk_level, 'N/A' AS prediction,
    CAST(NULL AS VARCHAR) AS raw_analysis, CAST(NULL AS VARCHAR) AS error FROM (VALUES {_LENS}) AS l(place, lens, role, focus), said)"""
_SECTION = "'--- ' || upper(lens) || ' LENS ---' || chr(10) || 'Risk Level: ' || risk_level || chr(10) || 'Summary: ' || summary || chr(10) || 'Key Insight: ' || key_insight"


def _lens_reports(spark, d):
    return flow.report_of(_vertices(spark, d), _edges(spark, d))


@query(f"WITH {_REPORTS} SELECT * FROM report")
def lens_reports(spark, d):
    return _lens_reports(spark, d)


class Partly(backends.RuleBackend):
    """The rule backend, out of reach for two of the roles."""

    ROLES = ("Political Strategist", "Ethicist")

    def generate(self, system: str, user: str) -> str:
        if any(r in system for r in self.ROLES):
            raise ConnectionError(system)
        return super().generate(system, user)


def _partly(spark, d):
    return reports.lens_reports(graph.summary_lines(graph.top_edges(_edges(spark, d), _vertices(spark, d), 50)), Partly())


_FAILS = "lens IN ('power', 'ethics')"


@query(f"WITH {_REPORTS} SELECT place, lens, CASE WHEN {_FAILS} THEN NULL ELSE summary END AS summary, CASE WHEN {_FAILS} THEN '{backends.FAILED}' END AS raw_analysis, CASE WHEN {_FAILS} THEN 'json_parse_failed' END AS error FROM report")
def lens_failures(spark, d):
    """Lens reports of which two fail: these keep what came back, and the others are as they are."""
    return _partly(spark, d).select("place", "lens", "summary", "raw_analysis", "error")


@query(f"WITH {_REPORTS} SELECT string_agg({_SECTION}, chr(10) ORDER BY place) AS context FROM report WHERE NOT {_FAILS}")
def scenario_context_after_failures(spark, d):
    """The scenario's context leaves out lenses that failed."""
    return reports.scenario_context(_partly(spark, d))


@query(f"WITH {_REPORTS} SELECT string_agg({_SECTION}, chr(10) ORDER BY place) AS context FROM report")
def scenario_context(spark, d):
    return reports.scenario_context(_lens_reports(spark, d))


def _scenario(spark, d):
    return reports.scenario(reports.scenario_context(_lens_reports(spark, d)))


_LEVEL = ", ".join(f"'{k} risk' AS {c}_name, 100 * count(*) FILTER (risk_level = '{k}') // count(*) || '%' AS {c}_probability, count(*) FILTER (risk_level = '{k}') || ' of ' || count(*) || ' analyses say {k}.' AS {c}_description" for c, k in zip("abc", ("High", "Medium", "Low")))


@query(f"WITH {_REPORTS} SELECT min(key_insight) AS topic, 'N/A' AS past, count(*) || ' analyses.' AS now, {_LEVEL} FROM report")
def scenario_report(spark, d):
    """The scenario report on the lens reports, as a dashboard shows it."""
    return reports.report_view(_scenario(spark, d))


@query(f"WITH {_REPORTS} SELECT CAST(row_number() OVER (ORDER BY risk_level) AS INTEGER) AS number, risk_level AS signal FROM (SELECT DISTINCT risk_level FROM report)")
def scenario_signals(spark, d):
    return reports.report_signals(_scenario(spark, d))


@query(f"WITH {_REPORTS} SELECT lens, left(summary, 300) || '...' AS preview FROM report")
def lens_previews(spark, d):
    return reports.report_previews(_lens_reports(spark, d))


# a report for each source, from its documents; an odd number of them leaves fields out
_BY_SOURCE = "SELECT source, count(*) AS n, min(lang) AS low, list_sort(list(DISTINCT lang)) AS langs FROM documents GROUP BY source"
_MISSING = ", ".join(f"'N/A' AS {k}_name, 'N/A' AS {k}_probability, 'No description available' AS {k}_description" for k in "bc")


def _report_documents(spark, d):
    by = _docs(spark, d).groupBy("source").agg(F.count("*").alias("n"), F.min("lang").alias("low"), F.array_sort(F.collect_set("lang")).alias("langs"))
    topic = F.when(F.col("n") % 2 == 0, F.col("source"))
    text = F.to_json(F.struct(topic.alias("event_topic"), F.concat("n", F.lit(" documents")).alias("current_state"), F.struct(F.col("low").alias("name")).alias("scenario_a"), F.col("langs").alias("early_warning_signals")))
    return by.select(F.from_json(text, reports.SCENARIO).alias("r")).select("r.*")


@query(f"SELECT CASE WHEN n % 2 = 0 THEN coalesce(source, 'Unknown Event') ELSE 'Unknown Event' END AS topic, 'N/A' AS past, n || ' documents' AS now, coalesce(low, 'N/A') AS a_name, 'N/A' AS a_probability, 'No description available' AS a_description, {_MISSING} FROM ({_BY_SOURCE})")
def report_view(spark, d):
    """Reports of sources, of which some fields are missing, as a dashboard shows them."""
    return reports.report_view(_report_documents(spark, d))


@query(f"SELECT CAST(unnest(range(1, len(langs) + 1)) AS INTEGER) AS number, unnest(langs) AS signal FROM (SELECT list_filter(langs, lambda x: x IS NOT NULL) AS langs FROM ({_BY_SOURCE}))")
def report_signals(spark, d):
    """Their signals, numbered."""
    return reports.report_signals(_report_documents(spark, d))


@query("""SELECT CASE WHEN count(*) % 2 = 0 THEN coalesce(nullif(source, ''), 'General Overview') ELSE 'General Overview' END AS title, 'No summary available.' AS summary,
  round(100.0 * sum(toxic) / count(toxic), 6) AS negative, round(100.0 - 100.0 * sum(toxic) / count(toxic), 6) AS positive, count(DISTINCT lang) AS n_drivers
  FROM documents LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY 1) USING (doc_id) GROUP BY source""")
def sidebar_view(spark, d):
    """What a sidebar shows of each source: title, summary, sentiment by the labels of its documents, number of drivers."""
    toxic = tables.read(spark, d, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    by = _docs(spark, d).join(toxic, "doc_id", "left").groupBy("source").agg(F.count("*").alias("n"), F.try_divide(F.sum("toxic") * 100.0, F.count("toxic")).alias("negative"), F.collect_set("lang").alias("langs"))
    document = by.select(
        F.struct(F.when(F.col("n") % 2 == 0, F.col("source")).otherwise("").alias("title"), F.lit(None).cast("string").alias("summary"), F.col("langs").alias("key_drivers")).alias("scenario_analysis"),
        F.struct(F.struct("negative", (100.0 - F.col("negative")).alias("positive")).alias("overall_average_sentiment")).alias("metadata"),
    )
    shown = reports.sidebar(document).withColumn("n_drivers", F.size("drivers").cast("long")).drop("drivers")
    return shown.withColumn("negative", _r(F.col("negative"))).withColumn("positive", _r(F.col("positive")))


@query("SELECT event_id, trim(props) AS body FROM events WHERE props IS NOT NULL")
def fence_strip(spark, d):
    """The props of events, wrapped as a chatty model would, and cut out again."""
    rows = tables.read(spark, d, "events").where("props IS NOT NULL")
    answer = F.concat(F.lit("Here it is:\n```json\n"), F.col("props"), F.lit("\n```\nAnything else?"))
    return rows.select("event_id", T.from_brace(F.trim(F.regexp_replace(T.fence_stripped(answer), "^\\s+|\\s+\\z", ""))).alias("body"))


@query("SELECT doc_id, left(text, 300) || '...' AS preview FROM documents")
def text_preview(spark, d):
    return _docs(spark, d).select("doc_id", T.preview(F.col("text"), 300).alias("preview"))


@query(f"WITH {_REL} SELECT source || ' (' || s_type || ') --[' || relation || ']--> ' || target || ' (' || t_type || ')' AS line, count(*) AS n FROM typed GROUP BY 1")
def edge_lines(spark, d):
    line = F.format_string("%s (%s) --[%s]--> %s (%s)", "source", "s_type", "relation", "target", "t_type")
    return _typed(spark, d).groupBy(line.alias("line")).agg(F.count("*").alias("n"))


@query(f"WITH {_REL} SELECT 'completed' AS status, (SELECT count(DISTINCT batch_index) FROM rel0) AS total_batches_processed, count(*) FILTER (target IS NOT NULL) AS total_relations_added, CAST(12.5 AS DOUBLE) AS duration_seconds, round(CAST(12.5 AS DOUBLE) / (SELECT count(DISTINCT batch_index) FROM rel0), 6) AS seconds_per_batch, 'backup' AS backup_file FROM rel0")
def completion_summary(spark, d):
    relations = tables.relations(spark, d)
    return flow.completion(relations.select("batch_index").distinct(), relations, 12.5, "backup").drop("completed_at").withColumn("seconds_per_batch", _r(F.col("seconds_per_batch")))


@query(f"WITH {_DOCS} SELECT doc_id, reason FROM judged")
def stream_gate(spark, d):
    """The gate over a stream of the documents' files, written and read again: equal to the batch."""
    from ..sources.sinks import shared_path
    from ..streaming.gate import gated

    schema = _docs(spark, d).select("doc_id", "text").schema
    live = gated(spark.readStream.schema(schema).parquet(f"{d}/documents.parque[t]"))
    out = shared_path(spark, "stream-gate")
    live.select("doc_id", "reason").writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("doc_id long, reason string").parquet(f"{out}/rows")


# ---- files ----
@query("SELECT doc_id AS post_id, CAST(coalesce(q, 0) AS BIGINT) AS score, md5(coalesce(text, '')) AS text_md5, coalesce(n, 0) AS n_comments FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS q FROM labels GROUP BY 1) l USING (doc_id) LEFT JOIN (SELECT conv_id AS doc_id, count(*) AS n FROM conversations GROUP BY 1) c USING (doc_id)")
def json_lines_source(spark, d):
    """Posts with their comment trees, written as JSON lines, read again and flattened."""
    trees = tree.renest(tables.comments(spark, d))
    posts = tables.posts(spark, d).join(trees, F.col("seq") == F.col("post_seq"), "left")
    sinks.write_text_lines(posts.select(render.post_json(F.col("comments")).alias("value")), path := sinks.shared_path(spark, "posts-json"))
    read = readers.json_posts(spark, path, lines=True)
    n = tree.flatten_comments(read).groupBy("post_seq").agg(F.count("*").alias("n"))
    read = read.join(n, F.col("seq") == F.col("post_seq"), "left")
    return read.select(F.col("post_id").cast("long").alias("post_id"), "score", F.md5(F.coalesce("selftext", F.lit(""))).alias("text_md5"), F.coalesce("n", F.lit(0)).alias("n_comments"))


@query("SELECT row_number() OVER (ORDER BY item_id) - 1 AS seq, CAST(item_id AS VARCHAR) AS post_id, text AS selftext FROM benchmark")
def json_array_source(spark, d):
    """Items written as JSON array, and read again as posts."""
    items = tables.read(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("post_id"), F.col("text").alias("selftext"), "item_id")
    sinks.write_json_array(items, "item_id", path := sinks.shared_path(spark, "posts-array"))
    return readers.json_posts(spark, path).select("seq", "post_id", "selftext")


@query("SELECT row_number() OVER (ORDER BY doc_id) - 1 AS seq, CAST(doc_id AS VARCHAR) AS post_id, source AS author, md5(coalesce(text, '')) AS text_md5 FROM documents")
def json_array_documents(spark, d):
    """All documents as one JSON array over many files, read again by many tasks."""
    posts = tables.posts(spark, d).select("post_id", "author", "selftext")
    sinks.write_json_array(posts, "post_id", path := sinks.shared_path(spark, "documents-array"))
    return readers.json_posts(spark, path).select("seq", "post_id", "author", F.md5(F.coalesce("selftext", F.lit(""))).alias("text_md5"))


# posts and comments with fields that nothing here knows, on both levels
_RAW_TURN = """'{"id":"c' || turn || '","author":' || to_json(role) || ',"meta":{"turn":' || turn || ',"a":[1.5,null,{"b":"' || conv_id || '"}]},"body":' || to_json(body) || ',"upvote_ratio":' || coalesce(CAST(CAST(ratio AS DOUBLE) AS VARCHAR), 'null') || ',"replies":['"""
_RAW_POST = """'{"url":{"lang":' || coalesce(to_json(lang), 'null') || ',"n":[' || length(text) || ',true]},"post_id":"' || doc_id || '","score":' || score || ',"author_account_age_days":' || age || ',"author_comment_karma":' || karma || ',"selftext":' || to_json(text) || ',"comments":[' """
_RAW_SQL = f"""WITH RECURSIVE {_SEQUENCE},
  good AS (SELECT doc_id FROM final WHERE reason IS NULL),
  alive AS (SELECT c.conv_id, c.turn FROM cj c JOIN kept k ON k.seq = c.conv_id AND k.at_ = 1 JOIN good g ON g.doc_id = c.conv_id WHERE c.turn = 0
    UNION ALL SELECT c.conv_id, c.turn FROM cj c JOIN alive a ON c.conv_id = a.conv_id AND c.turn = a.turn + 1 WHERE c.reason IS NULL),
  nested AS (SELECT conv_id, string_agg({_RAW_TURN}, '' ORDER BY turn) || string_agg('],"edited":false}}', '') AS j, count(*) FILTER (turn = 0) AS n FROM turn_ JOIN alive USING (conv_id, turn) GROUP BY 1),
  top AS (SELECT conv_id, count(*) AS n FROM turn_ WHERE turn = 0 GROUP BY 1),
  whole AS (SELECT p.doc_id, {_RAW_POST} || coalesce(j, '') || '],"flair":null,"_filter_stats":{{"original_comments":' || coalesce(t.n, 0) || ',"kept_comments":' || coalesce(a.n, 0) || '}}}}' AS post
    FROM post p JOIN good USING (doc_id) LEFT JOIN nested a ON a.conv_id = p.doc_id LEFT JOIN top t ON t.conv_id = p.doc_id)
  SELECT CAST(doc_id AS VARCHAR) AS post_id, md5(post) AS post_md5, length(post) AS n_chars FROM whole"""


def _raw_posts(spark, d):
    """The driver's tables as a file of JSON lines with further fields, read as posts."""
    turns = tables.comments(spark, d).withColumn("meta", F.struct(F.col("depth").alias("turn")))
    value = lambda c, missing="null": F.coalesce(quoted(F.col(c)), F.lit(missing))
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    depth = F.col("depth").cast("string")
    opening = F.concat(F.lit('{"id":"c'), depth, F.lit('","author":'), value("author"), F.lit(',"meta":{"turn":'), depth, F.lit(',"a":[1.5,null,{"b":"'), "post_id", F.lit('"}]},"body":'), value("body"), F.lit(',"upvote_ratio":'), number("upvote_ratio"), F.lit(',"replies":['))
    trees = tree.renest(turns.withColumn("opening", opening).withColumn("closing", F.lit('],"edited":false}')))
    posts = tables.posts(spark, d).join(trees, F.col("seq") == F.col("post_seq"), "left")
    raw = F.concat(
        F.lit('{"url":{"lang":'), value("title"), F.lit(',"n":['), F.length("selftext").cast("string"), F.lit(',true]},"post_id":"'), F.col("post_id").cast("string"), F.lit('","score":'), number("score"),
        F.lit(',"author_account_age_days":'), number("author_account_age_days"), F.lit(',"author_comment_karma":'), number("author_comment_karma"), F.lit(',"selftext":'), value("selftext"),
        F.lit(',"comments":'), F.coalesce("comments", F.lit("[]")), F.lit(',"flair":null}'),
    )
    ordered = posts.select("seq", raw.alias("value")).repartitionByRange("seq").sortWithinPartitions("seq").select("value")
    sinks.write_text_lines(ordered, path := sinks.shared_path(spark, "posts-raw"))
    return readers.json_posts(spark, path, lines=True)


@query(_RAW_SQL)
def whole_posts(spark, d):
    """Posts that pass the filter, as JSON with all fields that they came with, on the levels of posts and of comments."""
    posts = _raw_posts(spark, d)
    run = flow.filter_run(posts, tree.flatten_comments(posts), EXACT)
    good, kept = run.kept()
    whole = flow.whole_posts(good, kept, run.stats())
    return whole.select("post_id", F.md5("post_json").alias("post_md5"), F.length("post_json").cast("long").alias("n_chars"))


@query(f"WITH {_REL} SELECT e.source, e.target, weight, s.type AS s_type FROM edge e JOIN vertex s ON s.name = e.source")
def graph_files(spark, d):
    """The graph, written and read again."""
    sinks.write_graph(_vertices(spark, d), _edges(spark, d), path := sinks.shared_path(spark, "graph"))
    vertices, edges = readers.graph(spark, path)
    return edges.join(vertices.select(F.col("name").alias("source"), F.col("type").alias("s_type")), "source").select("source", "target", "weight", "s_type")


@query("SELECT event_id // 100 AS batch_index, count(*) AS n, CASE WHEN (event_id // 100) % 2 = 0 THEN 'new' ELSE 'old' END AS version FROM events GROUP BY ALL")
def upsert_files(spark, d):
    """Batches written, then half of them again in a new version."""
    rows = tables.relations(spark, d).groupBy("batch_index").agg(F.count("*").alias("n"))
    sinks.upsert_batches(None, rows.withColumn("version", F.lit("old")), first := sinks.shared_path(spark, "batches"))
    sinks.upsert_batches(spark.read.parquet(first), rows.where("batch_index % 2 = 0").withColumn("version", F.lit("new")), second := sinks.shared_path(spark, "batches"))
    return spark.read.parquet(second)


@query(f"WITH {_REPORTS} SELECT lens, summary, key_insight, risk_level, prediction, raw_analysis, error FROM report")
def lens_report_file(spark, d):
    """The lens reports, written as one JSON object by lens and read again."""
    sinks.write_text(sinks.json_object(_lens_reports(spark, d).drop("place"), "lens"), path := sinks.shared_path(spark, "lenses"))
    return readers.lens_report(spark, path)


@query("SELECT name AS id, name AS label, type, mentions, CASE type WHEN 'Person' THEN '#5B8FF9' WHEN 'Product' THEN '#F6BD16' WHEN 'Organization' THEN '#5AD8A6' WHEN 'Concept' THEN '#E86452' WHEN 'Location' THEN '#6DC8EC' WHEN 'Event' THEN '#945FB9' ELSE '#666' END AS colour, round(30 + (greatest(1, least(10, mentions)) - 1) * 50 / 9.0, 6) AS width FROM (SELECT event_type AS name, CASE event_type WHEN 'view' THEN 'Concept' WHEN 'signup' THEN 'Person' WHEN 'purchase' THEN 'Organization' ELSE 'Event' END AS type, count(*) AS mentions FROM events GROUP BY 1)")
def page_nodes(spark, d):
    """Nodes of the offline page: event types by their counts."""
    e = tables.read(spark, d, "events")
    kind = F.when(F.col("event_type") == "view", "Concept").when(F.col("event_type") == "signup", "Person").when(F.col("event_type") == "purchase", "Organization").otherwise("Event")
    nodes = e.groupBy(F.col("event_type").alias("name"), kind.alias("type")).agg(F.count("*").alias("mentions"))
    return graph.element_nodes(nodes).withColumn("width", _r(F.col("width")))


# ---- tables in buckets, streams with state, table functions ----
@query("SELECT event_id // 100 AS batch_index, count(*) AS n, CASE WHEN (event_id // 100) % 2 = 0 THEN 'new' ELSE 'old' END AS version FROM events GROUP BY ALL")
def upsert_buckets(spark, d):
    """Batches in buckets, of which half come again in a new version."""
    rows = tables.relations(spark, d).groupBy("batch_index").agg(F.count("*").alias("n"))
    path = sinks.shared_path(spark, "batches-in-buckets")
    buckets.create(rows.withColumn("version", F.lit("old")), path, ["batch_index"], 16)
    buckets.upsert(rows.where("batch_index % 2 = 0").withColumn("version", F.lit("new")), path, ["batch_index"], buckets.latest_batches)
    return buckets.read(spark, path).select("batch_index", "n", "version")


@query(f"WITH {_REL} SELECT source, target, relation, evidence, weight FROM edge")
def edges_in_buckets(spark, d):
    """The first half of the relations as a table of edges in buckets, the second half merged into it."""
    rows = _rel(spark, d)
    half, path = rows.agg((F.max("seq") / 2).alias("half")).first().half, sinks.shared_path(spark, "edges-in-buckets")
    buckets.create(graph.edge_merge(rows.where(F.col("seq") <= half)), path, ["source", "target"], 16)
    buckets.upsert(graph.edge_merge(rows.where(F.col("seq") > half)), path, ["source", "target"], graph.merged_edges)
    return buckets.read(spark, path).select("source", "target", "relation", "evidence", "weight")


@query(f"SELECT min(doc_id) AS doc_id FROM (SELECT doc_id, source, lower({_strip('text')}) AS f FROM documents) GROUP BY source, f")
def stream_dedup(spark, d):
    """The deduplicator of exact copies over a stream of the documents, a lane for each source, in four parts; each part is a query that starts again from the checkpoint."""
    from ..streaming import dedup as stream

    docs = _docs(spark, d).select(F.col("doc_id").alias("seq"), F.lit(0).alias("at"), "text", "source")
    ends = docs.agg(F.min("seq").alias("low"), F.max("seq").alias("high")).first()
    out = sinks.shared_path(spark, "stream-dedup")
    key, provider = stream.STORE
    before = spark.conf.get(key)
    spark.conf.set(key, provider)
    try:
        for part in range(4 if ends.low is not None else 0):
            width = (ends.high - ends.low) // 4 + 1
            docs.where(F.floor((F.col("seq") - ends.low) / width) == part).write.mode("append").parquet(f"{out}/in")
            live = stream.walked(spark.readStream.schema(docs.schema).parquet(f"{out}/in"), limits=EXACT, lane="source")
            live.writeStream.format("parquet").outputMode("append").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(key, before)
    found = spark.read.schema("seq long, status int").parquet(f"{out}/rows") if ends.low is not None else spark.createDataFrame([], "seq long, status int")
    return found.where(F.col("status") == dedup.KEPT).select(F.col("seq").alias("doc_id"))


@query(f"""SELECT conv_id AS post_seq, CAST(count(*) AS INTEGER) AS n_comments, string_agg({_PAD} || '[COMMENT]' || chr(10) || {_PAD} || 'Author: ' || role || chr(10) || {_PAD} || 'Score: ' || turn || chr(10) || {_PAD} || 'Body: ' || text, chr(10) ORDER BY turn)
  || chr(10) || string_agg({_PAD} || '[/COMMENT]', chr(10) ORDER BY turn DESC) AS text FROM conversations GROUP BY 1""")
def threads_function(spark, d):
    """Threads as text by the table function."""
    udtfs.register(spark)
    tables.comments(spark, d).createOrReplaceTempView("__threadloom_comments")
    return spark.sql("SELECT * FROM threads(TABLE(SELECT post_seq, path, depth, author, score, body FROM __threadloom_comments), 'post_seq')")
