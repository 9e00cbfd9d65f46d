"""SQL that says the same as a query, for a check by another engine."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = f"""
WITH doc AS (SELECT doc_id, coalesce({WORDS.format("text")}, []) AS w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS.format("text")} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
gram AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM gram),
place AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size WHERE len(w) >= n),
hit AS (SELECT DISTINCT p.doc_id, p.i, p.n, g.item FROM place p JOIN gram g ON g.n = p.n AND g.gram = array_to_string(p.w[p.i:p.i + p.n - 1], ' ')),
word AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc d LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: A line stands for itself, or for its tokens with fields (those with a digit) left open if three others are there; a long line also for each half of its positions. Lines of one word
#: count from ten documents on, unless they are long and in a script without spaces.
OP4 = r"""
WITH line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS at_ FROM documents WHERE text IS NOT NULL),
token AS (SELECT *, list_filter(string_split_regex(lower(line), '[\t-\r\x1c-\x1f\x{85}\p{Z}]+'), lambda x: x <> '') AS raw FROM line),
general AS (SELECT *, list_transform(raw, lambda x: CASE WHEN regexp_matches(x, '\p{Nd}') THEN '<*>' ELSE x END) AS g FROM token WHERE len(raw) >= 1),
counted AS (SELECT doc_id, at_, len(raw) AS n, len(list_filter(g, lambda x: x <> '<*>')) AS literal, CASE WHEN len(list_filter(g, lambda x: x <> '<*>')) >= 3 THEN g ELSE raw END AS t,
  len(raw) = 1 AND length(regexp_replace(raw[1], '[^\x{0e00}-\x{0fff}\x{1000}-\x{109f}\x{1780}-\x{17ff}\x{3040}-\x{30ff}\x{3400}-\x{9fff}\x{f900}-\x{faff}\x{20000}-\x{3ffff}]', '', 'g')) < 8 AS word FROM general),
part AS (
  SELECT doc_id, at_, n, t, CASE WHEN word THEN 'word' ELSE 'all' END AS kind, t AS p FROM counted
  UNION ALL SELECT doc_id, at_, n, t, 'front', t[1:(n + 1) // 2] FROM counted WHERE n >= 12 AND literal >= 5
  UNION ALL SELECT doc_id, at_, n, t, 'back', t[(n + 1) // 2 + 1:n] FROM counted WHERE n >= 12 AND literal >= 5
  UNION ALL SELECT doc_id, at_, n, t, 'even', t[1:n:2] FROM counted WHERE n >= 12 AND literal >= 5
  UNION ALL SELECT doc_id, at_, n, t, 'odd', t[2:n:2] FROM counted WHERE n >= 12 AND literal >= 5),
keyed AS (SELECT doc_id, at_, kind, n || chr(10) || t[1] || chr(10) || coalesce(t[2], '') || chr(10) || kind || chr(10) || array_to_string(p, ' ') AS key FROM part WHERE kind IN ('all', 'word') OR len(list_filter(p, lambda x: x <> '<*>')) >= 5),
recurring AS (SELECT key, min(doc_id) AS first FROM keyed GROUP BY key, kind HAVING count(DISTINCT doc_id) >= CASE WHEN kind = 'word' THEN 10 ELSE 2 END),
lost AS (SELECT DISTINCT k.doc_id, k.at_ FROM keyed k JOIN recurring r ON r.key = k.key WHERE r.first <> k.doc_id),
kept AS (SELECT l.doc_id, count(*) AS n_lines, count(x.at_) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY l.at_) FILTER (x.at_ IS NULL), '') AS clean
  FROM line l LEFT JOIN lost x ON x.doc_id = l.doc_id AND x.at_ = l.at_ GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, CAST(length(clean) AS BIGINT) AS n_chars_kept, sha256(clean) AS clean_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""

#: All pairs by an inverted index, components by reachability: exact, where the operator goes by signatures.
OP9 = rf"""
WITH RECURSIVE doc AS (SELECT doc_id, list_filter(string_split_regex({LOWER.format("coalesce(text, '')")}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingle AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) ELSE [array_to_string(w, ' ')] END) AS g FROM doc WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
way AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, w.b FROM reach r JOIN way w ON w.a = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM least LEFT JOIN size USING (doc_id)
"""

#: All strings of 200 bytes by a digest; texts as hexadecimal digits, so that a byte is two characters.
OP11 = """
WITH t AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
place AS (SELECT k, i, md5_number(substr(x, 2 * i + 1, 400)) AS h FROM (SELECT k, x, unnest(range(length(x) // 2 - 199)) AS i FROM t WHERE length(x) >= 400)),
again AS (SELECT h FROM place GROUP BY h HAVING count(*) > 1),
hit AS (SELECT k, i, lag(i) OVER (PARTITION BY k ORDER BY i) AS p FROM place SEMI JOIN again USING (h)),
run AS (SELECT k, i, count(*) FILTER (p IS NULL OR i > p + 200) OVER (PARTITION BY k ORDER BY i) AS g FROM hit),
span AS (SELECT k, min(i) AS s, max(i) + 200 AS e FROM run GROUP BY k, g),
gap AS (SELECT k, s, e, lag(e, 1, 0) OVER (PARTITION BY k ORDER BY s) AS b FROM span),
cut AS (SELECT k, count(*) AS n, sum(e - s) AS removed, string_agg(substr(x, 2 * b + 1, 2 * (s - b)), '' ORDER BY s) || substr(any_value(x), 2 * max(e) + 1) AS kept FROM gap JOIN t USING (k) GROUP BY k)
SELECT doc_id, length(x) // 2 AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256 FROM t LEFT JOIN cut USING (k)
"""

#: crc32 bit by bit over the distinct features; the rest as the operator says.
OP12 = f"""
WITH word AS (SELECT row_number() OVER () AS k, doc_id, coalesce({WORDS.format("text")}, []) AS w FROM documents),
target_word AS (SELECT coalesce({WORDS.format("text")}, []) AS w FROM benchmark),
doc_feature AS (SELECT k, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM word),
target_feature AS (SELECT unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM target_word),
distinct_feature AS MATERIALIZED (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM doc_feature UNION SELECT f FROM target_feature)),
bucket AS MATERIALIZED (SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(length(x) // 2), lambda i: [CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, b: xor(xor(c, b) >> 1, CAST(3988292384 AS BIGINT) * (xor(c, b) & 1))), CAST(4294967295 AS BIGINT)) % 10000 AS b FROM distinct_feature),
s AS (SELECT b, count(*) AS s FROM doc_feature JOIN bucket USING (f) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM target_feature JOIN bucket USING (f) GROUP BY b),
sums AS (SELECT (SELECT count(*) FROM doc_feature) AS all_s, (SELECT count(*) FROM target_feature) AS all_t),
gain AS (SELECT b, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (all_s + 10000) / ((s + 1.0::DOUBLE) * (all_t + 10000)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (b), sums),
summed AS (SELECT k, CAST(sum(gain) AS BIGINT) AS g, count(*) AS n FROM doc_feature JOIN bucket USING (f) JOIN gain USING (b) GROUP BY k),
noised AS (SELECT k, doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce((g - ((g % n) + n) % n) // n, 0) AS weight,
  CAST('0x' || left(sha256('7:' || doc_id), 8) AS BIGINT) AS h FROM word LEFT JOIN summed USING (k)),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM noised),
ranked AS (SELECT k, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score, CASE WHEN r <= 25 * n // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (k)
"""

SQL = {"op3_decontamination": OP3, "op4_line_templates": OP4, "op9_minhash_near_dedup": OP9, "op11_repeats": OP11, "op12_importance_sample": OP12}
