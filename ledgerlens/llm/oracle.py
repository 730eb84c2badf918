"""DuckDB SQL for the operators' queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWERED = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

OP1 = rf"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
r(doc_id, to_id) AS (
  SELECT doc_id, doc_id FROM n
  UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.to_id),
k AS (SELECT doc_id, min(to_id) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(k.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""

OP3 = rf"""
WITH w AS MATERIALIZED (
  SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
  FROM documents),
g AS MATERIALIZED (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
t AS (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING count(*) > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n
      FROM g JOIN t USING (doc_id, g) CROSS JOIN range(5) AS o(k) GROUP BY doc_id),
m AS MATERIALIZED (
  SELECT w.doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(l) AS n_lines
  FROM w LEFT JOIN c USING (doc_id)),
f AS MATERIALIZED (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    word_chars < n_words * 2 OR word_chars > n_words * 20 AS odd FROM m),
v AS MATERIALIZED (
  SELECT *,
    base_failed OR odd OR n_symbols * 10 > n_words OR n_dup_lines * 10 > n_lines * 3
      OR n_repeat_words * 100 > n_words * 20 AS failed,
    base_failed OR odd OR n_symbols * 20 > n_words OR n_dup_lines * 20 > n_lines * 3
      OR n_repeat_words * 200 > n_words * 20 AS strict_failed FROM f),
h AS (SELECT source, count(*) AS n, count(*) FILTER (failed) AS k FROM v GROUP BY source),
z AS (SELECT avg(k / n) AS m, var_samp(k / n) AS v, sum(n) AS n FROM h),
p AS (SELECT m, least(CASE WHEN v > 0 THEN greatest(m * (1 - m) / v - 1, 0) ELSE n END, n) AS strength FROM z),
q AS (SELECT source, (k + m * strength) / (n + strength) > 0.5 AS host_rejected FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed, host_rejected,
  NOT CASE WHEN host_rejected THEN strict_failed ELSE failed END AS kept
FROM v JOIN q ON v.source IS NOT DISTINCT FROM q.source
"""

OP4 = r"""
WITH u AS (
  SELECT page_id,
    translate(CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) ELSE '' END,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (SELECT u.*, (SELECT max_by(struct_pack(r := h || p, v := v), length(h || p)) FROM r
        WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best FROM u)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, best.r AS rule, coalesce(best.v, 'allow') AS verdict
FROM m
"""

# the checksum of bytes b, byte by byte: its table is built from the polynomial, and every byte
# takes one step; Latin-1 letters are one or two bytes of UTF-8. form_n is a double, as a whole number with
# nulls comes out of Spark by way of pandas
_CRC_STEP = "xor(c >> 8, t.t[CAST(xor(c & 255, b) + 1 AS BIGINT)])"
OP11 = rf"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
t AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
r AS MATERIALIZED (
  SELECT doc_id, word, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[a-zÀ-ÿ]+')) AS word FROM documents)
  WHERE length(word) >= 6 GROUP BY ALL),
h AS MATERIALIZED (
  SELECT word, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
    string_split(doc_id || ':' || word, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)]
      ELSE [CAST(195 AS BIGINT), unicode(x) - 64] END))), lambda c, b: {_CRC_STEP}), 4294967295) AS h
  FROM r, t),
w AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN word[:h % length(word)] || word[h % length(word) + 2:] ELSE word END AS word, n FROM h)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
d AS MATERIALIZED (SELECT word, i, word[:i - 1] || word[i + 1:] AS v FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS MATERIALIZED (
  SELECT a.word AS a, b.word AS b FROM d a JOIN d b ON a.i = b.i AND a.v = b.v AND a.word <> b.word
  UNION SELECT w.word, d.word FROM d JOIN w ON d.v = w.word
  UNION SELECT d.word, w.word FROM d JOIN w ON d.v = w.word),
k AS (SELECT a AS word, count(*) AS n_near, arg_min(b, (-n, b)) AS best, max(n) AS best_n FROM p JOIN w ON w.word = b GROUP BY a),
f AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * w.n THEN best END AS form,
    CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n
  FROM w LEFT JOIN k USING (word)),
s(word, root) AS (SELECT word, word FROM f UNION ALL SELECT s.word, f.form FROM s JOIN f ON f.word = s.root WHERE f.form IS NOT NULL),
e AS (SELECT s.word, s.root FROM s JOIN f ON f.word = s.root WHERE f.form IS NULL)
SELECT f.word, f.n, f.n_near, f.form, CAST(f.form_n AS DOUBLE) AS form_n, e.root FROM f JOIN e USING (word)
"""

#: op8 has no SQL: its exact form is a cross join, tested in tests/llm.
SQL: dict[str, str] = {"op1_ngram_join": OP1, "op3_quality_rules": OP3, "op4_url_filter": OP4, "op11_spelling_variants": OP11}
