"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tripflow.llm.line_dedup import MIN_SITES
from tripflow.llm.spelling import MIN_COUNT, MIN_LENGTH, NOISE, RATIO

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"

OP6 = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, text IS NULL AS no_text, source, row_number() OVER () AS rn FROM documents),
lines AS (
  SELECT rn, doc_id, t, source, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM docs),
cut AS (SELECT *, regexp_replace(line, '^{_SPACE}+|{_SPACE}+$', '', 'g') AS c FROM lines),
spread AS (
  SELECT c, min({{'no_id': doc_id IS NULL, 'id': doc_id, 't': t, 'pos': pos}}) AS first FROM cut
  WHERE c <> ''
  GROUP BY c HAVING count(DISTINCT coalesce('=' || source, '')) >= {MIN_SITES}),
judged AS (
  SELECT cut.*, spread.c IS NOT NULL AND {{'no_id': doc_id IS NULL, 'id': doc_id, 't': t, 'pos': pos}} <> first AS gone
  FROM cut LEFT JOIN spread USING (c))
SELECT any_value(docs.doc_id) AS doc_id, CASE WHEN docs.t = '' THEN 0 ELSE count(*) END AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       CASE WHEN no_text THEN NULL ELSE coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') END AS text
FROM docs JOIN judged USING (rn) GROUP BY docs.rn, docs.t, docs.no_text
"""

OP7 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP11 = rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}'), '{_WORD}') AS w FROM documents),
sets AS (
  SELECT rn, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS s FROM docs),
classes AS (SELECT row_number() OVER () AS c, s, len(s) AS n, min(doc_id) AS low FROM sets WHERE len(s) > 0 GROUP BY s),
shingles AS (SELECT c, n, unnest(s) AS x FROM classes),
links AS (
  SELECT a.c AS a, b.c AS b FROM shingles a JOIN shingles b USING (x) WHERE a.c <> b.c
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT c, c AS r FROM classes UNION SELECT reach.c, links.b FROM reach JOIN links ON reach.r = links.a),
lows AS (SELECT reach.c, min(o.low) AS component_id FROM reach JOIN classes o ON o.c = reach.r GROUP BY reach.c),
judged AS (
  SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, CASE WHEN len(sets.s) = 0 THEN doc_id ELSE component_id END AS component_id
  FROM sets LEFT JOIN classes USING (s) LEFT JOIN lows USING (c))
SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM judged
"""

OP13 = rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([CAST(n AS BIGINT)] || CAST(range(8) AS BIGINT[]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t
  FROM range(256) r(n)),
runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_CAPITALS}', '{_SMALL}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  GROUP BY doc_id, run),
bytes AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM runs),
hashed AS (
  SELECT run, k, xor(4294967295, list_reduce([4294967295] || list_transform(range(1, len(h), 2), lambda i: CAST(('0x' || substr(h, i, 2)) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc
  FROM bytes, crc_table),
noisy AS (
  SELECT CASE WHEN crc % {NOISE} = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, k FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM noisy WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(k) >= {MIN_COUNT}),
cuts AS (SELECT word, n, p, substr(word, 1, p) || substr(word, p + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n FROM cuts a JOIN cuts b USING (p, rest) WHERE a.word <> b.word
  UNION SELECT cuts.word, words.word, words.n FROM cuts JOIN words ON words.word = rest
  UNION SELECT words.word, cuts.word, cuts.n FROM cuts JOIN words ON words.word = rest),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS top, max(n) AS top_n FROM pairs GROUP BY word),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= {RATIO} * n THEN top END AS form, CASE WHEN top_n >= {RATIO} * n THEN top_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
follow AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT follow.word, forms.form FROM follow JOIN forms ON forms.word = follow.at WHERE forms.form IS NOT NULL),
roots AS (SELECT follow.word, follow.at AS root FROM follow JOIN forms ON forms.word = follow.at WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""

ORACLE_SQL: dict[str, str] = {"op6_line_dedup": OP6, "op7_exact_dedup": OP7, "op11_minhash_near_dedup": OP11, "op13_spelling_variants": OP13}
