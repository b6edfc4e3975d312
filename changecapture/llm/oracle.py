"""Expected rows of the queries that SQL can express (DuckDB)."""

from __future__ import annotations

OP5 = r"""
WITH split AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents
), lines AS (
  SELECT doc_id, i - 1 AS line, trim(ls[i]) AS content
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM split)
  WHERE trim(ls[i]) <> ''
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS pos,
    len(regexp_split_to_array(content, '\s+')) AS words
  FROM lines
), seqs AS (
  SELECT doc_id, list(content ORDER BY pos) AS cs, list(words ORDER BY pos) AS ws,
    list(line ORDER BY pos) AS nos
  FROM numbered GROUP BY doc_id
), windows AS (
  SELECT doc_id, pos, len, list_slice(cs, pos, pos + len - 1) AS run
  FROM (SELECT *, unnest(range(1, len(cs) + 1)) AS pos FROM seqs), (SELECT unnest(range(1, 11)) AS len)
  WHERE pos + len - 1 <= len(cs) AND list_sum(list_slice(ws, pos, pos + len - 1)) >= 10
), later AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS copy FROM windows
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + len)) AS pos FROM later WHERE copy > 1
), removed AS (
  SELECT doc_id, list(line ORDER BY line) AS nos FROM gone JOIN numbered USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, coalesce(len(nos), 0)::INT AS n_removed,
  coalesce(array_to_string(nos, ','), '') AS removed_lines,
  sha256(CASE WHEN nos IS NULL THEN text ELSE array_to_string(list_transform(list_filter(
    range(1, len(ls) + 1), lambda i: NOT list_contains(nos, i - 1)), lambda i: ls[i]), chr(10)) END) AS text_sha256
FROM split LEFT JOIN removed USING (doc_id)
"""

OP8 = """
WITH texts AS (
  SELECT doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
  count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(t) AS text_sha256
FROM texts
"""

OP9 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS ws FROM documents
), grams AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) <= 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS gs
  FROM words WHERE len(ws) > 0
), single AS (
  SELECT doc_id, len(gs) AS n, unnest(gs) AS g FROM grams
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM single a JOIN single b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a
), class AS (
  SELECT a AS doc_id, min(b) AS class_id, count(*) AS class_size FROM reach GROUP BY a
)
SELECT doc_id, class_id, class_size, count(b) AS n_links
FROM class LEFT JOIN pairs ON doc_id = a GROUP BY ALL
"""

OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), lines AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), grams AS (
  SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM lines), (SELECT unnest(range(1, 6)) AS m)
  WHERE i + m - 1 <= len(ws) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::HUGEINT AS n FROM grams WHERE m = 1 GROUP BY lang
), candidates AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM grams WHERE m > 1 AND f >= 100
), parts AS (
  SELECT DISTINCT lang, a, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, m + 1)) AS i FROM candidates), (SELECT unnest(range(2, 5)) AS k)
  WHERE k < m AND i + k - 1 <= m
), cuts AS (
  SELECT c.*, unnest(range(1, m)) AS k FROM candidates c
  WHERE NOT EXISTS (SELECT 1 FROM parts p WHERE p.lang = c.lang AND p.phrase = c.phrase AND 100 * p.a >= 100 * c.a)
), scores AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, c.k, n,
    ((1000 * c.a::HUGEINT * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(ws[1:k], ' ')
  JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(ws[k + 1:], ' ')
), least AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least
)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score FROM ranked WHERE rank <= 2000
"""

ORACLE = {
    "op11_collocations": OP11,
    "op9_jaccard_join": OP9,
    "op5_line_dedup": OP5,
    "op8_exact_dedup": OP8,
}
