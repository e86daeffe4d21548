"""DuckDB SQL with the expected results, where SQL can express them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op10_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM n
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id)
"""

# words as the operators take them: runs of characters other than ASCII space
_WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _jaccard(words: int, percent: int) -> str:
    return rf"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, unnest(CASE WHEN len(w) >= {words}
      THEN list_distinct(list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' ')))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY 1, 2, na.n, nb.n HAVING 100 * count(*) >= {percent} * (na.n + nb.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)"""


ORACLES["op1_jaccard_join"] = _jaccard(4, 85) + """
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""

ORACLES["op4_substring_dedup"] = rf"""
WITH w AS MATERIALIZED (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
p AS MATERIALIZED (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS nth FROM p),
c AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM r WHERE nth > 1),
k AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
j AS (
  SELECT k.doc_id, string_agg(k.word, ' ' ORDER BY k.i) AS kept FROM k LEFT JOIN c ON c.doc_id = k.doc_id AND c.i = k.i
  WHERE c.i IS NULL GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n FROM c GROUP BY 1)
SELECT w.doc_id, len(w) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(j.kept, '')) AS kept_sha256
FROM w LEFT JOIN j ON j.doc_id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
"""

_BLANK = r"[\x20\x09-\x0D]*"
ORACLES["op2_line_dedup"] = rf"""
WITH a AS MATERIALIZED (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
e AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS nr FROM a),
f AS MATERIALIZED (
  SELECT doc_id, line, nr, row_number() OVER (PARTITION BY doc_id ORDER BY nr) AS i
  FROM e WHERE NOT regexp_full_match(line, '{_BLANK}')),
p AS (SELECT x.doc_id, x.i, x.line AS g, y.line AS h FROM f x JOIN f y ON y.doc_id = x.doc_id AND y.i = x.i + 1),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g, h ORDER BY doc_id, i) AS nth FROM p),
c AS MATERIALIZED (SELECT DISTINCT doc_id, unnest([i, i + 1]) AS i FROM r WHERE nth > 1),
gone AS MATERIALIZED (SELECT f.doc_id, f.nr FROM c JOIN f ON f.doc_id = c.doc_id AND f.i = c.i),
k AS (
  SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.nr) AS kept FROM e LEFT JOIN gone ON gone.doc_id = e.doc_id AND gone.nr = e.nr
  WHERE gone.nr IS NULL GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n_lines FROM f GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY 1)
SELECT a.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM a LEFT JOIN k ON k.doc_id = a.doc_id LEFT JOIN n ON n.doc_id = a.doc_id LEFT JOIN m ON m.doc_id = a.doc_id
"""

ORACLES["op6_chat_format"] = """
WITH t AS (
  SELECT conv_id // 2 AS pair_id, conv_id % 2 = 0 AS chosen, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
g AS (
  SELECT pair_id, turn, list(role || chr(0) || text ORDER BY role, text) FILTER (chosen) AS a,
         list(role || chr(0) || text ORDER BY role, text) FILTER (NOT chosen) AS b
  FROM t GROUP BY 1, 2),
p AS (
  SELECT pair_id, min(turn) FILTER (a IS DISTINCT FROM b) AS border,
         count(a) > 0 AND count(b) > 0 AS has_both
  FROM g GROUP BY 1),
c AS (SELECT t.*, has_both, has_both AND (border IS NULL OR turn < border) AS common FROM t JOIN p USING (pair_id))
SELECT pair_id, CASE WHEN common THEN 'prompt' WHEN chosen THEN 'chosen' ELSE 'rejected' END AS side, turn, role,
       '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered, NOT common AND role = 'assistant' AS learn, has_both
FROM c WHERE chosen OR NOT common
"""

ORACLES["op13_hard_negatives"] = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INT AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 5
"""
