"""SQL (DuckDB) of the training-data queries that SQL can express, written independently of the operators."""

from __future__ import annotations

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT lang, unnest(string_split_regex({_LOW}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
),
sized AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces),
grams AS MATERIALIZED (
  SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase, count(*)::BIGINT AS f
  FROM places, (VALUES (1), (2), (3)) AS sizes(k) WHERE i + k - 1 <= len(ws) GROUP BY ALL
),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM grams WHERE k > 1 AND f >= 10),
cut_places AS (
  SELECT lang, k, phrase, a, ws, unnest(range(1, k)) AS cut FROM candidates
),
cut_parts AS MATERIALIZED (
  SELECT lang, k, phrase, a, cut, array_to_string(ws[1 : cut], ' ') AS head, array_to_string(ws[cut + 1 :], ' ') AS tail FROM cut_places
),
with_head AS MATERIALIZED (
  SELECT c.*, g.f AS l FROM cut_parts c JOIN grams g ON g.lang = c.lang AND g.phrase = c.head
),
cuts AS MATERIALIZED (
  SELECT c.lang, c.k, c.phrase, c.a, c.cut, c.l, g.f AS r, (1000000::HUGEINT * c.a * c.a // (c.l::HUGEINT * g.f))::BIGINT AS score
  FROM with_head c JOIN grams g ON g.lang = c.lang AND g.phrase = c.tail
),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (
  SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM candidates WHERE k = 3
),
inner_ones AS (SELECT DISTINCT s.lang, s.phrase FROM scored s JOIN parts t ON t.lang = s.lang AND t.phrase = s.phrase WHERE 100 * t.a >= 50 * s.a),
left_over AS (SELECT * FROM scored ANTI JOIN inner_ones USING (lang, phrase)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM left_over)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score FROM ranked JOIN sized USING (lang) WHERE rank <= 2000
"""

OP12 = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same,
         list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * r.v[i]))::BIGINT AS s
  FROM sound a, sound r WHERE a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, s AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, vec_id) <= 5
),
negatives AS (
  SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, vec_id)::INTEGER AS rank,
         vec_id AS negative_id, positive_score, s AS negative_score
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * s AND 100 * s <= 100 * positive_score
)
SELECT * FROM negatives WHERE rank <= 5
"""

_WORDS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP13 = f"""
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, {_WORDS} AS ws FROM documents),
items AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
starts AS (
  SELECT item_id, ws, least(len(ws), 10) AS size, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS i
  FROM items WHERE len(ws) > 0
),
windows AS (SELECT DISTINCT item_id, size, array_to_string(ws[i : i + size - 1], ' ') AS gram FROM starts),
places AS (SELECT row_no, ws, unnest(range(1, len(ws) + 1)) AS i FROM docs),
found AS (
  SELECT p.row_no, p.i, w.item_id, w.size
  FROM (SELECT row_no, i, size, array_to_string(ws[i : i + size - 1], ' ') AS gram
        FROM places, (SELECT DISTINCT size FROM windows) WHERE i + size - 1 <= len(ws)) p
  JOIN windows w ON w.size = p.size AND w.gram = p.gram
),
hits AS (
  SELECT row_no, count(DISTINCT pos)::BIGINT AS n_hit
  FROM (SELECT row_no, unnest(range(i, i + size)) AS pos FROM found) GROUP BY row_no
),
named AS (
  SELECT row_no, count(*)::BIGINT AS n_items, string_agg(id, ',' ORDER BY encode(id)) AS ids
  FROM (SELECT DISTINCT row_no, item_id::VARCHAR AS id FROM found) GROUP BY row_no
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (row_no) LEFT JOIN named USING (row_no)
"""

ORACLE = {"op11_collocations": OP11, "op12_negatives": OP12, "op13_positions": OP13}
