"""The same results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

import string

_LOWER = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"

_NEAR = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 2 THEN [w]
    ELSE list_transform(range(1, len(w)), lambda k: list_slice(w, k, k + 1)) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id != b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM common
  JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)),
reach AS (
  SELECT doc_id, doc_id AS c FROM documents
  UNION
  SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.doc_id)
SELECT d.doc_id, coalesce(any_value(sizes.n), 0)::BIGINT AS n_shingles,
       min(reach.c) AS component_id, d.doc_id = min(reach.c) AS kept
FROM documents d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id)
GROUP BY d.doc_id
"""

_PASSAGES = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 10 THEN [w]
    ELSE list_transform(range(1, len(w) - 8), lambda k: list_slice(w, k, k + 9)) END) AS s
  FROM item),
lengths AS (SELECT DISTINCT len(s) AS n FROM item_windows),
places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM doc, lengths),
found AS (
  SELECT doc_id, k, n, item_id FROM places
  JOIN item_windows ON item_windows.s = list_slice(w, k, k + n - 1)),
hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (
    SELECT doc_id, unnest(range(k, k + n)) AS word FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (
    SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_VECTORS = """
WITH RECURSIVE valid AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(
      embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b
  ON a.vec_id != b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id, vec_id AS c FROM embeddings
  UNION
  SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.vec_id),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(any_value(counted.n), 0)::BIGINT AS n_links,
       min(reach.c) AS component_id, v.vec_id = min(reach.c) AS kept
FROM embeddings v JOIN reach USING (vec_id) LEFT JOIN counted USING (vec_id)
GROUP BY v.vec_id
"""

_NEGATIVES = """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor, b.vec_id AS id, a.label = b.label AS same,
         coalesce(list_sum(list_transform(range(1, len(a.e) + 1),
                                          lambda k: a.e[k] * b.e[k])), 0)::BIGINT AS score
  FROM valid a JOIN valid b ON a.vec_id % 100 = 0 AND a.vec_id != b.vec_id
    AND len(a.e) = len(b.e)),
positives AS (
  SELECT anchor, id, score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
SELECT p.anchor AS anchor_id, p.id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.id
                          ORDER BY n.score DESC, n.id)::INTEGER AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor = p.anchor AND NOT n.same
  AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""

_PHRASES = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
         translate(text, {_LOWER}) AS text FROM documents),
pieces AS (
  SELECT lang, row, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM texts),
words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM starts, range(1, 6) lengths(k) WHERE i + k - 1 <= len(w)),
counts AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*)::HUGEINT AS f
  FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, n, cut,
         1000 * c.f * n // (l.f * r.f) AS score
  FROM counts c JOIN range(1, 5) places(cut) ON cut < c.k
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:cut], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:], ' ')
  JOIN sizes ON sizes.lang = c.lang
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1),
inner_phrases AS (
  SELECT DISTINCT lang, f, array_to_string(w[s:s + m - 1], ' ') AS phrase
  FROM counts, range(2, 5) lengths(m), range(1, 5) starts(s)
  WHERE m < k AND s + m - 1 <= k),
kept AS (
  SELECT * FROM cuts ANTI JOIN inner_phrases i
  ON i.lang = cuts.lang AND i.phrase = cuts.phrase AND i.f >= cuts.a)
SELECT lang, row_number() OVER (
         PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""

ORACLES = {
    "op3_minhash": _NEAR,
    "op5_decontamination": _PASSAGES,
    "op9_embeddings": _VECTORS,
    "op11_phrases": _PHRASES,
    "op13_negatives": _NEGATIVES,
}
