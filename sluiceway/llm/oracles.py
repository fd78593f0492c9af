"""SQL for those queries of this subpackage that SQL can express."""

from __future__ import annotations

_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM pairs
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE n <= 10
"""

_NEGATIVES = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(a.e) = len(c.e)
), near AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM pairs WHERE same
), hard AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, c.vec_id AS negative_id, p.score AS positive_score, c.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY c.score DESC, c.vec_id) AS n
  FROM near p JOIN pairs c ON p.n <= 5 AND c.anchor_id = p.anchor_id AND NOT c.same AND 80 * p.score <= 100 * c.score AND c.score <= p.score
)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM hard WHERE n <= 5
"""

# Base32 of 20 bytes: four groups of 40 bits, of which each gives eight letters.
_WARC = """
WITH p AS (
  SELECT page_id, coalesce(encode(html), ''::BLOB) AS payload FROM pages
), h AS (
  SELECT page_id, octet_length(payload) AS n, sha1(payload) AS hex FROM p
), g AS (
  SELECT *, list_transform([0, 1, 2, 3], lambda k: CAST('0x' || substr(hex, 10 * k + 1, 10) AS BIGINT)) AS parts FROM h
), d AS (
  SELECT page_id, n, list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((parts[1 + i // 8] >> (35 - 5 * (i % 8))) & 31) AS BIGINT), 1)), 'string_agg', '') AS digest
  FROM g
), t AS (
  SELECT *, max(page_id) OVER (PARTITION BY digest) AS top FROM d
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM t
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_CONTAMINATION = f"""
WITH i AS (
  SELECT item_id, {_WORDS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[p : p + least(len(w), 13) - 1], ' ') AS said
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM i WHERE len(w) > 0)
), d AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), sizes AS (
  SELECT DISTINCT size FROM windows
), grams AS (
  SELECT doc_id, p, size, array_to_string(w[p : p + size - 1], ' ') AS said
  FROM (SELECT d.*, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes WHERE len(w) >= size)
), found AS (
  SELECT doc_id, p, size, item_id FROM grams JOIN windows USING (size, said)
), words AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(p, p + size)) AS place FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM found GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Blocks are met in order and from the start again, so what a source takes is whole rounds and a beginning of its order.
_MIX = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), 'null|' || coalesce(text, ''))), 1, 15) AS BIGINT) AS place
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY source
), r AS (
  SELECT source, n, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, (SELECT CAST(sum(n) AS BIGINT) FROM s) AS total FROM s
), t AS (
  SELECT *, CAST(coalesce(sum(3 * n) OVER (ORDER BY 3.0 * n / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS capped,
    CAST(sum(w) OVER (ORDER BY 3.0 * n / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS weights
  FROM r
), water AS (
  SELECT capped, weights FROM t WHERE (total - capped) * w <= 3 * n * weights ORDER BY 3.0 * n / w, source LIMIT 1
), goals AS (
  SELECT source, n, CASE WHEN 3 * n * water.weights < (total - water.capped) * w THEN CAST(3 * n AS DOUBLE)
    ELSE CAST(total - water.capped AS DOUBLE) * w / water.weights END AS target
  FROM r, water
), p AS (
  SELECT doc_id, size, n, target, CAST(floor(target) AS BIGINT) AS goal,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
  FROM d JOIN goals ON d.source IS NOT DISTINCT FROM goals.source
)
SELECT doc_id, size, n AS source_size, target,
  CAST(CASE WHEN n = 0 THEN 0 ELSE goal // n * size + greatest(0, least(begins + size, goal % n) - begins) END AS BIGINT) AS taken
FROM p
"""

# crc32 of a decimal number, bit by bit; the trees level by level, every eight neighbours at a time.
_CRC = """list_reduce(list_prepend(4294967295, list_transform(range(1, length(CAST({0} AS VARCHAR)) + 1), lambda p: CAST(ord(substr(CAST({0} AS VARCHAR), p, 1)) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), lambda a, i: xor(a >> 1, 3988292384 * (a & 1))))"""
_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR) END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(f) for f in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"
_LOW_TEXT = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_LEAF.format('text')} AS leaf,
    CASE WHEN xor({_CRC.format('doc_id')}, 4294967295) % 3 = 0 THEN {_LEAF.format(_LOW_TEXT)} END AS given
  FROM documents
), ranked AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) OVER (PARTITION BY lang) AS size,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM leaves
), nodes AS (
  SELECT 0 AS k, g, i, leaf AS digest, size AS n FROM ranked
  UNION ALL
  SELECT k + 1, g, i // 8, sha256(string_agg(digest, '' ORDER BY i)), (max(n) + 7) // 8 FROM nodes WHERE n > 1 GROUP BY k, g, i // 8
), subroots AS (
  SELECT g, k AS height, digest FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS k, g AS i, digest, (SELECT count(*) FROM subroots) AS n FROM subroots
  UNION ALL
  SELECT k + 1, i // 8, sha256(string_agg(digest, '' ORDER BY i)), (max(n) + 7) // 8 FROM upper WHERE n > 1 GROUP BY k, i // 8
), steps AS (
  SELECT r.g, r.i, s.k, coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i < r.i // CAST(8 ** s.k AS BIGINT)), '') AS l,
    coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i > r.i // CAST(8 ** s.k AS BIGINT)), '') AS r
  FROM ranked r JOIN nodes s ON s.g = r.g AND s.n > 1 AND s.i // 8 = r.i // CAST(8 ** (s.k + 1) AS BIGINT) GROUP BY r.g, r.i, s.k
  UNION ALL
  SELECT r.g, r.i, t.height + s.k, coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i < r.g // CAST(8 ** s.k AS BIGINT)), ''),
    coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i > r.g // CAST(8 ** s.k AS BIGINT)), '')
  FROM ranked r JOIN subroots t ON t.g = r.g JOIN upper s ON s.n > 1 AND s.i // 8 = r.g // CAST(8 ** (s.k + 1) AS BIGINT) GROUP BY r.g, r.i, t.height, s.k
), proofs AS (
  SELECT g, i, sha256(string_agg(l || r, '' ORDER BY k)) AS proof FROM steps GROUP BY g, i
), folds AS (
  SELECT g, i, 0 AS k, coalesce(given, leaf) AS digest FROM ranked
  UNION ALL
  SELECT f.g, f.i, f.k + 1, sha256(s.l || f.digest || s.r) FROM folds f JOIN steps s ON s.g = f.g AND s.i = f.i AND s.k = f.k
), folded AS (
  SELECT g, i, arg_max(digest, k) AS digest FROM folds GROUP BY g, i
), root AS (
  SELECT digest FROM upper WHERE n = 1
)
SELECT doc_id, leaf, t.digest AS subroot, root.digest AS root, coalesce(proof, sha256('')) AS proof_sha256, f.digest AS folded_root,
  f.digest = root.digest AS verified
FROM ranked r JOIN subroots t USING (g) JOIN folded f USING (g, i) LEFT JOIN proofs p USING (g, i), root
"""

ORACLES: dict[str, str] = {
    "op5_va_top_k": _TOP_K,
    "op7_source_schedule": _MIX,
    "op8_warc_records": _WARC,
    "op9_winnowed_contamination": _CONTAMINATION,
    "op11_l2ap_negatives": _NEGATIVES,
    "op13_interval_manifest": _MERKLE,
}
