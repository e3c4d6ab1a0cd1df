"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op8_exact_top_k"] = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.rid AS query_rid, q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.vec, c.vec) AS BIGINT) AS score
  FROM v q JOIN v c ON q.rid <> c.rid WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_rid ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

ORACLES["op13_hard_negatives"] = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.rid AS anchor_rid, a.vec_id AS anchor_id, c.rid AS rid, c.vec_id AS vec_id, a.label = c.label AS same,
         CAST(list_inner_product(a.vec, c.vec) AS BIGINT) AS score
  FROM v a JOIN v c ON a.rid <> c.rid WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_rid ORDER BY score DESC, vec_id, rid) <= 5
), pairs AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_rid, p.rid ORDER BY n.score DESC, n.vec_id, n.rid) AS INTEGER) AS rank
  FROM positives p JOIN scored n ON n.anchor_rid = p.anchor_rid AND NOT n.same
   AND n.score * 100 BETWEEN p.score * 30 AND p.score * 90
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM pairs WHERE rank <= 10
"""
