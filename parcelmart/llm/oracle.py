"""DuckDB SQL of the operators it can express."""

from parcelmart.llm.merkle_sql import merkle_sql

OP10_MIX_SOURCES = r"""
WITH docs AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS hash_order,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
    FROM documents
), sources AS (
    SELECT source, sum(size) AS source_size FROM docs GROUP BY source
), turns AS (
    SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM sources
), weighted AS (
    SELECT source, source_size,
           CASE turn WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS weight,
           CASE turn WHEN 0 THEN 0.5 WHEN 1 THEN 0.0 ELSE -0.5 END::DOUBLE AS tilt
    FROM turns
), limits AS (
    SELECT *, source_size * 2.0::DOUBLE / weight AS most FROM weighted
), levels AS (
    SELECT *,
           (sum(source_size) OVER () * 1.5::DOUBLE
            - coalesce(sum(source_size * 2.0::DOUBLE) OVER (ORDER BY most, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY most, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM limits
), goals AS (
    SELECT source, source_size, tilt,
           least((SELECT arg_min(level, most) FROM levels WHERE level <= most) * weight, source_size * 2.0::DOUBLE) AS target
    FROM levels
), placed AS (
    SELECT doc_id, size, source_size, target, tilt,
           CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
           coalesce(sum(size) OVER (PARTITION BY docs.source ORDER BY hash_order, doc_id, size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM docs JOIN goals ON docs.source IS NOT DISTINCT FROM goals.source
), counted AS (
    SELECT *, CAST(whole AS INTEGER)
              + CASE WHEN target - whole * source_size > 0 AND start + size / 2.0::DOUBLE <= target - whole * source_size THEN 1 ELSE 0 END AS copies,
           least((start + size / 2.0::DOUBLE) / target, 1.0::DOUBLE) AS part
    FROM placed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * copies AS BIGINT) AS taken, copies,
       CASE WHEN copies = 0 THEN NULL WHEN tilt = 0 THEN part
            ELSE ((1 + tilt) - sqrt((1 + tilt) * (1 + tilt) - 4 * tilt * part)) / (2 * tilt) END AS first_position
FROM counted
"""

OP13_HARD_NEGATIVES = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
           CAST(list_inner_product(a.v, o.v) AS BIGINT) AS score
    FROM vectors a JOIN vectors o ON a.vec_id <> o.vec_id
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
       CAST(row_number() OVER found AS INTEGER) AS rank
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same
 AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW found AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER found <= 10
"""

ORACLE: dict[str, str] = {
    "op10_mix_sources": OP10_MIX_SOURCES,
    "op11_merkle_manifest": merkle_sql(),
    "op13_hard_negatives": OP13_HARD_NEGATIVES,
}
