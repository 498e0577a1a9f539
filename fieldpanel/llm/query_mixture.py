"""Registered query of the mixture operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldpanel.llm import mixture
from fieldpanel.llm.common import documents
from fieldpanel.llm.registry import query

# The water level is the last one that the next source to be capped does not reach.
# Sampling keys use the same digest bits; prefix sums run over whole sources.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CASE WHEN 1.0 - length(regexp_replace(coalesce(text, ''), '[\p{L} ]+', '', 'g'))
              / greatest(length(coalesce(text, '')), 1)::DOUBLE > 0.001
              THEN 1.0 - length(regexp_replace(coalesce(text, ''), '[\p{L} ]+', '', 'g'))
              / greatest(length(coalesce(text, '')), 1)::DOUBLE ELSE 0.001 END AS w,
         (CAST('0x' || substr(md5('7:' || doc_id), 1, 13) AS BIGINT) + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u
  FROM documents),
keyed AS (SELECT doc_id, source, size, -ln(u) / w AS k FROM sized),
sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM keyed GROUP BY source),
capped AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
         (SELECT sum(source_size) FROM sums) * 1.5::DOUBLE AS total FROM sums),
levels AS (
  SELECT *,
         coalesce(sum(cap) OVER below, 0)::DOUBLE AS cap_below,
         sum(w) OVER above AS w_above
  FROM capped
  WINDOW below AS (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         above AS (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (
  SELECT (total - cap_below) / w_above AS level FROM levels
  WHERE (total - cap_below) / w_above <= cap / w ORDER BY cap / w, source LIMIT 1),
aimed AS (
  SELECT source, source_size, least(cap, (SELECT level FROM level) * w) AS target FROM capped),
placed AS (
  SELECT k.doc_id, k.source, k.size, a.source_size, a.target,
         coalesce(floor(a.target / nullif(a.source_size, 0)), 0) AS epochs,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.k, k.doc_id, k.size
                           ROWS UNBOUNDED PRECEDING) - k.size AS first
  FROM keyed k JOIN aimed a ON k.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, source, size, source_size, target,
       CAST(epochs + CASE WHEN first + size / 2.0 <= target - epochs * source_size
                          THEN 1 ELSE 0 END AS BIGINT) AS copies,
       CAST(size * (epochs + CASE WHEN first + size / 2.0 <= target - epochs * source_size
                                  THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed"""


@query("op3_mixture", MIX_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the words that a mix of 150 % of the corpus takes of each."""
    return mixture.mix(documents(spark, sf_dir))
