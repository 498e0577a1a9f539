"""Registered query of the clustering operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldpanel.llm import centroid_clustering as clustering
from fieldpanel.llm.common import documents
from fieldpanel.llm.registry import query

CLUSTERS, ROUNDS, WIDTH = 40, 5, 64


def _round(number: int) -> str:
    """The assignment to the centroids c{number} and, from it, the centroids after it."""
    return f"""
d{number} AS MATERIALIZED (
  SELECT r, c, CAST(sum((v.x - m.x) * (v.x - m.x)) AS BIGINT) AS d
  FROM parts v JOIN c{number} m USING (axis) GROUP BY r, c),
a{number} AS MATERIALIZED (
  SELECT r, c, d FROM d{number}
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1),
c{number + 1} AS MATERIALIZED (
  SELECT c, axis, coalesce(m.x, o.x) AS x
  FROM c{number} o LEFT JOIN (
    SELECT c, axis, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x
    FROM (SELECT a.c, axis, CAST(sum(v.x) AS BIGINT) AS s, count(*) AS n
          FROM a{number} a JOIN parts v USING (r) GROUP BY a.c, axis)) m USING (c, axis))"""


CLUSTER_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {WIDTH}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {WIDTH}),
parts AS MATERIALIZED (
  SELECT r, unnest(v) AS x, unnest(range({WIDTH})) AS axis FROM kept),
seeds AS (
  SELECT v, row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c FROM kept
  QUALIFY c < {CLUSTERS}),
c0 AS MATERIALIZED (
  SELECT c, unnest(v) AS x, unnest(range({WIDTH})) AS axis FROM seeds),
{",".join(_round(i) for i in range(ROUNDS + 1))},
named AS (
  SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY axis)) AS digest
  FROM c{ROUNDS} GROUP BY c)
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
FROM a{ROUNDS} a JOIN kept USING (r) JOIN named USING (c)"""


@query("op11_centroid_clustering", CLUSTER_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector with its cluster after five rounds."""
    found = clustering.cluster_vectors(
        documents(spark, sf_dir, "embeddings"), width=WIDTH, clusters=CLUSTERS, rounds=ROUNDS
    )
    return clustering.described(found).drop("measured")
