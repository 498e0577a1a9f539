"""Registered query of the line deduplication operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldpanel.llm import line_dedup
from fieldpanel.llm.common import documents
from fieldpanel.llm.registry import query

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_SQL = f"""
WITH rows_ AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
lines AS (
  SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM rows_),
keyed AS (
  SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
marked AS (
  SELECT k.*, length(k) >= 10 AND f.docs >= 2 AND doc_id IS DISTINCT FROM f.first AS lost
  FROM keyed k JOIN (SELECT k, min(doc_id) AS first,
                            count(DISTINCT doc_id) + max(CAST(doc_id IS NULL AS INT)) AS docs
                     FROM keyed GROUP BY k) f USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
       CAST(count(*) FILTER (lost) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY r"""


@query("op12_line_dedup", LINE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the lines it loses to documents of smaller id."""
    return line_dedup.deduplicate(documents(spark, sf_dir))
