"""Registered queries of the deduplication operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldpanel.llm import exact_dedup, simhash, substring_dedup
from fieldpanel.llm.common import documents
from fieldpanel.llm.registry import query

EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


@query("op10_exact_dedup", EXACT_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy that stays, from a stream over the table's files."""
    return exact_dedup.deduplicate(spark, f"{sf_dir}/documents.parquet").drop("at")


@query("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the component of linked fingerprints."""
    found = simhash.near_duplicates(documents(spark, sf_dir))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op8_substring_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what repeated 100-byte strings take from it."""
    return substring_dedup.remove_repeats(documents(spark, sf_dir))
