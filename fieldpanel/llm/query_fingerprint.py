"""Registered query of the document fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldpanel.llm import multiset_hash as mh
from fieldpanel.llm.common import documents, text_of
from fieldpanel.llm.neighbour_rows import with_next
from fieldpanel.llm.registry import query


@query("op9_multiset_hash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and the likeness of both."""
    docs = documents(spark, sf_dir).select("doc_id", text_of().alias("text"))
    pairs = with_next(
        docs, "doc_id", {"text": "next_text", "vec": "next_vec"}, F.xxhash64("text"),
        {"vec": mh.vector(F.col("text"))},
    )
    half = F.floor(F.length("text") / 2).cast("int")
    kept = F.substring("text", F.lit(1), F.length("text") - half)
    edited = F.concat(kept, F.substring("next_text", F.lit(1), half))
    pairs = pairs.withColumn("edited", edited).select(
        "doc_id", "vec", "next_vec",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        mh.vector(F.col("edited")).alias("edited_vec"),
    )
    return pairs.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        mh.fingerprint(F.col("vec")).alias("fingerprint"),
        mh.fingerprint(F.col("edited_vec")).alias("edited_fingerprint"),
        mh.likeness(F.col("vec"), F.col("edited_vec")).alias("near_edited"),
        mh.likeness(F.col("vec"), F.col("next_vec")).alias("near_next"),
    )
