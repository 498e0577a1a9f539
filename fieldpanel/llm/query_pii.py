"""Registered query of the personal data operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldpanel.llm import pii
from fieldpanel.llm.common import documents
from fieldpanel.llm.registry import query


@query("op4_pii")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its base spans and the terms that disclose them."""
    found = pii.find(documents(spark, sf_dir))

    def joined(spans: str):
        parts = F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        )
        return F.array_join(parts, ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS[:4]],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
