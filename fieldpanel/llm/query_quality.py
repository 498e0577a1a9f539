"""Registered query of the quality classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldpanel.llm import quality
from fieldpanel.llm.common import documents
from fieldpanel.llm.registry import query


@query("op1_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its evidence, its site's posteriors and the decision."""
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    return quality.score(docs, labels, columns=["doc_id"]).select("doc_id", "quality.*")
