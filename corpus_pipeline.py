"""From raw documents to a tokenised training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
in the shared folder and read again as the next stage's documents. All but the last return
the columns of ``documents``. Tables that are empty, nulls, repeated rows and extra columns
follow the defined results of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldpanel.llm import bpe, exact_dedup, mixture, quality, simhash
from fieldpanel.llm.common import stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return exact_dedup.deduplicate_frame(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of fingerprints linked within three bits."""
    return simhash.keep_one(docs)


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixture.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, decoded again as a check."""
    return bpe.tokenize(docs, keep_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixture", mixture_stage),
    ("tokens", token_stage),
]

# Logistic regression, near copies and BPE are beyond SQL; tests/llm checks them by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
