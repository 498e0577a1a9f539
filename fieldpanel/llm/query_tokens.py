"""Registered queries of the tokenizer operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldpanel.llm import bpe, unigram_count
from fieldpanel.llm.common import documents
from fieldpanel.llm.registry import query


@query("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again."""
    return bpe.tokenize(documents(spark, sf_dir))


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text under the unigram vocabulary."""
    return unigram_count.count_tokens(documents(spark, sf_dir))
