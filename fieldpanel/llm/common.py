"""Helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldpanel.staging import stage, staging_path

__all__ = ["documents", "fresh", "let", "shuffle_width", "stage", "staging_path", "text_of", "WORD"]

# A word: a longest run of characters other than the six ASCII white-space ones.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """Column names that clash with none of ``taken`` (case-insensitively, as Spark does)."""
    used = {t.lower() for t in taken}
    return [n if n.lower() not in used else f"{n}_{uuid.uuid4().hex[:8]}" for n in names]


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, the unit for splitting hot groups."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), lambda v: use(v)), 1)
