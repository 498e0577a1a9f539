"""Registration of queries and helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and its SQL twin where SQL can express it."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round float columns, so that summation order cannot show."""
    return df.withColumns({c: exact(c, digits) for c in columns})


def exact(value: Column | str, digits: int) -> Column:
    """Rounded, without a negative zero."""
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value.cast("double"), digits) + F.lit(0.0)
