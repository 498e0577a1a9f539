"""Readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    **options: object,
) -> DataFrame:
    """CSV with a header line. Declare ``schema`` to spare the inference pass."""
    reader = spark.read.options(header=True, **options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_table(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: object,
) -> DataFrame:
    """A table in any format Spark reads."""
    if format == "csv":
        return read_csv(spark, path, schema, **options)
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
