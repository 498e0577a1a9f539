"""Place-name standardization and key comparison across datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldpanel.functions.country_aliases import COUNTRY_ALIASES
from fieldpanel.staging import stage

WORD_BITS = 62  # datasets per mask; more datasets take several masks


def alias_table(spark: SparkSession, aliases: Mapping[str, str]) -> DataFrame:
    """The alias rules as a small local relation (alias, canonical)."""
    return spark.createDataFrame(
        pa.table({"_alias": list(aliases.keys()), "_canonical": list(aliases.values())})
    )


def standardize_keys(
    df: DataFrame,
    column: str = "Country",
    aliases: Mapping[str, str] = COUNTRY_ALIASES,
    out: str | None = None,
) -> DataFrame:
    """Lower-case and trim ``column``, then replace known aliases, in one pass.

    The rules are a fixed list, so they are broadcast; the rows do not move.
    """
    names = F.broadcast(alias_table(df.sparkSession, aliases))
    plain = F.lower(F.trim(F.col(column)))
    joined = df.join(names, plain == F.col("_alias"), "left")
    joined = joined.withColumn(out or column, F.coalesce(F.col("_canonical"), plain))
    return joined.drop("_alias", "_canonical")


def key_presence(tables: Mapping[str, DataFrame], column: str) -> DataFrame:
    """Every key once, with bit masks and the count of the datasets that hold it.

    Each dataset adds one bit to its keys. The bits merge on the map side, so one
    shuffle of distinct keys answers every question about shared keys. ``datasets_mask``
    has the first ``WORD_BITS`` datasets, ``datasets_mask_1`` and so on those after them.
    """
    masks = _masks(len(tables))
    tagged = [
        df.select(
            F.col(column).alias("key"),
            F.lit(i // WORD_BITS).alias("word"),
            F.lit(1 << i % WORD_BITS).cast("bigint").alias("bit"),
        )
        for i, df in enumerate(tables.values())
    ]
    merged = (
        reduce(DataFrame.unionByName, tagged)
        .filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(
            *[
                F.coalesce(F.bit_or(F.when(F.col("word") == w, F.col("bit"))), F.lit(0)).alias(mask)
                for w, mask in enumerate(masks)
            ]
        )
    )
    return merged.withColumn("n_datasets", _n_datasets(masks))


def _masks(n_datasets: int) -> list[str]:
    words = max(-(-n_datasets // WORD_BITS), 1)
    return ["datasets_mask", *[f"datasets_mask_{w}" for w in range(1, words)]]


def _n_datasets(masks: Sequence[str]) -> Column:
    return reduce(add, [F.bit_count(mask) for mask in masks])


def keys_in_at_least(tables: Mapping[str, DataFrame], column: str, m: int) -> DataFrame:
    """Keys that at least ``m`` datasets hold: (key, n_datasets)."""
    shared = key_presence(tables, column).filter(F.col("n_datasets") >= m)
    return shared.select("key", "n_datasets")


def common_keys(tables: Mapping[str, DataFrame], column: str) -> DataFrame:
    """Keys that all datasets hold: (key)."""
    return keys_in_at_least(tables, column, len(tables)).select("key")


def key_counts(tables: Mapping[str, DataFrame], column: str) -> DataFrame:
    """Distinct keys per dataset, and the keys in all of them under ``(common)``."""
    return _count_bits(key_presence(tables, column), list(tables))


def _count_bits(presence: DataFrame, names: Sequence[str]) -> DataFrame:
    masks = _masks(len(names))
    counts = [
        F.struct(
            F.lit(name).alias("dataset"),
            F.count_if(F.getbit(masks[i // WORD_BITS], F.lit(i % WORD_BITS)) == 1).alias("n_keys"),
        )
        for i, name in enumerate(names)
    ]
    common = F.struct(
        F.lit("(common)").alias("dataset"),
        F.count_if(_n_datasets(masks) == len(names)).alias("n_keys"),
    )
    return presence.agg(F.array(*counts, common).alias("counts")).select(F.inline("counts"))


def standardize_audit(
    tables: Mapping[str, DataFrame],
    column: str = "Country",
    aliases: Mapping[str, str] = COUNTRY_ALIASES,
) -> DataFrame:
    """Key counts before and after standardization: (dataset, before, after).

    The standard name depends on the key alone, so the tables are read once for
    their distinct keys and only those are standardized.
    """
    found = stage(key_presence(tables, column), "keys")
    merged = (
        standardize_keys(found, "key", aliases)
        .groupBy("key")
        .agg(*[F.bit_or(mask).alias(mask) for mask in _masks(len(tables))])
    )
    before = _count_bits(found, list(tables)).withColumnRenamed("n_keys", "before")
    after = _count_bits(merged, list(tables)).withColumnRenamed("n_keys", "after")
    # both sides hold one row per dataset name
    return before.join(F.broadcast(after), "dataset")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and their difference, in one job."""
    copies = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("row_count"),
        F.count("*").alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"),
    )


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    """The distinct values in order, sorted by range partitions."""
    return df.select(column).distinct().orderBy(column)
