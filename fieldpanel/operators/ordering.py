"""Global order without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldpanel.operators.joins import fits
from fieldpanel.staging import stage

# Up to this many rows, one sorted task is cheaper than a range partitioning.
MAX_SINGLE_SORT_ROWS = 100_000


def running_total(
    df: DataFrame,
    order: Sequence[Column],
    weight: Column,
    out: str,
    by: Sequence[str] = (),
    max_single_sort_rows: int = MAX_SINGLE_SORT_ROWS,
) -> DataFrame:
    """Add the inclusive running sum of ``weight`` along ``order`` within ``by``.

    ``order`` must be unique within ``by`` and ``by`` must name few groups. Large
    inputs are range-partitioned; each range sums its own rows and starts from
    the total of the ranges before it, so no group has to fit in one task.
    """
    by = list(by)
    if fits(df, max_single_sort_rows):
        whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
        frame = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(weight).over(frame))

    ranges = stage(
        df.repartitionByRange(*[F.col(c) for c in by], *order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_weight", weight),
        "ranges",
    )
    # one row per range and group: bounded by the number of shuffle partitions
    before = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = before.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranges.groupBy(*by, "_range")
        .agg(F.sum("_weight").alias("_total"))
        .withColumn("_start", F.coalesce(F.sum("_total").over(before), F.lit(0)))
        .drop("_total")
    )
    inside = Window.partitionBy(*by, "_range").orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranges.withColumn("_run", F.sum("_weight").over(inside))
        .join(F.broadcast(starts), [*by, "_range"])
        .withColumn(out, F.col("_run") + F.col("_start"))
        .drop("_run", "_start", "_range", "_weight")
    )


def positions(
    df: DataFrame,
    order: Sequence[Column],
    out: str,
    max_single_sort_rows: int = MAX_SINGLE_SORT_ROWS,
) -> DataFrame:
    """Number the rows 0, 1, 2, ... along a unique ``order``."""
    numbered = running_total(
        df, order, F.lit(1).cast("bigint"), out, max_single_sort_rows=max_single_sort_rows
    )
    return numbered.withColumn(out, F.col(out) - 1)
