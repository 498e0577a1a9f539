"""Every row next to its successor in a global order, without sorting in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldpanel.llm.common import shuffle_width


def with_next(
    rows: DataFrame,
    key: str,
    values: dict[str, str],
    tie: Column,
    made: dict[str, Column] | None = None,
) -> DataFrame:
    """Add the successor's columns ``values`` (column: new name) by ascending long ``key``.

    The last row's successor is the first one. Rows are dealt to ranges between sampled
    quantiles of the key; each range also gets the first rows of the next range, so that
    only ranges are sorted. ``tie`` orders rows of one key; null keys come last. The
    quantiles are as many numbers as there are shuffle partitions, whatever the input.
    ``made`` are further columns, computed once per row before ``values`` are taken.
    """
    n = shuffle_width(rows.sparkSession)
    shares = [i / n for i in range(1, n)] or [0.5]
    found = rows.agg(F.percentile_approx(key, shares, max(10_000, 20 * n)).alias("q")).first()
    bounds = sorted(set(found["q"] or []))
    k = F.col(key)
    if bounds:
        above = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < k))
        bucket = F.when(k.isNull(), F.lit(len(bounds) + 1)).otherwise(above)
    else:
        bucket = F.lit(0)
    dealt = rows.withColumn("_bucket", bucket.cast("int"))
    # one row per range (so never more than partitions + 1): its smallest key, the range before
    whole = Window.partitionBy(F.lit(0)).orderBy("_at")
    firsts = dealt.groupBy(F.col("_bucket").alias("_at")).agg(F.min(key).alias("_first"))
    last = F.max("_at").over(Window.partitionBy(F.lit(0)))
    firsts = firsts.select(
        "_at", "_first", F.coalesce(F.lag("_at").over(whole), last).alias("_before")
    )
    same = (F.col("_bucket") == F.col("_at")) & k.eqNullSafe(F.col("_first"))
    halo = dealt.join(F.broadcast(firsts), same).withColumn("_bucket", F.col("_before"))
    halo = halo.select(*dealt.columns, F.lit(1).alias("_halo"))
    both = dealt.withColumn("_halo", F.lit(0)).unionAll(halo).withColumns(made or {})
    order = Window.partitionBy("_bucket").orderBy("_halo", k.asc_nulls_last(), tie)
    following = {new: F.lead(old).over(order) for old, new in values.items()}
    return both.withColumns(following).where(F.col("_halo") == 0).drop("_halo", "_bucket")
