"""Equi-joins that stay safe when the right side is large or a key is hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import DataFrame, functions as F, types as T

from fieldpanel.staging import stage

# A side is broadcast only after measuring no more bytes of values than this.
MAX_BROADCAST_BYTES = 64 << 20

# A key is hot when it holds more than this share of the left rows, so there are
# never more than 1 / HOT_SHARE hot keys.
HOT_SHARE = 0.001


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no further than that."""
    return df.select(F.lit(1).alias("one")).limit(max_rows + 1).count() <= max_rows


def value_bytes(df: DataFrame) -> int:
    """Bytes of all values as a task holds them: 16 each, and the length of texts and nests."""

    def width(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 16
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(c.cast("string")), F.lit(0)) * 4 + 16
        return F.lit(16)

    row = reduce(add, [width(f) for f in df.schema.fields], F.lit(0))
    return df.agg(F.sum(row.cast("bigint")).alias("n")).first()["n"] or 0


def attach(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join ``right`` to the rows of ``left``.

    The right side is computed once, written and measured. If it is small it is
    broadcast, so ``left`` does not move at all and is never the side that is
    copied. Otherwise both sides shuffle and the hot keys of ``left`` are salted.
    """
    right = stage(right, "attached")
    if value_bytes(right) <= max_broadcast_bytes:
        return left.join(F.broadcast(right), list(on), how)
    return salted_join(left, right, on, how)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Shuffle join with each key that is hot on either side spread over a grid of tasks.

    Rows per key are counted from the key columns alone, on both sides. Without a hot key this
    is a plain join. A hot key gets a fair number of salts per side: its left rows are dealt
    over the rows of a grid and repeated along its columns, its right rows the other way
    round, so every pair meets in exactly one cell and no cell holds more than a share of
    either side. All other rows join in one cell. Left rows with a NULL key never match; in a
    left join they are spread as well, so that they do not meet in one task.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join supports inner and left joins, not {how!r}")
    on = list(on)
    added = [c for c in right.columns if c not in on]
    columns = [*on, *[c for c in left.columns if c not in on], *added]
    if how == "inner":
        left = left.dropna(subset=on)
    right = right.dropna(subset=on)
    (hot_left, n_left), (hot_right, n_right) = (
        _hot_keys(side, on, hot_share) for side in (left, right)
    )
    if hot_left.isEmpty() and hot_right.isEmpty():
        return left.join(right, on, how).select(*columns)

    # fixed row order, so the salts are repeatable
    left, right = stage(left, "salted"), stage(right, "salted")
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grid = hot_left.withColumnRenamed("_rows", "_l").join(
        hot_right.withColumnRenamed("_rows", "_r"), on, "full"
    )
    grid = stage(  # at most 2 / hot_share keys
        grid.select(
            *on,
            # one salt on a side where the key is not hot, or not at all
            F.coalesce(F.ceil(F.col("_l") * width / F.lit(max(n_left, 1))), F.lit(1)).alias("_down"),
            F.coalesce(
                F.ceil(F.col("_r") * width / F.lit(max(n_right, 1))), F.lit(1)
            ).alias("_across"),
        ),
        "hot_keys",
    )
    null_key = reduce(or_, [F.col(c).isNull() for c in on])
    down = F.when(null_key, F.lit(width)).otherwise(F.coalesce("_down", F.lit(1)))
    across = F.coalesce("_across", F.lit(1))

    def every(number):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), number - 1))

    dealt_left = (
        left.withColumn("_row", F.monotonically_increasing_id())
        .join(F.broadcast(grid), on, "left")
        .withColumn("_row", F.pmod("_row", down))
        .withColumn("_column", every(across))
        .withColumn("_repeated", across > 1)
        .drop("_down", "_across")
    )
    dealt_right = (
        right.withColumn("_column", F.monotonically_increasing_id())
        .join(F.broadcast(grid), on, "left")
        .withColumn("_column", F.pmod("_column", across))
        .withColumn("_row", every(F.coalesce("_down", F.lit(1))))
        .withColumn("_met", F.lit(True))
        .drop("_down", "_across")
    )
    joined = dealt_left.join(dealt_right, [*on, "_row", "_column"], how)
    if how == "left":
        # a key repeated along columns has right rows, which each of its left rows meets in
        # some column; the columns without one add nothing
        joined = joined.where(F.col("_met").isNotNull() | ~F.col("_repeated"))
    return joined.select(*columns)


def _hot_keys(df: DataFrame, on: list[str], hot_share: float) -> tuple[DataFrame, int]:
    """(keys, _rows) of at most 1 / hot_share hot keys, and the number of all rows."""
    counts = stage(df.groupBy(*on).agg(F.count("*").alias("_rows")), "key_rows")
    rows = counts.agg(F.sum("_rows").alias("n")).first()["n"] or 0
    hot = counts.dropna(subset=on).filter(F.col("_rows") > max(rows * hot_share, 1))
    return hot, rows
