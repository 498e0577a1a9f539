"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def one_row(df: DataFrame, **aggregates: Column) -> dict[str, Column]:
    """Whole-table aggregates, computed now and returned as typed literals.

    Only the one result row reaches the driver. As literals the statistics fold
    into the expressions that use them and need no join.
    """
    result = df.agg(*[expr.alias(name) for name, expr in aggregates.items()])
    row = result.first()
    return {name: F.lit(row[name]).cast(dtype) for name, dtype in result.dtypes}


def banded(value: Column, edges: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose edge ``value`` exceeds; NULL stays NULL."""
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in edges:
        chain = chain.when(value > edge, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def key_text(columns: Sequence[str | Column]) -> Column:
    """The columns as one text key, different for different values.

    Backslashes, and bars where there are several columns, are escaped in values, so no
    value can pass for the bar between two columns or for ``\\N``, which stands for NULL.
    """
    named = [F.col(c) if isinstance(c, str) else c for c in columns]
    escaped = [F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\")) for c in named]
    if len(escaped) > 1:
        escaped = [F.replace(c, F.lit("|"), F.lit("\\|")) for c in escaped]
    return F.concat_ws("|", *[F.coalesce(c, F.lit("\\N")) for c in escaped])


def md5_number(text: Column, digits: int) -> Column:
    """The first hexadecimal ``digits`` (at most 15) of the MD5 of ``text`` as a number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("bigint")
