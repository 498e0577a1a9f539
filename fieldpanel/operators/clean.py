"""Row filters and the cleaning of one measure table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from fieldpanel.functions.columns import one_row


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows in which every named column has a value. NaN is a value."""
    return df.filter(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def dedup_rows(df: DataFrame) -> DataFrame:
    """One copy of each distinct row; copies collapse before the shuffle."""
    return df.distinct()


def clean_measure(
    df: DataFrame,
    keys: Mapping[str, str],
    measures: Mapping[str, str],
    extra: Sequence[str] = (),
    safe: bool = False,
) -> DataFrame:
    """Null-drop, cast, rename and select one measure table.

    ``keys`` maps the place and year columns and ``measures`` the value columns to
    their new names. Columns in ``extra`` are carried along and may be NULL. The
    second key is the year. With ``safe``, rows whose value is not a number go.
    """
    place, year = keys
    cast = {v: F.col(v).try_cast("double") if safe else F.col(v).cast("double") for v in measures}
    out = drop_nulls(df, [*keys, *measures]).select(
        F.col(place).alias(keys[place]),
        F.col(year).cast("int").alias(keys[year]),
        *extra,
        *[cast[v].alias(name) for v, name in measures.items()],
    )
    return drop_nulls(out, list(measures.values())) if safe else out


def clean_rainfall(df: DataFrame) -> DataFrame:
    return clean_measure(
        df,
        {"Area": "Country", "Year": "Year"},
        {"average_rain_fall_mm_per_year": "average_rain_fall_mm_per_year"},
        safe=True,
    )


def clean_pesticides(df: DataFrame) -> DataFrame:
    return clean_measure(
        df, {"Area": "Country", "Year": "Year"}, {"Value": "Pesticides_Value"}
    )


def clean_yield(df: DataFrame) -> DataFrame:
    cleaned = clean_measure(
        df, {"Area": "Country", "Year": "Year"}, {"Value": "Yield_Value"}, extra=["Item", "Unit"]
    )
    return cleaned.select("Country", "Year", "Item", "Yield_Value", "Unit")


def clean_temp(df: DataFrame) -> DataFrame:
    return clean_measure(
        df, {"country": "Country", "year": "Year"}, {"avg_temp": "avg_temp"}
    )


def zscore_filter(df: DataFrame, columns: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Keep rows within ``limit`` sample standard deviations on all ``columns``.

    Statistics are those of the whole input. A NULL drops its row; a column
    without spread has no outliers. ``df`` is read twice, so stage it when it is
    expensive to compute.
    """
    stats = one_row(
        df,
        **{f"mean_{i}": F.mean(c) for i, c in enumerate(columns)},
        **{f"std_{i}": F.stddev(c) for i, c in enumerate(columns)},
    )
    keep = []
    for i, c in enumerate(columns):
        std = stats[f"std_{i}"]
        score = F.abs(F.try_divide(F.col(c) - stats[f"mean_{i}"], std))
        flat = std.isNull() | (std == 0)
        keep.append(F.col(c).isNotNull() & (flat | (score <= limit)))
    return df.filter(reduce(and_, keep))
