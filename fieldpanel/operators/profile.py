"""Whole-table profiles. Each is one aggregation pass, returned in long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fieldpanel.staging import reread


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def column(name: str) -> Column:
    """A column by its exact name, whatever characters that has."""
    return F.col(f"`{name}`")


def per_column(
    df: DataFrame,
    columns: Sequence[str],
    metrics: Mapping[str, object],
    label: str = "column",
) -> DataFrame:
    """One aggregation over ``df``, one output row per column.

    ``metrics`` maps an output name to a function from column name to aggregate.
    """
    rows = F.array(
        *[
            F.struct(F.lit(c).alias(label), *[make(c).alias(m) for m, make in metrics.items()])
            for c in columns
        ]
    )
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per named table."""
    tagged = [df.select(F.lit(name).alias("dataset")) for name, df in tables.items()]
    union = reduce(DataFrame.unionByName, tagged)
    return union.groupBy("dataset").agg(F.count("*").alias("row_count"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL and NaN counts per column, kept apart: (column, nulls, nans)."""
    floating = {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }

    def nans(c: str) -> Column:
        return F.count_if(F.isnan(column(c))) if c in floating else F.lit(0).cast("bigint")

    metrics = {"nulls": lambda c: F.count_if(column(c).isNull()), "nans": nans}
    return per_column(df, columns or df.columns, metrics)


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing values: (column, missing, missing_pct)."""
    metrics = {
        "missing": lambda c: F.count_if(column(c).isNull()),
        "missing_pct": lambda c: F.try_divide(
            F.count_if(column(c).isNull()) * F.lit(100.0), F.count("*")
        ),
    }
    return per_column(df, columns or df.columns, metrics).filter(F.col("missing") > 0)


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of rows with a value: (column, completeness, status)."""
    metrics = {
        "completeness": lambda c: F.try_divide(F.count(column(c)) * F.lit(1.0), F.count("*"))
    }
    status = F.when(F.col("completeness") == 1, "COMPLETE").otherwise("INCOMPLETE")
    return per_column(df, columns, metrics).withColumn("status", status)


def year_coverage(tables: Mapping[str, DataFrame], year: str = "Year") -> DataFrame:
    """(dataset, min_year, max_year, n_years, row_count)."""
    tagged = [
        df.select(F.lit(name).alias("dataset"), F.col(year).alias("year"))
        for name, df in tables.items()
    ]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("dataset", "year")
        .agg(F.count("*").alias("rows"))
        .groupBy("dataset")
        .agg(
            F.min("year").alias("min_year"),
            F.max("year").alias("max_year"),
            F.count("year").alias("n_years"),
            F.sum("rows").alias("row_count"),
        )
    )


# Types whose 64-bit hash is one to one.
_FIXED = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DateType, T.TimestampType, T.TimestampNTZType,
)


def _hashed(value: Column, kind: T.DataType) -> tuple[Column, Column]:
    """Two 64-bit words that tell values apart; the second is 0 where the first does alone."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0)  # both zeros are one value
    if isinstance(kind, _FIXED):
        return F.xxhash64(value), F.lit(0).cast("bigint")
    return F.xxhash64(value), F.xxhash64(F.lit("second"), value)


def distinct_numbers(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Distinct values other than NULL of each column, exact, in one shuffle of hashes.

    Every row becomes one narrow row per column, which collapses by (column, hash) before it
    is shuffled. Where one hash stands for different values, which a second hash shows,
    the values themselves are counted.
    """
    columns = list(dict.fromkeys(columns))
    if not columns:
        return {}
    df = reread(df.select(*[column(c).alias(f"c{i}") for i, c in enumerate(columns)]))
    kinds = [f.dataType for f in df.schema.fields]
    words = [_hashed(F.col(f"c{i}"), kind) for i, kind in enumerate(kinds)]
    cells = [
        F.when(
            F.col(f"c{i}").isNotNull(),
            F.struct(F.lit(i).alias("c"), one.alias("one"), two.alias("two")),
        )
        for i, (one, two) in enumerate(words)
    ]
    keys = df.select(F.inline(F.array_compact(F.array(*cells)))).groupBy("c", "one").agg(
        (F.min("two") != F.max("two")).alias("clash")
    )
    counts = dict.fromkeys(range(len(columns)), 0)
    clashes = {}
    per_column = keys.groupBy("c").agg(F.count("*").alias("n"), F.count_if("clash").alias("k"))
    for row in per_column.collect():  # a row per column
        counts[row["c"]] = row["n"]
        if row["k"]:
            clashes[row["c"]] = row["k"]
    for c, hashes in clashes.items():
        shared = keys.where((F.col("c") == c) & F.col("clash")).select("one")
        values = df.select(F.col(f"c{c}").alias("value"), words[c][0].alias("one"))
        values = values.join(shared, "one", "left_semi").select("value").distinct()
        counts[c] += values.count() - hashes
    return {name: counts[i] for i, name in enumerate(columns)}


def distinct_counts(
    df: DataFrame, columns: Sequence[str], approximate: bool = False
) -> DataFrame:
    """(column, distinct_values) other than NULL. Approximate counts keep a fixed-size sketch."""
    if approximate:
        sketch = {"distinct_values": lambda c: F.approx_count_distinct(column(c), 0.02)}
        return per_column(df, columns, sketch)
    rows = list(distinct_numbers(df, columns).items())
    return df.sparkSession.createDataFrame(rows, "column string, distinct_values bigint")


def mean_stddev(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean, stddev) with the sample standard deviation."""
    return per_column(
        df,
        columns,
        {"mean": lambda c: F.mean(column(c)), "stddev": lambda c: F.stddev(column(c))},
    )


def value_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, min, max)."""
    return per_column(
        df,
        columns,
        {
            "min": lambda c: F.min(column(c)).cast("double"),
            "max": lambda c: F.max(column(c)).cast("double"),
        },
    )


def variance_ratio(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, variance_ratio, skewness, kurtosis).

    The ratio of variance to squared deviation is 1 by definition, an identity
    check. Skewness and excess kurtosis are what hints at a normal distribution.
    """
    return per_column(
        df,
        columns,
        {
            "variance_ratio": lambda c: F.try_divide(
                F.variance(column(c)), F.pow(F.stddev(column(c)), F.lit(2))
            ),
            "skewness": lambda c: F.skewness(column(c)),
            "kurtosis": lambda c: F.kurtosis(column(c)),
        },
    )


def describe_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, stddev, min, max)."""
    return per_column(
        df,
        columns,
        {
            "count": lambda c: F.count(column(c)),
            "mean": lambda c: F.mean(column(c)),
            "stddev": lambda c: F.stddev(column(c)),
            "min": lambda c: F.min(column(c)).cast("double"),
            "max": lambda c: F.max(column(c)).cast("double"),
        },
    )


def negative_checks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, negatives)."""
    return per_column(df, columns, {"negatives": lambda c: F.count_if(column(c) < 0)})


def numeric_profile(df: DataFrame, n: int | None = None) -> DataFrame:
    """(column, min, max, mean, stddev) of all numeric columns, or of the first ``n``."""
    return per_column(
        df,
        numeric_columns(df)[:n],
        {
            "min": lambda c: F.min(column(c)).cast("double"),
            "max": lambda c: F.max(column(c)).cast("double"),
            "mean": lambda c: F.mean(column(c)),
            "stddev": lambda c: F.stddev(column(c)),
        },
    )


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """(column, dtype, distinct_values, missing) of every column."""
    dtypes = dict(df.dtypes)
    df = df if approximate else reread(df)
    counts = distinct_counts(df, df.columns, approximate)
    rows = per_column(
        df,
        df.columns,
        {
            "dtype": lambda c: F.lit(dtypes[c]),
            "missing": lambda c: F.count_if(column(c).isNull()),
        },
    )
    # a row per column on both sides
    return rows.join(F.broadcast(counts), "column").select(
        "column", "dtype", "distinct_values", "missing"
    )


def categorical_profile(
    df: DataFrame, n: int | None = None, list_below: int = 10
) -> DataFrame:
    """(column, distinct_values, values) of all string columns, or of the first ``n``.

    ``values`` is the sorted list when there are fewer than ``list_below``. Values
    are counted first and only such short columns are gathered, so a list never
    grows with the data.
    """
    columns = string_columns(df)[:n]
    schema = "column string, distinct_values bigint, values string"
    if not columns:
        return df.sparkSession.createDataFrame([], schema)
    df = reread(df.select(*[column(c) for c in columns]))
    counts = distinct_numbers(df, columns)
    short = [c for c in columns if 0 < counts[c] < list_below]
    sets = [F.array_join(F.sort_array(F.collect_set(column(c))), ", ") for c in short]
    lists = dict(zip(short, df.agg(*sets).first())) if short else {}
    rows = [(c, counts[c], lists.get(c)) for c in columns]
    return df.sparkSession.createDataFrame(rows, schema)


def total_by(df: DataFrame, key: str, value: str, out: str = "total") -> DataFrame:
    """Sum of ``value`` per ``key``; rows without a key are left out."""
    keyed = df.filter(F.col(key).isNotNull())
    return keyed.groupBy(key).agg(F.sum(column(value)).alias(out))


def count_by(df: DataFrame, key: str) -> DataFrame:
    """Rows per ``key``; rows without a key are left out."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count"))


def top_totals(df: DataFrame, key: str, value: str, n: int = 30) -> DataFrame:
    """The ``n`` keys with the largest totals, ties by key."""
    return total_by(df, key, value).orderBy(F.desc("total"), F.asc(key)).limit(n)


def random_sample(df: DataFrame, n: int = 10, seed: int | None = None) -> DataFrame:
    """``n`` random rows: a per-task top-n by random number, then a merge."""
    return df.orderBy(F.rand(seed)).limit(n)


def quality_metrics(
    df: DataFrame, year: str = "Year", country: str = "Country", crop: str = "Crop"
) -> DataFrame:
    """(total_records, n_years, n_countries, n_crops)."""
    df = reread(df.select(*[column(c) for c in (year, country, crop)]))
    counts = distinct_numbers(df, [year, country, crop])
    return df.agg(
        F.count("*").alias("total_records"),
        F.lit(counts[year]).cast("bigint").alias("n_years"),
        F.lit(counts[country]).cast("bigint").alias("n_countries"),
        F.lit(counts[crop]).cast("bigint").alias("n_crops"),
    )


def dataset_summary(
    df: DataFrame,
    area: str = "Area",
    item: str = "Item",
    year: str = "Year",
    target: str = "hg/ha_yield",
) -> DataFrame:
    """One row: records, areas, items, years, year range and the target's mean and range."""
    df = reread(df.select(*[column(c) for c in dict.fromkeys((area, item, year, target))]))
    counts = distinct_numbers(df, [area, item, year])
    return df.agg(
        F.count("*").alias("total_records"),
        F.lit(counts[area]).cast("bigint").alias("n_areas"),
        F.lit(counts[item]).cast("bigint").alias("n_items"),
        F.lit(counts[year]).cast("bigint").alias("n_years"),
        F.min(year).alias("min_year"),
        F.max(year).alias("max_year"),
        F.mean(column(target)).alias("mean_target"),
        F.min(column(target)).alias("min_target"),
        F.max(column(target)).alias("max_target"),
    )
