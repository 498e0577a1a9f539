"""Quality report, exploration and flexible profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from fieldpanel.operators import clean, correlate, features, profile, shape
from fieldpanel.operators.profile import column
from fieldpanel.plans.preprocess import NUMBERS
from fieldpanel.sources import sinks
from fieldpanel.staging import reread, stage

# The columns of the modelling file, in order.
MODEL_COLUMNS = [
    "Year", "average_rain_fall_mm_per_year", "pesticides_tonnes", "avg_temp", "Area", "Item",
    "hg/ha_yield",
]


def quality_report(
    df: DataFrame,
    numbers: Sequence[str] = NUMBERS,
    keys: Sequence[str] = ("Year", "Country", "Crop"),
    not_negative: Sequence[str] = ("Yield", "Rainfall", "Pesticides"),
) -> DataFrame:
    """(section, column, metric, value): one pass for all but the distinct keys."""
    df = reread(df)
    distinct = profile.distinct_numbers(df, keys)
    rows = F.count("*")
    cells = [("nulls", c, "nulls", F.count_if(column(c).isNull())) for c in df.columns]
    for c in numbers:
        cells += [
            ("completeness", c, "completeness", F.try_divide(F.count(c) * F.lit(1.0), rows)),
            ("summary", c, "count", F.count(c)),
            ("summary", c, "mean", F.mean(c)),
            ("summary", c, "stddev", F.stddev(c)),
            ("range", c, "min", F.min(c)),
            ("range", c, "max", F.max(c)),
        ]
    cells += [("negatives", c, "negatives", F.count_if(F.col(c) < 0)) for c in not_negative]
    cells += [("coverage", c, "distinct_values", F.lit(distinct[c])) for c in keys]
    cells += [("coverage", "(all)", "row_count", rows)]
    table = F.array(
        *[
            F.struct(
                F.lit(section).alias("section"),
                F.lit(c).alias("column"),
                F.lit(metric).alias("metric"),
                value.cast("double").alias("value"),
            )
            for section, c, metric, value in cells
        ]
    )
    return df.agg(table.alias("cells")).select(F.inline("cells"))


def describe_quartiles(
    df: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """(column, count, mean, stddev, min, q25, q50, q75, max) with exact quartiles."""
    columns = list(columns) if columns is not None else profile.numeric_columns(df)
    df = reread(df.select(*[column(c) for c in columns]))
    points = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    found = features.interpolated_quantiles(df, columns, list(points))
    quartiles = found.groupBy("column").agg(
        *[
            F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(name)
            for p, name in points.items()
        ]
    )
    stats = profile.describe_stats(df, columns)
    joined = stats.join(F.broadcast(quartiles), "column", "left")  # one row per column
    return joined.select("column", "count", "mean", "stddev", "min", *points.values(), "max")


def explore(
    df: DataFrame, columns: Sequence[str] = MODEL_COLUMNS, area: str = "Area", item: str = "Item"
) -> dict[str, DataFrame]:
    """Every exploration table of a modelling file, computed from one cleaned copy."""
    deduped = clean.dedup_rows(shape.drop_if_exists(df))
    table = stage(deduped.select(*[column(c) for c in columns]), "explore")
    target = columns[-1]
    return {
        "info": shape.inspect(table),
        "missing": profile.null_counts(table),
        "description": describe_quartiles(table),
        "correlation": correlate.correlation_matrix(table),
        "distinct": profile.distinct_counts(table, [area, item]),
        "count_by_area": profile.count_by(table, area),
        "count_by_item": profile.count_by(table, item),
        "top_areas": profile.top_totals(table, area, target),
        "total_by_item": profile.total_by(table, item, target).orderBy(F.desc("total"), item),
    }


def profile_report(
    df: DataFrame, n_numeric: int | None = None, n_categorical: int | None = None
) -> DataFrame:
    """(section, column, metric, value, text): size, missing values, numbers and categories.

    One pass for all missing values and numbers, one for the categories. Both cover
    all columns unless told to take the first few.
    """
    rows = F.count("*")
    cells = [  # section, column, metric, value, whether to show it
        ("size", "(all)", "row_count", rows, F.lit(True)),
        ("size", "(all)", "column_count", F.lit(len(df.columns)), F.lit(True)),
    ]
    for c in df.columns:
        missing = F.count_if(column(c).isNull())
        percent = F.try_divide(missing * F.lit(100.0), rows)
        cells.append(("missing", c, "missing", missing, missing > 0))
        cells.append(("missing", c, "missing_pct", percent, missing > 0))
    for c in profile.numeric_columns(df)[:n_numeric]:
        for metric, make in (
            ("min", F.min), ("max", F.max), ("mean", F.mean), ("stddev", F.stddev)
        ):
            cells.append(("numeric", c, metric, make(column(c)), F.lit(True)))
    table = F.array(
        *[
            F.struct(
                F.lit(section).alias("section"),
                F.lit(c).alias("column"),
                F.lit(metric).alias("metric"),
                value.cast("double").alias("value"),
                shown.alias("shown"),
            )
            for section, c, metric, value, shown in cells
        ]
    )
    counted = df.agg(table.alias("cells")).select(F.inline("cells")).filter("shown")
    counted = counted.drop("shown").withColumn("text", F.lit(None).cast("string"))
    categories = profile.categorical_profile(df, n_categorical).select(
        F.lit("categorical").alias("section"),
        "column",
        F.lit("distinct_values").alias("metric"),
        F.col("distinct_values").cast("double").alias("value"),
        F.col("values").alias("text"),
    )
    return counted.unionByName(categories)


def flexible_profile(df: DataFrame, n_extra: int | None = None) -> DataFrame:
    """Profile any table by roles found in its column names."""
    return profile_report(shape.prepare_columns(df, n_extra=n_extra))


def flexible_export(df: DataFrame, root: str, order: Sequence[str], source: str) -> DataFrame:
    """Prepare a table by roles and write it, a sample of it and its column profile."""
    prepared = stage(shape.prepare_columns(df), "prepared")
    root = root.rstrip("/")
    sinks.write_parquet(prepared, f"{root}/processed/prepared_data.parquet")
    sinks.write_sample(prepared, f"{root}/results/data_sample.csv", order)
    report = profile.column_profile(prepared)
    sinks.write_profile(report, f"{root}/results/data_report.json", source, prepared.count())
    return prepared
