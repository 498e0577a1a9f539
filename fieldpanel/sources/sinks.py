"""Writers: tables, samples, reports and fitted models. All overwrite their path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

SAVE_FORMATS = ("parquet", "csv")


def write_csv(
    df: DataFrame,
    path: str,
    *,
    delimiter: str = ",",
    null_value: str = "",
    single_file: bool = False,
) -> None:
    """CSV with a header. ``single_file`` suits small exports: one task writes it all."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(
        header=True, delimiter=delimiter, nullValue=null_value
    ).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, optionally in one folder per partition value for later pruning."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def save(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Write in a named format; an unknown format is an error."""
    if format == "parquet":
        write_parquet(df, path)
    elif format == "csv":
        write_csv(df, path)
    else:
        raise ValueError(f"cannot save as {format!r}; choose one of {', '.join(SAVE_FORMATS)}")


def first_rows(df: DataFrame, order: Sequence[str], n: int = 1000) -> DataFrame:
    """The first ``n`` rows in a stated order (a per-task top-n, then a merge)."""
    return df.orderBy(*order).limit(n)


def write_sample(df: DataFrame, path: str, order: Sequence[str], n: int = 1000) -> None:
    """The first ``n`` rows as CSV."""
    write_csv(first_rows(df, order, n), path)


def write_metrics(metrics: DataFrame, path: str, format: str = "csv") -> None:
    """A model metrics table, one row per named model."""
    if "model" not in metrics.columns:
        raise ValueError("a metrics table needs its model column")
    save(metrics.coalesce(1), path, format)


def write_profile(
    profile: DataFrame, path: str, source: str, total_rows: int, format: str = "json"
) -> None:
    """A column profile with the date, the source, and the source's rows and columns.

    The profile has a row per column of the source.
    """
    stamped = profile.select(
        F.current_date().alias("report_date"),
        F.lit(source).alias("source"),
        F.lit(total_rows).cast("bigint").alias("total_rows"),
        F.lit(profile.count()).cast("bigint").alias("total_columns"),
        "*",
    )
    stamped.coalesce(1).write.mode("overwrite").format(format).save(path)


def save_model(model: PipelineModel, path: str) -> None:
    """A fitted pipeline, preprocessing included."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
