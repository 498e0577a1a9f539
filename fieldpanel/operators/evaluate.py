"""Regression metrics and the ranking of models by them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldpanel.functions.columns import banded
from fieldpanel.operators.profile import column

# R2 above the edge -> performance band.
BANDS = [(0.9, "exceptional"), (0.7, "excellent"), (0.5, "good"), (0.3, "moderate")]
LOWEST_BAND = "poor"


def metric_columns(label: str, prediction: str) -> dict[str, Column]:
    """R2, MAE and RMSE as plain aggregates over (label, prediction)."""
    y = column(label)
    error = y - column(prediction)
    squares = F.sum(error * error)
    return {
        "r2": 1 - F.try_divide(squares, F.var_pop(y) * F.count(error)),
        "mae": F.mean(F.abs(error)),
        "rmse": F.sqrt(F.mean(error * error)),
    }


def regression_metrics(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """(``by``..., r2, mae, rmse) in one pass; rows lacking either value do not count."""
    complete = df.filter(column(label).isNotNull() & column(prediction).isNotNull())
    metrics = [expr.alias(m) for m, expr in metric_columns(label, prediction).items()]
    return complete.groupBy(*by).agg(*metrics) if by else complete.agg(*metrics)


def metrics_of_many(df: DataFrame, label: str, predictions: Mapping[str, str]) -> DataFrame:
    """(model, r2, mae, rmse) of several prediction columns, all in one pass.

    ``predictions`` maps a model name to its column.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(model).alias("model"),
                *[expr.alias(m) for m, expr in metric_columns(label, p).items()],
            )
            for model, p in predictions.items()
        ]
    )
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def relative_errors(metrics: DataFrame, mean_label: Column) -> DataFrame:
    """Add MAE and RMSE in percent of the mean label."""
    return metrics.withColumns(
        {
            "mae_pct": F.try_divide(F.col("mae"), mean_label) * 100,
            "rmse_pct": F.try_divide(F.col("rmse"), mean_label) * 100,
        }
    )


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Add the rank by R2, best first. The table has one row per model."""
    best_first = Window.orderBy(F.desc_nulls_last("r2"), "model")
    return metrics.withColumn("rank", F.row_number().over(best_first))


def performance_band(metrics: DataFrame) -> DataFrame:
    """Add the band R2 falls into."""
    return metrics.withColumn("band", banded(F.col("r2"), BANDS, LOWEST_BAND))


def best_k(sweep: DataFrame) -> DataFrame:
    """The row of a neighbour-count sweep with the highest R2, the smallest k on ties."""
    return sweep.orderBy(F.desc("r2"), F.asc("k")).limit(1)
