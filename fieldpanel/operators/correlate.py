"""Pearson correlations and what is read from them."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, Window, functions as F

from fieldpanel.functions.columns import banded
from fieldpanel.operators.profile import column, numeric_columns

# Absolute correlation above the edge -> strength.
STRENGTHS = [(0.3, "Strong"), (0.1, "Moderate"), (0.05, "Weak")]
WEAKEST = "Very weak"


def target_correlations(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """(feature, corr) of each column with the target, in one pass."""
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.corr(column(target), column(c)).alias("corr"))
            for c in columns
        ]
    )
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(col_i, col_j, corr) for all ordered pairs of numeric columns.

    Each pair uses the rows in which both have a value. One pass finds means and
    gaps; a second sums products of centred columns, each sum shared by all pairs
    that need it. Only a pair with gaps carries its own running moments.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    stats = df.agg(
        F.count("*").alias("rows"),
        *[F.count(column(c)).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[F.mean(column(c)).alias(f"mean_{i}") for i, c in enumerate(columns)],
    ).first()
    complete = {c: stats[f"n_{i}"] == stats["rows"] for i, c in enumerate(columns)}
    centred = {
        c: column(c).cast("double") - F.lit(stats[f"mean_{i}"]) for i, c in enumerate(columns)
    }
    cells = []
    for a, b in combinations_with_replacement(columns, 2):
        x, y = centred[a], centred[b]
        if complete[a] and complete[b]:
            spread = F.sum(x * x) if a == b else F.sqrt(F.sum(x * x)) * F.sqrt(F.sum(y * y))
            pair = F.try_divide(F.sum(x * y), spread)
        else:
            pair = F.corr(x, y)
        cells.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), pair.alias("corr")))
    triangle = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    both = F.when(
        F.col("a") != F.col("b"),
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))),
    ).otherwise(F.array(F.struct("a", "b")))
    return triangle.withColumn("pair", F.explode(both)).select(
        F.col("pair.a").alias("col_i"), F.col("pair.b").alias("col_j"), "corr"
    )


def rank_correlations(correlations: DataFrame) -> DataFrame:
    """(rank, feature, corr, abs_corr, strength, direction), strongest first.

    The input has one row per feature, so the single ordered window is small.
    """
    size = F.abs("corr")
    return correlations.select(
        F.row_number().over(Window.orderBy(F.desc_nulls_last(size), "feature")).alias("rank"),
        "feature",
        "corr",
        size.alias("abs_corr"),
        banded(size, STRENGTHS, WEAKEST).alias("strength"),
        F.when(F.col("corr") > 0, "positive").otherwise("negative").alias("direction"),
    )


def correlation_ranking(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    return rank_correlations(target_correlations(df, target, columns))


def select_features(
    ranking: DataFrame, target: str, above: float = 0.1
) -> DataFrame:
    """(feature, abs_corr) of the features above the threshold, and the target itself."""
    kept = ranking.filter(F.col("abs_corr") > above).select("feature", "abs_corr")
    own = ranking.sparkSession.range(1).select(
        F.lit(target).alias("feature"), F.lit(1.0).alias("abs_corr")
    )
    return own.unionByName(kept)


def strongest_feature(ranking: DataFrame) -> DataFrame:
    """(feature, corr, strong_predictor, meaningful_power) of the first rank."""
    return ranking.filter(F.col("rank") == 1).select(
        "feature",
        "corr",
        (F.col("abs_corr") > 0.3).alias("strong_predictor"),
        ((F.col("abs_corr") > 0.1) & (F.col("abs_corr") <= 0.3)).alias("meaningful_power"),
    )


def weak_environment(
    ranking: DataFrame, features: Sequence[str] = ("Rainfall", "Avg_Temperature")
) -> DataFrame:
    """(weak_environment): whether all environment features stay below 0.1."""
    of_interest = ranking.filter(F.col("feature").isin(*features))
    return of_interest.agg(F.bool_and(F.col("abs_corr") < 0.1).alias("weak_environment"))
