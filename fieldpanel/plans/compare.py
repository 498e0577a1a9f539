"""Model comparison on a modelling table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, functions as F, types as T

from fieldpanel.functions.columns import key_text, one_row
from fieldpanel.operators import (
    correlate,
    evaluate,
    features,
    neighbors,
    profile,
    regression,
    shape,
)
from fieldpanel.operators.regression import ModelTable
from fieldpanel.staging import stage

# Panel column -> modelling column, and the neighbour counts tried.
MODEL_NAMES = {
    "Yield": "hg/ha_yield",
    "Rainfall": "average_rain_fall_mm_per_year",
    "Pesticides": "pesticides_tonnes",
    "Avg_Temperature": "avg_temp",
    "Country": "Area",
    "Crop": "Item",
}
NEIGHBOR_COUNTS = (3, 5, 7, 10, 15)


def modelling_table(panel: DataFrame) -> DataFrame:
    """The panel under modelling names."""
    return shape.rename_columns(panel, MODEL_NAMES)


def labelled(df: DataFrame, target: str) -> DataFrame:
    return df.filter(F.col(f"`{target}`").isNotNull())


def knn_tables(
    train: DataFrame,
    test: DataFrame,
    key: str,
    table: ModelTable = ModelTable(),
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both splits with ordinal codes, mean-imputed and scaled by the training rows."""
    encoded = []
    for c in table.categorical:
        code = f"{c}Code"
        train, test = features.label_encode(train, test, c, code)
        encoded.append(code)
    numbers = [*table.numeric, *encoded]
    target = f"`{table.target}`"
    columns = [key, F.col(target).alias("label"), *numbers]
    train = stage(train.select(*columns), "knn_train")
    test = stage(test.select(*columns), "knn_test")
    full_train = features.mean_impute(train, list(table.numeric))
    full_test = features.mean_impute(test, list(table.numeric), fit_on=train)
    scaled = {c: f"{c}_scaled" for c in numbers}
    return (
        features.standard_scale(full_train, scaled),
        features.standard_scale(full_test, scaled, fit_on=full_train),
        list(scaled.values()),
    )


def neighbor_table(
    train: DataFrame,
    test: DataFrame,
    key: str,
    k: int,
    table: ModelTable = ModelTable(),
    **blocks: int,
) -> tuple[DataFrame, DataFrame]:
    """The k nearest training rows of each test row, and the test labels by key."""
    scaled_train, scaled_test, vector = knn_tables(train, test, key, table)
    scaled_train = scaled_train.withColumnRenamed(key, "train_key")
    found = neighbors.knn_neighbors(
        scaled_train, scaled_test, vector, k, "train_key", key, "label", **blocks
    )
    return found, scaled_test.select(key, F.col("label").alias("actual"))


def knn_sweep(
    train: DataFrame,
    test: DataFrame,
    key: str,
    ks: Sequence[int] = NEIGHBOR_COUNTS,
    weights: str = "distance",
    table: ModelTable = ModelTable(),
    **blocks: int,
) -> DataFrame:
    """(k, r2, mae, rmse) for every neighbour count, from one neighbour search."""
    found, actual = neighbor_table(train, test, key, max(ks), table, **blocks)
    predicted = neighbors.knn_predict(found, key, "label", ks, weights)
    return evaluate.regression_metrics(predicted.join(actual, key), "actual", "prediction", ["k"])


def compare(
    df: DataFrame,
    key: Sequence[str],
    table: ModelTable = ModelTable(),
    train_percent: int = 80,
) -> dict[str, DataFrame]:
    """Correlations, all models, their ranking and the dataset summary.

    ``key`` names the columns that identify a row: they decide the split and, as
    text, break ties between neighbours.
    """
    data = labelled(modelling_table(df), table.target)
    data = data.withColumn("row_key", key_text([F.col(f"`{c}`") for c in key]))
    data = stage(data, "model_table")
    train, test = features.hash_split(data, ["row_key"], train_percent)

    prepared = regression.prepare(train, test, partial(regression.onehot_features, table), table)
    registry = regression.onehot_models(table.target, regression.tree_bins(data, table))
    metrics = regression.compare_models(prepared, registry)

    sweep = evaluate.best_k(knn_sweep(train, test, "row_key", table=table))
    name = F.format_string("KNN (k=%d)", F.col("k"))
    nearest = sweep.select(
        name.alias("model"), "r2", "mae", "rmse", F.lit(None).cast("string").alias("error")
    )
    ranked = evaluate.leaderboard(metrics.unionByName(nearest))
    mean_label = one_row(data, m=F.mean(f"`{table.target}`"))["m"]
    ranking = evaluate.relative_errors(evaluate.performance_band(ranked), mean_label)
    return {"ranking": ranking, **data_parts(data, table)}


def data_parts(data: DataFrame, table: ModelTable = ModelTable()) -> dict[str, DataFrame]:
    """The parts of a comparison that need no model: correlations and the dataset summary."""
    return {
        "correlations": correlate.target_correlations(
            data, table.target, [c for c in table.numeric if c != "Year"]
        ),
        "summary": profile.dataset_summary(
            data, *table.categorical, year="Year", target=table.target
        ),
    }


def comparison_report(found: Mapping[str, DataFrame]) -> DataFrame:
    """(part, item, measure, value, text): all parts of a comparison as one long table.

    ``value`` holds numbers and ``text`` everything else.
    """
    parts = []
    for part, table in found.items():
        names = [f.name for f in table.schema.fields]
        item = next((c for c in ("model", "column", "feature") if c in names), None)
        cells = []
        for field in table.schema.fields:
            if field.name == item:
                continue
            value = F.col(f"`{field.name}`")
            number = isinstance(field.dataType, T.NumericType)
            empty = F.lit(None)
            cells.append(
                F.struct(
                    F.lit(field.name).alias("measure"),
                    (value if number else empty).cast("double").alias("value"),
                    (empty if number else value).cast("string").alias("text"),
                )
            )
        named = F.col(f"`{item}`") if item else F.lit("(all)")
        parts.append(
            table.select(F.lit(part).alias("part"), named.cast("string").alias("item"),
                         F.inline(F.array(*cells)))
        )
    return reduce(DataFrame.unionByName, parts)


def best_model(ranking: DataFrame) -> str:
    """The first-ranked model's name."""
    return ranking.filter(F.col("rank") == 1).first()["model"]
