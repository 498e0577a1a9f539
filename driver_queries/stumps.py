"""Trees of depth one against a search over every split in SQL."""

from __future__ import annotations

from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from driver_queries import linear_sql, modelling
from driver_queries.modelling import TABLE
from driver_queries.registry import query, rounded
from fieldpanel.functions.columns import one_row
from fieldpanel.operators import regression
from fieldpanel.operators.regression import ModelTable

BINS = 12
MEASURES = {
    "rain_bin": "average_rain_fall_mm_per_year",
    "pesticide_bin": "pesticides_tonnes",
    "temperature_bin": "avg_temp",
}
BINNED = ModelTable(numeric=["Year", *MEASURES], target=TABLE.target)
NAMES = ("Decision Tree", "Random Forest", "Gradient Boosting")


def stumps():
    """The three kinds of trees, each as one tree with one split over all rows and features."""
    shared = {"labelCol": TABLE.target, "maxDepth": 1, "maxBins": 32, "seed": 1}
    return {
        "Decision Tree": lambda: DecisionTreeRegressor(**shared),
        "Random Forest": lambda: RandomForestRegressor(
            numTrees=1, featureSubsetStrategy="all", bootstrap=False, **shared
        ),
        "Gradient Boosting": lambda: GBTRegressor(
            maxIter=1, featureSubsetStrategy="all", **shared
        ),
    }


def fitted_stumps(spark, sf_dir):
    """The training rows with measures in bins of equal width, and a stump of each kind."""
    _, train, _ = modelling.splits(spark, sf_dir)
    ends = one_row(
        train,
        **{f"low_{b}": F.min(c) for b, c in MEASURES.items()},
        **{f"high_{b}": F.max(c) for b, c in MEASURES.items()},
    )

    def bin_of(name, c):
        part = (F.col(c) - ends[f"low_{name}"]) / (ends[f"high_{name}"] - ends[f"low_{name}"])
        return F.least(F.floor(part * BINS), F.lit(BINS - 1)).cast("double")

    binned = train.withColumns({name: bin_of(name, c) for name, c in MEASURES.items()})
    prepared = regression.prepare(
        binned, binned.limit(0), regression.onehot_features(BINNED), BINNED
    )
    fitted, failed = regression.fit_all(prepared, stumps())
    if failed:
        raise RuntimeError(f"models that could not be fitted: {failed}")
    return prepared, fitted


_SQL_MEASURES = {"rain_bin": "Rainfall", "pesticide_bin": "Pesticides",
                 "temperature_bin": "Avg_Temperature"}
_ENDS = ", ".join(f'min("{c}") AS low_{b}, max("{c}") AS high_{b}' for b, c in _SQL_MEASURES.items())
_CELLS = " UNION ALL ".join(
    ["""SELECT row_key, y, 'Year' AS f, CAST("Year" AS DOUBLE) AS x FROM train"""]
    + [
        f"""SELECT row_key, y, '{b}', CAST(least(floor(("{c}" - low_{b}) / (high_{b} - low_{b})
        * {BINS}), {BINS - 1}) AS DOUBLE) FROM train, ends""" for b, c in _SQL_MEASURES.items()
    ]
    + [
        f"""SELECT row_key, y, '{name}Vec_' || label, CAST("{c}" = label AS DOUBLE)
        FROM train, (SELECT DISTINCT "{c}" AS label FROM train)"""
        for c, name in (("Country", "Area"), ("Crop", "Item"))
    ]
)
BEST_SQL = f"""WITH {linear_sql.SIDED},
train AS (SELECT * FROM sided WHERE in_train),
ends AS (SELECT {_ENDS} FROM train),
cells AS ({_CELLS}),
whole AS (SELECT count(*) AS n, avg(y) AS m, var_pop(y) AS v FROM train),
steps AS (
  SELECT f, x, count(*) AS n, sum(y - m) AS s, sum((y - m) * (y - m)) AS q
  FROM cells, whole GROUP BY f, x),
splits AS (
  SELECT f, (x + lead(x) OVER later) / 2 AS threshold,
         sum(n) OVER upto AS n_low, sum(s) OVER upto AS s_low, sum(q) OVER upto AS q_low,
         sum(n) OVER (PARTITION BY f) AS n, sum(s) OVER (PARTITION BY f) AS s,
         sum(q) OVER (PARTITION BY f) AS q
  FROM steps WINDOW later AS (PARTITION BY f ORDER BY x),
    upto AS (PARTITION BY f ORDER BY x ROWS UNBOUNDED PRECEDING)),
best AS (
  SELECT *, (q - s * s / n) / n - (q_low - s_low * s_low / n_low) / n
         - (q - q_low - (s - s_low) * (s - s_low) / (n - n_low)) / n AS gain
  FROM splits WHERE threshold IS NOT NULL ORDER BY gain DESC LIMIT 1)"""


@query(
    "tree_stumps",
    f"""{BEST_SQL}, kinds(model) AS (VALUES {', '.join(f"('{n}')" for n in NAMES)}),
    -- a slot's side of lower mean goes low
    sides AS (
      SELECT best.*, m, f LIKE '%Vec~_%' ESCAPE '~' AS slot,
             slot AND (s - s_low) / (n - n_low) < s_low / n_low AS turned FROM best,
             (SELECT m FROM whole)),
    nodes AS (
      SELECT 0 AS node, f AS name, CASE WHEN NOT slot THEN threshold END AS threshold,
             CASE WHEN slot THEN CAST(CAST(turned AS INT) AS VARCHAR) || '.0' END AS low_values,
             gain, n AS row_count, m AS prediction FROM sides
      UNION ALL SELECT 1 + CAST(turned AS INT), NULL, NULL, NULL, NULL, n_low,
             m + s_low / n_low FROM sides
      UNION ALL SELECT 2 - CAST(turned AS INT), NULL, NULL, NULL, NULL, n - n_low,
             m + (s - s_low) / (n - n_low) FROM sides)
    SELECT model, node, name, round(threshold, 6) AS threshold, low_values,
           round(gain, 5) AS gain, CAST(row_count AS BIGINT) AS row_count,
           round(prediction, 5) AS prediction FROM kinds, nodes""",
)
def tree_stumps(spark, sf_dir):
    """Split, gain, rows and means of every node of the three stumps."""
    prepared, fitted = fitted_stumps(spark, sf_dir)
    found = regression.tree_splits(fitted, prepared, BINNED).withColumnRenamed("rows", "row_count")
    low = F.array_join(F.col("values").cast("array<string>"), ", ")
    found = found.select(
        "model", "node", "name", "threshold", low.alias("low_values"), "gain", "row_count",
        "prediction",
    )
    return rounded(rounded(found, 6, "threshold"), 5, "gain", "prediction")


@query(
    "stump_shapes",
    f"""{BEST_SQL}
    SELECT 'Decision Tree' AS model, CAST(gain > 0 AS INTEGER) AS depth,
           1 + 2 * CAST(gain > 0 AS INTEGER) AS nodes FROM best""",
)
def stump_shapes(spark, sf_dir):
    """Depth and number of nodes of the single tree."""
    _, fitted = fitted_stumps(spark, sf_dir)
    return regression.tree_shape({"Decision Tree": fitted["Decision Tree"]}, spark)
