"""Models, neighbours, metrics and scoring."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from driver_queries import linear_sql, star
from driver_queries.registry import query, read, rounded
from fieldpanel.functions.columns import key_text, one_row
from fieldpanel.operators import evaluate, features, neighbors, regression
from fieldpanel.operators.regression import ModelTable
from fieldpanel.plans import compare, preprocess
from fieldpanel.sources import readers, sinks
from fieldpanel.staging import stage, staging_path

TABLE = ModelTable()
KEY = ["Area", "Year", "Item"]


def model_base(spark, sf_dir):
    """One row per (Area, Year, Item): the averaged panel under modelling names."""
    panel = preprocess.integrated_panel(star.raw_tables(spark, sf_dir), on_duplicate="mean")
    return compare.modelling_table(star.averaged_panel(panel))


def splits(spark, sf_dir):
    keyed = model_base(spark, sf_dir).withColumn("row_key", key_text(KEY))
    data = stage(keyed, "model_base")
    return (data, *features.hash_split(data, ["row_key"]))


def prepared_onehot(spark, sf_dir):
    data, train, test = splits(spark, sf_dir)
    prepared = regression.prepare(train, test, partial(regression.onehot_features, TABLE), TABLE)
    registry = regression.onehot_models(TABLE.target, regression.tree_bins(data, TABLE))
    return prepared, registry


def prepared_scaled(spark, sf_dir):
    _, train, test = splits(spark, sf_dir)
    rows = train.count()
    features_of = partial(regression.scaled_features, TABLE, rows)
    prepared = regression.prepare(train, test, features_of, TABLE)
    return prepared, regression.scaled_models(TABLE.target, rows)


def metrics_for(name, prepare, spark, sf_dir):
    """Train one registered model and report its held-out metrics."""
    prepared, registry = prepare(spark, sf_dir)
    fitted = regression.fit_model(prepared, registry[name]())
    return rounded(regression.evaluate_all(prepared, {name: fitted}), 4, "r2", "mae", "rmse")


SWEEPS = 250  # of the descent in SQL; on these tables it stands still after some 50
# name -> penalties as SQL (l1, l2), whether l2 goes by the label's deviation, by deviations
LINEAR_SQL = {
    "model_linear": linear_sql.metrics_sql("Linear Regression", ("0", "0.01", True, True), False),
    "model_ridge": linear_sql.metrics_sql("Ridge Regression", ("0", "0.1", True, True), False),
    "model_lasso": linear_sql.metrics_sql(
        "Lasso Regression", ("0.01", "0", True, True), False, SWEEPS
    ),
    "model_elastic_net": linear_sql.metrics_sql(
        "Elastic Net", ("0.025", "0.025", True, True), False, SWEEPS
    ),
    "model_ols": linear_sql.metrics_sql("Linear Regression", ("0", "0", False, True), True),
    "model_lasso_alpha1": linear_sql.metrics_sql("Lasso", ("1.0", "0", False, False), True, SWEEPS),
    "model_ridge_alpha1": linear_sql.metrics_sql("Ridge", ("0", "1.0 / n", False, False), True),
}

for key, name, prepare in [
    ("model_linear", "Linear Regression", prepared_onehot),
    ("model_ridge", "Ridge Regression", prepared_onehot),
    ("model_lasso", "Lasso Regression", prepared_onehot),
    ("model_elastic_net", "Elastic Net", prepared_onehot),
    ("model_forest", "Random Forest", prepared_onehot),
    ("model_gbt", "Gradient Boosting", prepared_onehot),
    ("model_ols", "Linear Regression", prepared_scaled),
    ("model_lasso_alpha1", "Lasso", prepared_scaled),
    ("model_ridge_alpha1", "Ridge", prepared_scaled),
    ("model_tree_deep", "Decision Tree", prepared_scaled),
]:
    query(key, LINEAR_SQL.get(key))(partial(metrics_for, name, prepare))


@query("model_tree")
def model_tree(spark, sf_dir):
    """Metrics and shape of the depth-10 tree."""
    prepared, registry = prepared_onehot(spark, sf_dir)
    fitted = {"Decision Tree": regression.fit_model(prepared, registry["Decision Tree"]())}
    metrics = regression.evaluate_all(prepared, fitted)
    return rounded(metrics, 4, "r2", "mae", "rmse").join(
        F.broadcast(regression.tree_shape(fitted, spark)), "model"  # one row per model
    )


COEFFICIENTS_SQL = f"""{linear_sql.coefficients_sql(("0", "0.01", True, True), False)}
    SELECT f AS name, CASE WHEN f LIKE 'AreaVec%' THEN 'Area' WHEN f LIKE 'ItemVec%' THEN 'Item'
                           ELSE f END AS feature,
           round(w, 4) + 0.0 AS coefficient, round(abs(w), 4) AS magnitude,
           CASE WHEN w > 0 THEN 'increases' ELSE 'decreases' END AS direction
    FROM fitted"""


@query("model_coefficients", COEFFICIENTS_SQL)
def model_coefficients(spark, sf_dir):
    """The coefficients by slot name; a slot's number is left to the indexer."""
    prepared, registry = prepared_onehot(spark, sf_dir)
    fitted = regression.fit_model(prepared, registry["Linear Regression"]())
    found = regression.coefficients(fitted, prepared, TABLE).drop("slot")
    return rounded(found, 4, "coefficient", "magnitude")


@query("feature_importance")
def feature_importance(spark, sf_dir):
    """Tree, forest and boosting importances per input column, best first."""
    prepared, registry = prepared_onehot(spark, sf_dir)
    names = ("Decision Tree", "Random Forest", "Gradient Boosting")
    fitted = {n: regression.fit_model(prepared, registry[n]()) for n in names}
    return regression.feature_importance(fitted, prepared, TABLE)


@query("compare_models")
def compare_models(spark, sf_dir):
    """The full comparison: correlations, the summary, and all models and the best neighbour
    count with ranks, bands and relative errors."""
    found = compare.compare(averaged(spark, sf_dir), KEY, TABLE)
    return rounded(compare.comparison_report(found), 4, "value")


def _summary_sql():
    """The dataset summary in long form."""
    cells = {
        "total_records": "count(*)", "n_areas": 'count(DISTINCT "Country")',
        "n_items": 'count(DISTINCT "Crop")', "n_years": 'count(DISTINCT "Year")',
        "min_year": 'min("Year")', "max_year": 'max("Year")', "mean_target": 'avg("Yield")',
        "min_target": 'min("Yield")', "max_target": 'max("Yield")',
    }
    return " UNION ALL ".join(
        f"""SELECT 'summary' AS part, '(all)' AS item, '{name}' AS measure,
        round(CAST({value} AS DOUBLE), 4) + 0.0 AS value, CAST(NULL AS VARCHAR) AS text
        FROM model_panel""" for name, value in cells.items()
    )


@query(
    "comparison_parts",
    f"WITH {star.MODEL_SQL} {_summary_sql()} UNION ALL "
    + " UNION ALL ".join(
        f"""SELECT 'correlations', '{linear_sql.FEATURE_NAMES[c]}', 'corr',
        round(corr("Yield", "{c}"), 4) + 0.0, NULL FROM model_panel"""
        for c in linear_sql.MEASURES if c != "Year"
    ),
)
def comparison_parts(spark, sf_dir):
    """What the comparison returns beside the models."""
    data = stage(compare.modelling_table(averaged(spark, sf_dir)), "model_table")
    parts = compare.data_parts(compare.labelled(data, TABLE.target), TABLE)
    return rounded(compare.comparison_report(parts), 4, "value")


def averaged(spark, sf_dir):
    panel = preprocess.integrated_panel(star.raw_tables(spark, sf_dir), on_duplicate="mean")
    return star.averaged_panel(panel)


LINEAR_QUERIES = ("model_linear", "model_ridge", "model_lasso", "model_elastic_net")
_LINEAR_METRICS = " UNION ALL ".join(f"SELECT * FROM ({LINEAR_SQL[q]})" for q in LINEAR_QUERIES)


@query(
    "compare_linear",
    f"""SELECT m.*, round(mae / label * 100, 4) AS mae_pct, round(rmse / label * 100, 4) AS rmse_pct,
         CASE WHEN r2 > 0.9 THEN 'exceptional' WHEN r2 > 0.7 THEN 'excellent'
              WHEN r2 > 0.5 THEN 'good' WHEN r2 > 0.3 THEN 'moderate' ELSE 'poor' END AS band,
         CAST(row_number() OVER (ORDER BY r2 DESC, model) AS INTEGER) AS rank
       FROM ({_LINEAR_METRICS}) m,
            (WITH {star.MODEL_SQL} SELECT avg("Yield") AS label FROM model_panel)""",
)
def compare_linear(spark, sf_dir):
    """The linear models fitted side by side, ranked and banded, with relative errors."""
    data, train, test = splits(spark, sf_dir)
    prepared = regression.prepare(train, test, partial(regression.onehot_features, TABLE), TABLE)
    registry = regression.onehot_models(TABLE.target)
    names = ["Linear Regression", "Ridge Regression", "Lasso Regression", "Elastic Net"]
    metrics = regression.compare_models(prepared, {n: registry[n] for n in names}).drop("error")
    ranked = evaluate.leaderboard(
        evaluate.performance_band(rounded(metrics, 4, "r2", "mae", "rmse"))
    )
    mean = one_row(data, m=F.mean(F.col(f"`{TABLE.target}`")))["m"]
    return rounded(evaluate.relative_errors(ranked, mean), 4, "mae_pct", "rmse_pct")


@query(
    "batch_score_linear",
    f"""{linear_sql.predictions_sql(("0", "0.1", True, True), False)}
    SELECT row_key, round(p, 4) AS prediction FROM predicted""",
)
def batch_score_linear(spark, sf_dir):
    """Predictions for every held-out row by the ridge pipeline."""
    _, train, test = splits(spark, sf_dir)
    prepared = regression.prepare(train, test, partial(regression.onehot_features, TABLE), TABLE)
    model = regression.fit_model(
        prepared, regression.onehot_models(TABLE.target)["Ridge Regression"]()
    )
    requests = test.select("row_key", *TABLE.features)
    scored = regression.batch_score(model, requests).select("row_key", "prediction")
    return rounded(scored, 4, "prediction")


@query("model_leaderboard")
def model_leaderboard(spark, sf_dir):
    """The models over scaled features, ranked by R2."""
    prepared, registry = prepared_scaled(spark, sf_dir)
    ranked = evaluate.leaderboard(regression.compare_models(prepared, registry))
    return rounded(ranked, 4, "r2", "mae", "rmse")


@query(
    "model_roundtrip",
    f"""WITH {star.MODEL_SQL},
    keyed AS (SELECT "Country" || '|' || "Year" || '|' || "Crop" AS row_key FROM model_panel)
    SELECT count(*) AS n_scored, CAST(0 AS DOUBLE) AS largest_change FROM keyed
    WHERE CAST('0x' || substr(md5(row_key), 1, 8) AS BIGINT) % 100 >= 80""",
)
def model_roundtrip(spark, sf_dir):
    """A fitted pipeline saved, loaded and used: the largest change in any prediction."""
    _, train, test = splits(spark, sf_dir)
    prepared = regression.prepare(train, test, regression.onehot_features(TABLE), TABLE)
    model = regression.fit_model(
        prepared, regression.onehot_models(TABLE.target)["Linear Regression"]()
    )
    path = staging_path(spark, "model")
    sinks.save_model(model, path)
    before = regression.batch_score(model, test).select(
        "row_key", F.col("prediction").alias("before")
    )
    after = regression.batch_score(sinks.load_model(path), test).select(
        "row_key", F.col("prediction").alias("after")
    )
    change = F.max(F.abs(F.col("before") - F.col("after"))).alias("largest_change")
    return before.join(after, "row_key").agg(F.count("*").alias("n_scored"), change)


@query("batch_score")
def batch_score(spark, sf_dir):
    """Predictions for every held-out row by the tree pipeline."""
    _, train, test = splits(spark, sf_dir)
    prepared = regression.prepare(train, test, regression.onehot_features(TABLE), TABLE)
    model = regression.fit_model(
        prepared, regression.onehot_models(TABLE.target)["Decision Tree"]()
    )
    requests = test.select("row_key", *TABLE.features)
    return rounded(regression.batch_score(model, requests), 4, "prediction")


# --- metrics ---------------------------------------------------------------

METRICS_SQL = """SELECT l_returnflag,
       round(1 - sum(power(l_extendedprice - p, 2)) / (var_pop(l_extendedprice) * count(*)), 8)
         AS r2,
       round(avg(abs(l_extendedprice - p)), 4) AS mae,
       round(sqrt(avg(power(l_extendedprice - p, 2))), 4) AS rmse
     FROM (SELECT *, l_quantity * 1800 + 4000 AS p FROM lineitem) GROUP BY 1"""


@query("regression_metrics", METRICS_SQL)
def regression_metrics(spark, sf_dir):
    """Price predicted from quantity by a fixed line, per return flag."""
    items = read(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_extendedprice", (F.col("l_quantity") * 1800 + 4000).alias("p")
    )
    found = evaluate.regression_metrics(items, "l_extendedprice", "p", by=["l_returnflag"])
    return rounded(rounded(found, 8, "r2"), 4, "mae", "rmse")


@query(
    "relative_errors",
    f"""WITH m AS ({METRICS_SQL}), y AS (SELECT avg(l_extendedprice) AS label FROM lineitem)
    SELECT l_returnflag, r2, mae, rmse, round(mae / label * 100, 6) AS mae_pct,
           round(rmse / label * 100, 6) AS rmse_pct FROM m, y""",
)
def relative_errors(spark, sf_dir):
    mean = one_row(read(spark, sf_dir, "lineitem"), m=F.mean("l_extendedprice"))["m"]
    found = evaluate.relative_errors(regression_metrics(spark, sf_dir), mean)
    return rounded(found, 6, "mae_pct", "rmse_pct")


PRIORITY_SQL = """SELECT o_orderpriority AS model,
         round(1 - sum(power(o_totalprice - p, 2)) / (var_pop(o_totalprice) * count(*)), 6) AS r2,
         round(avg(abs(o_totalprice - p)), 4) AS mae,
         round(sqrt(avg(power(o_totalprice - p, 2))), 4) AS rmse
       FROM (SELECT *, o_totalprice + (CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1)
               * 20000 * (CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END) AS p
             FROM orders) GROUP BY 1"""


def priority_metrics(spark, sf_dir):
    """One metrics row per order priority, for predictions that miss by more for each."""
    step = (F.substring("o_orderpriority", 1, 1).cast("int") - 1) * 20000
    side = F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(-1)
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("model"),
        "o_totalprice",
        (F.col("o_totalprice") + step * side).alias("p"),
    )
    found = evaluate.regression_metrics(orders, "o_totalprice", "p", by=["model"])
    return rounded(rounded(found, 6, "r2"), 4, "mae", "rmse")


@query(
    "performance_band",
    f"""SELECT *, CASE WHEN r2 > 0.9 THEN 'exceptional'
         WHEN r2 > 0.7 THEN 'excellent' WHEN r2 > 0.5 THEN 'good' WHEN r2 > 0.3 THEN 'moderate'
         ELSE 'poor' END AS band,
         CAST(row_number() OVER (ORDER BY r2 DESC, model) AS INTEGER) AS rank
       FROM ({PRIORITY_SQL})""",
)
def performance_band(spark, sf_dir):
    """The priorities ranked and banded."""
    return evaluate.leaderboard(evaluate.performance_band(priority_metrics(spark, sf_dir)))


@query("metrics_sink", PRIORITY_SQL)
def metrics_sink(spark, sf_dir):
    """A metrics table written as CSV and read back, model names included."""
    metrics = priority_metrics(spark, sf_dir)
    path = staging_path(spark, "metrics_csv")
    sinks.write_metrics(metrics, path)
    return readers.read_csv(spark, path, metrics.schema)


# --- neighbours ------------------------------------------------------------

NUMERIC = ['"Year"', '"Rainfall"', '"Pesticides"', '"Avg_Temperature"']
VECTOR = [*NUMERIC, "area_code", "item_code"]
_SPREAD = ", ".join(
    f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(VECTOR)
)
_SCALE = ", ".join(f"({c} - m{i}) / s{i} AS f{i}" for i, c in enumerate(VECTOR))
_SQUARES = " + ".join(f"(q.f{i} - t.f{i}) * (q.f{i} - t.f{i})" for i in range(len(VECTOR)))
NEIGHBORS_SQL = f"""{star.MODEL_SQL},
keyed AS (SELECT *, "Country" || '|' || "Year" || '|' || "Crop" AS row_key FROM model_panel),
coded AS (
  SELECT *, dense_rank() OVER (ORDER BY "Country") - 1 AS area_code,
         dense_rank() OVER (ORDER BY "Crop") - 1 AS item_code,
         CAST('0x' || substr(md5(row_key), 1, 8) AS BIGINT) % 100 < 80 AS in_train
  FROM keyed),
spread AS (SELECT {_SPREAD} FROM coded WHERE in_train),
scaled AS (SELECT row_key, in_train, "Yield" AS label, {_SCALE} FROM coded, spread),
pairs AS (
  SELECT q.row_key, q.label AS actual, t.row_key AS train_key, t.label,
         round(sqrt({_SQUARES}), 9) AS distance
  FROM scaled q JOIN scaled t ON NOT q.in_train AND t.in_train),
neighbors AS (
  SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY distance, train_key) AS rank
  FROM pairs QUALIFY rank <= 15)"""
PREDICT = """coalesce(avg(label) FILTER (WHERE distance = 0),
      sum(label / nullif(distance, 0)) / sum(1 / nullif(distance, 0)))"""
BLOCKS = {"block_rows": 512}  # several boxes even on the small tables


def neighbor_table(spark, sf_dir, k):
    _, train, test = splits(spark, sf_dir)
    return compare.neighbor_table(train, test, "row_key", k, TABLE, **BLOCKS)


@query(
    "knn_neighbors",
    f"""WITH {NEIGHBORS_SQL}
    SELECT row_key, train_key, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance, label
    FROM neighbors WHERE rank <= 5""",
)
def knn_neighbors(spark, sf_dir):
    found, _ = neighbor_table(spark, sf_dir, 5)
    return rounded(found, 6, "distance")


@query(
    "knn_predict",
    f"""WITH {NEIGHBORS_SQL}
    SELECT row_key, 7 AS k, round({PREDICT}, 5) AS prediction FROM neighbors
    WHERE rank <= 7 GROUP BY 1""",
)
def knn_predict(spark, sf_dir):
    found, _ = neighbor_table(spark, sf_dir, 7)
    return rounded(neighbors.knn_predict(found, "row_key", "label", [7]), 5, "prediction")


def _sweep_sql(predict, ks):
    listed = ", ".join(f"({k})" for k in ks)
    return f"""WITH {NEIGHBORS_SQL}, ks(k) AS (VALUES {listed}),
    predicted AS (SELECT k, row_key, any_value(actual) AS actual, {predict} AS p
      FROM neighbors JOIN ks ON rank <= k GROUP BY 1, 2)
    SELECT k, round(1 - sum(power(actual - p, 2)) / (var_pop(actual) * count(*)), 6) AS r2,
           round(avg(abs(actual - p)), 6) AS mae, round(sqrt(avg(power(actual - p, 2))), 6) AS rmse
    FROM predicted GROUP BY 1"""


@query("knn_sweep", _sweep_sql(PREDICT, compare.NEIGHBOR_COUNTS))
def knn_sweep(spark, sf_dir):
    _, train, test = splits(spark, sf_dir)
    sweep = compare.knn_sweep(train, test, "row_key", table=TABLE, **BLOCKS)
    return rounded(sweep, 6, "r2", "mae", "rmse")


@query(
    "knn_best_k",
    f"SELECT * FROM ({_sweep_sql(PREDICT, compare.NEIGHBOR_COUNTS)}) ORDER BY r2 DESC, k LIMIT 1",
)
def knn_best_k(spark, sf_dir):
    return evaluate.best_k(knn_sweep(spark, sf_dir))


@query("knn_uniform", _sweep_sql("avg(label)", [5]))
def knn_uniform(spark, sf_dir):
    _, train, test = splits(spark, sf_dir)
    sweep = compare.knn_sweep(train, test, "row_key", [5], "uniform", TABLE, **BLOCKS)
    return rounded(sweep, 6, "r2", "mae", "rmse")
