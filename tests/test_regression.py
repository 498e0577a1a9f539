from __future__ import annotations

import threading
from functools import partial

import numpy as np
import pytest
from pyspark.ml.base import Estimator
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from fieldpanel.operators import features, linear, regression
from fieldpanel.operators.linear import MomentRegression
from fieldpanel.operators.regression import ModelTable
from fieldpanel.plans import compare
from fieldpanel.sources import sinks

TABLE = ModelTable(categorical=["Area"], numeric=["a", "b"], target="hg/ha_yield")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    effect = {"x": 0.0, "y": 5.0, "z": -3.0}
    table = []
    for i in range(400):
        area = "xyz"[i % 3]
        a, b = rng.normal(), rng.normal() * 10
        table.append((i, area, float(a), float(b), float(3 * a - 0.5 * b + effect[area] + rng.normal() / 4)))
    df = spark.createDataFrame(table, "id bigint, Area string, a double, b double, `hg/ha_yield` double")
    train, test = features.hash_split(df, ["id"])
    return train.cache(), test.cache()


@pytest.fixture(scope="module")
def onehot(data):
    return regression.prepare(*data, regression.onehot_features(TABLE), TABLE)


@pytest.fixture(scope="module")
def scaled(data):
    rows = data[0].count()
    return regression.prepare(*data, regression.scaled_features(TABLE, rows), TABLE)


def design(prepared):
    pdf = prepared.train.toPandas()
    return np.array([v.toArray() for v in pdf["features"]]), pdf["hg/ha_yield"].to_numpy()


def test_scaled_features_have_population_deviation_and_drop_the_first_label(scaled):
    x, _ = design(scaled)
    assert x.shape[1] == 4  # two numbers, areas y and z
    assert np.allclose(x[:, :2].mean(axis=0), 0) and np.allclose(x[:, :2].std(axis=0), 1)
    names = regression.slot_names(scaled.train)
    assert [n for n in names if "Vec" in n] == ["AreaVec_z", "AreaVec_y"]


def test_label_seen_in_the_test_split_only_has_zero_in_all_slots(data):
    train, test = data
    odd = test.limit(2).withColumn("Area", F.lit("unseen"))
    missing = test.limit(1).withColumn("Area", F.lit(None).cast("string"))
    features_of = regression.scaled_features(TABLE, train.count())
    prepared = regression.prepare(train, odd.unionByName(missing), features_of, TABLE)
    vectors = [r.features.toArray() for r in prepared.test.collect()]
    assert len(vectors) == 3 and all((v[2:] == 0).all() and len(v) == 4 for v in vectors)


def test_a_single_label_becomes_a_zero_slot(data):
    train = data[0].withColumn("Area", F.lit("x"))
    features_of = regression.scaled_features(TABLE, train.count())
    prepared = regression.prepare(train, train, features_of, TABLE)
    assert all(r.features.toArray()[2:].sum() == 0 for r in prepared.test.collect())


def test_ols_equals_the_normal_equations(scaled):
    x, y = design(scaled)
    registry = regression.scaled_models(TABLE.target, len(y))
    model = regression.regressor(regression.fit_model(scaled, registry["Linear Regression"]()))
    want = np.linalg.lstsq(np.column_stack([x, np.ones(len(x))]), y, rcond=None)[0]
    assert np.allclose([*model.coefficients.toArray(), model.intercept], want, atol=1e-6)


def test_ridge_alpha_one_equals_the_closed_form(scaled):
    x, y = design(scaled)
    registry = regression.scaled_models(TABLE.target, len(y))
    model = regression.regressor(regression.fit_model(scaled, registry["Ridge"]()))
    xc, yc = x - x.mean(axis=0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + np.eye(x.shape[1]), xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), want, atol=1e-3)


def test_lasso_alpha_one_equals_coordinate_descent(scaled):
    x, y = design(scaled)
    registry = regression.scaled_models(TABLE.target, len(y))
    model = regression.regressor(regression.fit_model(scaled, registry["Lasso"]()))
    xc, yc = x - x.mean(axis=0), y - y.mean()
    w = np.zeros(x.shape[1])
    for _ in range(2000):
        for j in range(len(w)):
            rest = yc - xc @ w + xc[:, j] * w[j]
            rho = xc[:, j] @ rest / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - 1.0, 0) / (xc[:, j] @ xc[:, j] / len(y))
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-3)


def test_registered_parameters():
    models = {n: make() for n, make in regression.onehot_models("y", 101).items()}
    shown = {
        n: (w.getRegParam(), w.getElasticNetParam(), w.getMaxIter())
        for n, m in models.items() if isinstance(m, MomentRegression) for w in [m.wide()]
    }
    assert shown == {
        "Linear Regression": (0.01, 0.0, 100), "Ridge Regression": (0.1, 0.0, 100),
        "Lasso Regression": (0.01, 1.0, 100), "Elastic Net": (0.05, 0.5, 100),
    }
    assert models["Decision Tree"].getMaxDepth() == 10
    assert models["Random Forest"].getNumTrees() == 50
    assert (models["Gradient Boosting"].getMaxIter(), models["Gradient Boosting"].getMaxDepth()) == (50, 6)
    assert {m.getMaxBins() for n, m in models.items() if hasattr(m, "getMaxBins")} == {101}


LINEAR = ["Linear Regression", "Ridge Regression", "Lasso Regression", "Elastic Net"]


@pytest.mark.parametrize("name", LINEAR)
def test_moments_give_what_spark_finds(onehot, name):
    estimator = regression.onehot_models(TABLE.target)[name]()
    want = LinearRegression(
        labelCol=TABLE.target, regParam=estimator.wide().getRegParam(), tol=1e-12, maxIter=2000,
        elasticNetParam=estimator.wide().getElasticNetParam(),
    ).fit(onehot.train)
    got = regression.regressor(regression.fit_model(onehot, estimator))
    assert np.allclose(got.coefficients.toArray(), want.coefficients.toArray(), atol=2e-6)
    assert got.intercept == pytest.approx(want.intercept, abs=2e-6)


def test_all_linear_models_read_the_data_once(data, monkeypatch):
    prepared = regression.prepare(*data, regression.onehot_features(TABLE), TABLE)
    passes = []
    real = regression.moments
    monkeypatch.setattr(regression, "moments", lambda *a: passes.append(a) or real(*a))
    registry = regression.onehot_models(TABLE.target)
    fitted, failed = regression.fit_all(prepared, {n: registry[n] for n in LINEAR})
    assert len(fitted) == 4 and not failed and len(passes) == 1


@pytest.mark.parametrize("name", ["Linear Regression", "Lasso", "Ridge"])
def test_wide_models_agree_with_moments(scaled, monkeypatch, name):
    make = regression.scaled_models(TABLE.target, scaled.train.count())[name]
    got = regression.regressor(regression.fit_model(scaled, make()))
    monkeypatch.setattr(linear, "MAX_WIDTH", 3)
    want = regression.regressor(regression.fit_model(scaled, make()))
    assert np.allclose(got.coefficients.toArray(), want.coefficients.toArray(), atol=2e-3)


def test_moments_of_odd_columns(spark):
    """Equal columns, a constant one, and a constant label."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=200) + 1e4
    rows = [(Vectors.dense([v, v, 7.0]), float(2 * v + 1), 5.0) for v in x]
    df = spark.createDataFrame(rows, ["features", "y", "flat"])
    known = linear.moments(df, "y")
    found, intercept = linear.solve(known, linear.Penalty())
    assert found[2] == 0 and found[0] + found[1] == pytest.approx(2, abs=1e-6)
    assert 1e4 * found.sum() + intercept == pytest.approx(2e4 + 1, abs=1e-3)
    for penalty in (linear.Penalty(), linear.Penalty(l1=0.1), linear.Penalty(l2=0.1)):
        found, intercept = linear.solve(linear.moments(df, "flat"), penalty)
        assert not found.any() and intercept == pytest.approx(5)
    with pytest.raises(ValueError, match="no training rows"):
        linear.moments(df.limit(0), "y")


def test_models_from_moments_are_saved_and_loaded(data, onehot, tmp_path, rows):
    make = regression.onehot_models(TABLE.target)["Elastic Net"]
    model = regression.fit_model(onehot, make())
    sinks.save_model(model, str(tmp_path / "linear"))
    loaded = sinks.load_model(str(tmp_path / "linear"))
    want = rows(regression.batch_score(model, data[1]), "id", "prediction")
    assert rows(regression.batch_score(loaded, data[1]), "id", "prediction") == want
    alone = make().fit(onehot.train)  # without shared moments
    assert np.allclose(alone.coefficients, regression.regressor(model).coefficients)


def test_unseen_categories_are_scored(spark, data, onehot):
    model = regression.fit_model(onehot, LinearRegression(labelCol=TABLE.target))
    request = spark.createDataFrame([("nowhere", 0.0, 0.0)], "Area string, a double, b double")
    scored = regression.batch_score(model, request)
    assert scored.columns == ["Area", "a", "b", "prediction"] and scored.first()["prediction"] is not None


def test_comparison_records_failures(onehot):
    registry = {
        "good": lambda: LinearRegression(labelCol=TABLE.target),
        "bad": lambda: LinearRegression(labelCol="no such column"),
    }
    found = {r.model: r for r in regression.compare_models(onehot, registry).collect()}
    assert found["good"].r2 > 0.95 and found["good"].error is None
    assert found["bad"].r2 is None and "no such column" in found["bad"].error


def test_coefficients_and_importances_follow_slot_names(onehot):
    registry = regression.onehot_models(TABLE.target)
    linear = regression.fit_model(onehot, registry["Linear Regression"]())
    found = {r["name"]: r for r in regression.coefficients(linear, onehot, TABLE).collect()}
    assert found["a"].coefficient == pytest.approx(3, abs=0.1) and found["a"].direction == "increases"
    assert found["b"].magnitude == pytest.approx(0.5, abs=0.1) and found["b"].direction == "decreases"
    assert found["AreaVec_y"].feature == "Area"
    tree = {"tree": regression.fit_model(onehot, registry["Decision Tree"]())}
    ranked = regression.feature_importance(tree, onehot, TABLE).orderBy("rank").collect()
    assert sum(r.importance for r in ranked) == pytest.approx(1)
    assert {r.feature for r in ranked} == {"Area", "a", "b"} and ranked[0].feature == "b"
    shape = regression.tree_shape(tree, onehot.train.sparkSession).first()
    assert shape.depth <= 10 and shape.nodes > 3


@pytest.mark.parametrize("name", ["Decision Tree", "Gradient Boosting"])
def test_splits_tell_the_whole_tree(onehot, name):
    model = regression.fit_model(onehot, regression.onehot_models(TABLE.target)[name]())
    nodes = regression.tree_splits({name: model}, onehot, TABLE).collect()
    rows = onehot.train.count()
    trees = {n.tree for n in nodes}
    assert len(trees) == (1 if name == "Decision Tree" else 50)
    for tree in trees:
        mine = {n.node: n for n in nodes if n.tree == tree}
        leaves = [n for n in mine.values() if n.name is None]
        assert mine[0].rows == rows == sum(n.rows for n in leaves)
        assert len(leaves) == (len(mine) + 1) // 2
        for n in mine.values():
            if n.name is not None:
                assert n.rows == mine[n.low].rows + mine[n.high].rows and n.gain > 0
                assert (n.threshold is None) == n.name.startswith("AreaVec_") == (n["values"] is not None)
                assert n.feature in {"Area", "a", "b"}
    if name == "Decision Tree":
        shape = regression.tree_shape({name: model}, onehot.train.sparkSession).first()
        assert shape.nodes == len(nodes)
        # following the nodes gives the prediction
        names = regression.slot_names(onehot.train)
        for row in regression.regressor(model).transform(onehot.train.limit(20)).collect():
            at = mine[0]
            while at.name is not None:
                value = row.features[names.index(at.name)]
                low = value <= at.threshold if at["values"] is None else value in at["values"]
                at = mine[at.low if low else at.high]
            assert at.prediction == pytest.approx(row.prediction)


def test_saved_pipeline_scores_alike(data, onehot, tmp_path, rows):
    model = regression.fit_model(onehot, regression.onehot_models(TABLE.target)["Decision Tree"]())
    sinks.save_model(model, str(tmp_path / "m"))
    loaded = sinks.load_model(str(tmp_path / "m"))
    _, test = data
    want = rows(regression.batch_score(model, test), "id", "prediction")
    assert rows(regression.batch_score(loaded, test), "id", "prediction") == want


def test_too_many_categories_are_refused(spark):
    df = spark.range(500).withColumn("c", F.col("id").cast("string"))
    with pytest.raises(ValueError, match="categories"):
        regression.check_categories(df, ["c"], most=100)


def test_wide_categories_are_hashed(spark):
    rng = np.random.default_rng(3)
    rows = [
        (i, f"place {i % 700}", "xyz"[i % 3], float(rng.normal()), float(i % 700 % 5 + 3 * (i % 3)))
        for i in range(2800)
    ]
    schema = "id bigint, Area string, Item string, a double, `hg/ha_yield` double"
    df = spark.createDataFrame(rows, schema)
    table = ModelTable(categorical=["Area", "Item"], numeric=["a"], target="hg/ha_yield")
    train, test = features.hash_split(df, ["id"])
    odd = test.limit(1).withColumn("Area", F.lit(None).cast("string"))
    test = test.unionByName(odd).unionByName(odd.withColumn("Area", F.lit("unseen")))
    assert regression.wide_categories(train, table.categorical, most=100) == ["Area"]
    assert regression.tree_bins(train, table, most=100) == 64
    for features_of in (regression.onehot_features, partial(regression.scaled_features, train_rows=9)):
        made = partial(features_of, table, slots=4096)
        prepared = regression.prepare(train, test, made, table, most=100)
        names = regression.slot_names(prepared.train)
        hashed = [n for n in names if n.startswith("AreaVec_")]
        assert len(hashed) == 4096 and regression.logical_feature(hashed[7], table) == "Area"
        estimator = regression.onehot_models(table.target)["Ridge Regression"]()
        model = regression.fit_model(prepared, estimator)
        metrics = regression.evaluate_all(prepared, {"ridge": model}).first()
        assert metrics.r2 > 0.8  # what a label says survives in its slot
        assert prepared.test.count() == test.count()
        # the labels are nowhere in the pipeline
        assert not any("Area" in str(s.labelsArray) for s in prepared.encoder.stages
                       if hasattr(s, "labelsArray"))


def test_collisions_are_measured(spark):
    df = spark.range(5000).select(
        F.concat(F.lit("label "), F.col("id") % 1000).alias("c"),
        F.when(F.col("id") % 2 == 0, "even").alias("d"),
    )
    found = {r["column"]: r for r in regression.hash_collisions(df, ["c", "d"], 512).collect()}
    c, d = found["c"], found["d"]
    assert c.labels == 1000 and c.slots_used < 512 and c.collision_rate == c.colliding / 1000
    assert 1000 - c.colliding < c.slots_used <= 1000 - c.colliding / 2
    assert (d.labels, d.slots_used, d.colliding, d.collision_rate) == (1, 1, 0, 0.0)
    wide = regression.hash_collisions(df, ["c"], 1 << 18).first()
    assert wide.collision_rate < 0.02


def test_fits_run_side_by_side_and_apart(onehot):
    barrier = threading.Barrier(3, timeout=60)

    class Waiting(Estimator):
        """Ends only while two others are being fitted as well."""

        def __init__(self, fails):
            super().__init__()
            self.fails = fails

        def _fit(self, dataset):
            barrier.wait()
            if self.fails:
                raise ValueError("no such model")
            return LinearRegression(labelCol=TABLE.target).fit(dataset)

    registry = {n: partial(Waiting, n == "b") for n in "abc"}
    fitted, failed = regression.fit_all(onehot, registry, at_once=3)
    assert list(fitted) == ["a", "c"] and failed == {"b": "ValueError: no such model"}
    one_by_one, _ = regression.fit_all(
        onehot, {n: regression.onehot_models(TABLE.target)[n] for n in LINEAR}, at_once=1
    )
    side, _ = regression.fit_all(onehot, {n: regression.onehot_models(TABLE.target)[n] for n in LINEAR})
    for name in LINEAR:
        got, want = (regression.regressor(m[name]).coefficients for m in (side, one_by_one))
        assert np.allclose(got, want)


def test_neighbor_sweep_finds_structure(spark, data):
    train, test = (d.withColumn("row", F.col("id").cast("string")) for d in data)
    sweep = compare.knn_sweep(train, test, "row", ks=[3, 5], table=TABLE, block_rows=40)
    found = {r["k"]: r.r2 for r in sweep.collect()}
    assert set(found) == {3, 5} and all(r2 > 0.7 for r2 in found.values())
