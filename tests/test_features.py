from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from fieldpanel.operators import evaluate, features, ordering, quantiles
from pyspark.ml.evaluation import RegressionEvaluator


@pytest.mark.parametrize("limit", [0, 10_000])
def test_positions_over_ranges_equal_one_sort(spark, limit):
    df = spark.range(2000).select(F.md5(F.col("id").cast("string")).alias("k"))
    found = ordering.positions(df, [F.asc("k")], "at", max_single_sort_rows=limit).collect()
    ordered = sorted(r.k for r in found)
    assert {r.k: r["at"] for r in found} == {k: i for i, k in enumerate(ordered)}


@pytest.mark.parametrize("limit", [0, 10_000])
def test_running_total_restarts_per_group(spark, limit):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"), "id", (F.col("id") % 5).alias("w")
    )
    found = ordering.running_total(
        df, [F.asc("id")], F.col("w"), "upto", ["g"], max_single_sort_rows=limit
    )
    pdf = found.toPandas().sort_values(["g", "id"])
    want = pdf.groupby("g")["w"].cumsum()
    assert (pdf["upto"] == want).all() and len(pdf) == 1000


def test_minmax_stays_in_range_and_handles_constants(spark, rows):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0), (2.0, None)], "v double, c double")
    out = features.minmax_normalize(df, {"v": "vn", "c": "cn"})
    assert rows(out, "vn", "cn") == [(None, 0.0), (0.0, 0.0), (0.5, None), (1.0, 0.0)]


def test_minmax_of_an_empty_column(spark, rows):
    df = spark.createDataFrame([(None,)], "v double")
    assert rows(features.minmax_normalize(df, {"v": "n"}), "n") == [(None,)]


def test_standard_scale_uses_population_deviation_of_the_fitted_rows(spark):
    train = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (4.0, 7.0)], "v double, c double")
    test = spark.createDataFrame([(3.0, 9.0)], "v double, c double")
    out = features.standard_scale(test, {"v": "vs", "c": "cs"}, fit_on=train).first()
    assert out.vs == pytest.approx((3 - 7 / 3) / np.std([1, 2, 4]))
    assert out.cs == 2.0


def test_string_index_equals_the_library_one(spark, rows):
    df = spark.createDataFrame([(c,) for c in "bbaaccccdz"], ["s"])
    want = StringIndexer(inputCol="s", outputCol="i").fit(df).transform(df)
    assert rows(features.string_index(df, "s", "i")) == rows(want)


def test_weighted_frequency_index(spark, rows):
    counts = spark.createDataFrame([("a", 1), ("b", 5), ("a", 2)], ["s", "n"])
    assert rows(features.frequency_index(counts, "s", "i", weight="n")) == [("a", 1.0), ("b", 0.0)]


def test_unknown_labels(spark, rows):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], ["s"])
    test = spark.createDataFrame([("b",), ("q",), (None,)], "s string")
    codes = features.frequency_index(train, "s", "i")
    assert rows(features.apply_codes(test, codes, "skip")) == [("b", 1.0)]
    assert rows(features.apply_codes(test, codes, "keep")) == [(None, 2.0), ("b", 1.0), ("q", 2.0)]
    with pytest.raises(Exception, match="no code for s"):
        features.apply_codes(test, codes).collect()
    with pytest.raises(ValueError, match="invalid"):
        features.apply_codes(test, codes, "ignore")


def test_label_encode_covers_both_tables(spark, rows):
    train = spark.createDataFrame([("b",), (None,)], "s string")
    test = spark.createDataFrame([("z",), ("a",)], "s string")
    train, test = features.label_encode(train, test, "s", "c")
    assert rows(train) == [("Unknown", 0), ("b", 2)]
    assert rows(test) == [("a", 1), ("z", 3)]


def test_onehot_drops_the_first_category(spark, rows):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c")], ["n", "s"])
    assert rows(features.onehot_drop_first(df, "s", ["n"])) == [
        (1, 0, "b", 1.0), (2, None, "a", 0.0), (3, 1, "c", 1.0),
    ]


def test_max_bins(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("Area"), F.lit("m").alias("Item"))
    assert features.max_bins(df, ["Area", "Item"]).first()["max_bins"] == 101
    assert features.max_bins(df, ["Item"]).first()["max_bins"] == 64


def test_exact_cuts_are_ranked_data_values(spark):
    rng = np.random.default_rng(3)
    values = [float(v) for v in rng.integers(0, 25, 997)]
    df = spark.createDataFrame([(v, -v) for v in values] + [(None, None)], "a double, b double")
    cuts = features.quantile_cuts(df, ["a", "b"], relative_error=0).collect()
    assert len(cuts) == 4
    for row in cuts:
        ordered = sorted(values if row["column"] == "a" else [-v for v in values])
        assert row.cut == ordered[int(np.ceil(row.probability * len(ordered))) - 1]


def odd_values():
    rng = np.random.default_rng(17)
    inf = np.inf
    return {
        "heavy": rng.standard_cauchy(700) ** 3,
        "tiny": np.concatenate([rng.random(300) * 5e-322, [0.0, -0.0, 5e-324, -5e-324]]),
        "huge": np.concatenate([rng.normal(size=200) * 1e308, [1.7e308, -1.7e308]]),
        "ends": np.concatenate([[inf] * 40, [-inf] * 30, rng.normal(size=50), [0.0]]),
        "powers": np.concatenate([10.0 ** rng.integers(-300, 300, 400), -(10.0 ** rng.integers(-300, 300, 90))]),
        "near": 1e15 + rng.integers(0, 9, 500) / 8,
        "one": np.full(100, 3.25),
        "mostly": np.concatenate([np.zeros(900), rng.lognormal(0, 30, 60)]),
        "nan": np.concatenate([rng.normal(size=60), [np.nan] * 60]),
    }


def test_values_at_every_rank_of_odd_columns(spark):
    columns = odd_values()
    longest = max(map(len, columns.values()))
    rows = [
        tuple(float(v[i]) if i < len(v) else None for v in columns.values()) + (None,)
        for i in range(longest)
    ]
    schema = ", ".join(f"{c} double" for c in [*columns, "none"])
    df = spark.createDataFrame(rows, schema).repartition(5)
    ranks = lambda n: sorted({1, 2, n // 3 + 1, n // 2 + 1, n - 1, n})
    found = quantiles.values_at_ranks(df, [*columns, "none"], ranks)
    assert set(found) == set(columns)
    for name, values in columns.items():
        ordered = np.sort(values)  # NaN last
        n, got = found[name]
        assert n == len(values)
        assert np.array_equal(got, [ordered[r - 1] for r in ranks(n)], equal_nan=True), name


def test_exact_quantiles_take_few_rounds_and_no_sort(spark, monkeypatch):
    df = spark.range(200_000).select((F.pow(F.col("id"), 3) % 1_000_003).cast("double").alias("v"))
    passes = []
    real = quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", lambda *a: passes.append(a[0]) or real(*a))
    n, [median] = quantiles.values_at_ranks(df, ["v"], lambda n: [n // 2])["v"]
    values = sorted(r.v for r in df.collect())
    assert median == values[n // 2 - 1] and len(passes) <= 3


def test_sketched_cuts_are_within_the_error(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("v"))
    for row in features.quantile_cuts(df, ["v"], relative_error=0.01).collect():
        assert abs(row.cut / 10_000 - row.probability) <= 0.011


def test_discretize_includes_the_upper_edge(spark, rows):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)] + [(None,)], "v double")
    out = features.discretize(df, {"v": ("c", features.TEMPERATURE_LABELS)}, relative_error=0.0001)
    found = {r.v: r.c for r in out.collect()}
    assert (found[33.0], found[34.0], found[66.0], found[67.0]) == ("Cold", "Temperate", "Temperate", "Hot")
    assert found[None] is None


def test_imputation(spark, rows):
    train = spark.createDataFrame([(1.0,), (3.0,), (None,), (float("nan"),)], "v double")
    test = spark.createDataFrame([(None,), (9.0,)], "v double")
    assert rows(features.mean_impute(test, ["v"], fit_on=train)) == [(2.0,), (9.0,)]
    assert rows(features.mean_impute(train, ["v"])) == [(1.0,), (2.0,), (2.0,), (3.0,)]
    filled, own = features.label_impute(train, test, "v")
    assert rows(own) == [(9.0,), (9.0,)] and filled.filter("v = 2.0").count() == 2


def test_hash_split_is_whole_disjoint_and_repeatable(spark, rows):
    df = spark.range(5000)
    train, test = features.hash_split(df, ["id"])
    again, _ = features.hash_split(df.repartition(17), ["id"])
    assert train.count() + test.count() == 5000
    assert train.intersect(test).count() == 0
    assert rows(train) == rows(again)
    assert abs(train.count() / 5000 - 0.8) < 0.03


def test_random_split(spark):
    train, test = features.random_split(spark.range(1000))
    assert train.count() + test.count() == 1000


# --- metrics ---------------------------------------------------------------


@pytest.fixture
def scored(spark):
    rng = np.random.default_rng(2)
    y = rng.normal(size=300)
    table = [(float(a), float(a + e), "g" if a > 0 else "h") for a, e in zip(y, rng.normal(size=300) / 3)]
    return spark.createDataFrame(table, ["label", "prediction", "g"])


def test_metrics_equal_the_evaluator(scored):
    row = evaluate.regression_metrics(scored, "label", "prediction").first()
    for metric in ("r2", "mae", "rmse"):
        want = RegressionEvaluator(labelCol="label", metricName=metric).evaluate(scored)
        assert row[metric] == pytest.approx(want)
    assert evaluate.regression_metrics(scored, "label", "prediction", ["g"]).count() == 2


def test_mean_predictor_has_no_skill(scored):
    mean = scored.agg(F.mean("label")).first()[0]
    flat = scored.withColumn("prediction", F.lit(mean))
    assert evaluate.regression_metrics(flat, "label", "prediction").first()["r2"] == pytest.approx(0)


def test_many_models_in_one_pass(scored):
    both = scored.withColumn("second", F.col("prediction") + 1)
    found = {r.model: r for r in evaluate.metrics_of_many(
        both, "label", {"a": "prediction", "b": "second"}).collect()}
    single = evaluate.regression_metrics(scored, "label", "prediction").first()
    assert found["a"].r2 == pytest.approx(single.r2)
    assert found["b"].mae > found["a"].mae


def test_leaderboard_band_and_relative_errors(spark, rows):
    metrics = spark.createDataFrame(
        [("a", 0.9, 1.0, 2.0), ("b", 0.95, 1.0, 2.0), ("c", None, None, None), ("d", 0.3, 4.0, 5.0)],
        "model string, r2 double, mae double, rmse double",
    )
    ranked = evaluate.performance_band(evaluate.leaderboard(metrics))
    assert rows(ranked, "rank", "model", "band") == [
        (1, "b", "exceptional"), (2, "a", "excellent"), (3, "d", "poor"), (4, "c", None),
    ]
    relative = evaluate.relative_errors(metrics.filter("model = 'a'"), F.lit(4.0))
    assert rows(relative, "mae_pct", "rmse_pct") == [(25.0, 50.0)]


def test_best_k_prefers_the_smaller_on_ties(spark):
    sweep = spark.createDataFrame([(3, 0.5), (5, 0.7), (7, 0.7)], ["k", "r2"])
    assert evaluate.best_k(sweep).first()["k"] == 5
