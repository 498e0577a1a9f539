from __future__ import annotations

import math
from datetime import date
from decimal import Decimal

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Row, functions as F

from fieldpanel.operators import correlate, profile
from fieldpanel.plans import reports


@pytest.fixture
def holed(spark):
    return spark.createDataFrame(
        [("a", 1, 1.0, 2.0), ("b", 2, None, 4.0), ("a", 3, float("nan"), 6.0), (None, 4, 3.0, -8.0)],
        "s string, n int, x double, `hg/ha` double",
    )


def test_null_and_nan_counts_stay_apart(holed, rows):
    assert rows(profile.null_counts(holed)) == [
        ("hg/ha", 0, 0), ("n", 0, 0), ("s", 1, 0), ("x", 1, 1),
    ]


def test_missing_report_lists_only_columns_with_gaps(holed, rows):
    assert rows(profile.missing_report(holed)) == [("s", 1, 25.0), ("x", 1, 25.0)]


def test_completeness(holed, rows):
    assert rows(profile.completeness(holed, ["n", "x"])) == [
        ("n", 1.0, "COMPLETE"), ("x", 0.75, "INCOMPLETE"),
    ]


def test_coverage_and_counts(spark, rows):
    a = spark.createDataFrame([(1990,), (1992,), (1992,), (None,)], "Year int")
    b = spark.createDataFrame([(2000,)], "Year int")
    assert rows(profile.year_coverage({"a": a, "b": b})) == [
        ("a", 1990, 1992, 2, 4), ("b", 2000, 2000, 1, 1),
    ]
    assert rows(profile.row_counts({"a": a, "b": b})) == [("a", 4), ("b", 1)]


def test_distinct_ignores_null_and_approximation_is_close(spark, holed, rows):
    assert rows(profile.distinct_counts(holed, ["s", "n"])) == [("n", 4), ("s", 2)]
    wide = spark.range(20_000)
    approximate = profile.distinct_counts(wide, ["id"], approximate=True).first()["distinct_values"]
    assert abs(approximate - 20_000) < 2_000


def test_distinct_counts_of_every_type(spark):
    rows = [
        (i % 3 if i else None, float(i % 4) * (-1 if i % 4 == 0 else 1), f"t{i % 5}", bytes([i % 6]),
         Decimal(i % 7), date(2000, 1, 1 + i % 8), [i % 2], Row(a=i % 3, b="x"), i % 2 == 0,
         float("nan") if i % 2 else -0.0 if i % 4 else 0.0)
        for i in range(40)
    ]
    schema = """i int, d double, s string, b binary, n decimal(30,2), day date, l array<int>,
        r struct<a:int,b:string>, t boolean, z double"""
    df = spark.createDataFrame(rows, schema)
    assert profile.distinct_numbers(df, df.columns) == {
        "i": 3, "d": 4, "s": 5, "b": 6, "n": 7, "day": 8, "l": 2, "r": 3, "t": 2, "z": 2,
    }
    assert profile.distinct_numbers(df.limit(0), ["i", "s"]) == {"i": 0, "s": 0}
    assert profile.distinct_numbers(df, []) == {}


def test_hash_clashes_are_settled_by_value(spark, monkeypatch):
    df = spark.range(500).select(
        F.concat(F.lit("v"), F.col("id") % 90).alias("s"), (F.col("id") % 7).alias("n")
    )

    def weak(value, kind):
        return F.length(value.cast("string")).cast("bigint"), F.xxhash64(value)

    monkeypatch.setattr(profile, "_hashed", weak)
    assert profile.distinct_numbers(df, ["s", "n"]) == {"s": 90, "n": 7}


def test_column_profile_expands_nothing(spark, holed):
    for df in (profile.column_profile(holed), reports.quality_report(holed, ["n"], ["s"], ["n"])):
        assert "Expand" not in df._jdf.queryExecution().toString()
    counts = {r["column"]: r.distinct_values for r in profile.column_profile(holed).collect()}
    assert counts["n"] == 4 and counts["s"] == 2


def test_describe_and_ranges(holed):
    row = profile.describe_stats(holed, ["hg/ha"]).first()
    assert (row["count"], row["min"], row["max"]) == (4, -8.0, 6.0)
    assert row["stddev"] == pytest.approx(np.std([2, 4, 6, -8], ddof=1))
    assert profile.negative_checks(holed, ["hg/ha"]).first()["negatives"] == 1
    assert profile.numeric_profile(holed, 1).count() == 1
    assert profile.numeric_profile(holed).count() == len(profile.numeric_columns(holed))


def test_quartiles_match_numpy(spark):
    values = [float(v) for v in np.random.default_rng(1).integers(0, 40, 501)]
    df = spark.createDataFrame([(v, v * 2) for v in values], "a double, b double")
    for row in reports.describe_quartiles(df).collect():
        scale = 1 if row["column"] == "a" else 2
        want = np.percentile(values, [25, 50, 75]) * scale
        assert [row["q25"], row["q50"], row["q75"]] == pytest.approx(list(want))


def test_variance_ratio_is_one_or_unknown(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, flat double")
    found = {r["column"]: r for r in profile.variance_ratio(df, ["a", "flat"]).collect()}
    assert found["a"]["variance_ratio"] == pytest.approx(1.0)
    assert found["flat"]["variance_ratio"] is None


def test_column_profile(holed, rows):
    assert rows(profile.column_profile(holed)) == [
        ("hg/ha", "double", 4, 0), ("n", "int", 4, 0), ("s", "string", 2, 1), ("x", "double", 3, 1),
    ]


def test_categorical_profile_lists_short_columns_only(spark, rows):
    df = spark.createDataFrame([(str(i), "b" if i % 2 else "a") for i in range(20)], ["many", "few"])
    assert rows(profile.categorical_profile(df)) == [("few", 2, "a, b"), ("many", 20, None)]


def test_totals_leave_out_missing_keys(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 9.0), (None, 5.0)], "k string, v double")
    assert rows(profile.total_by(df, "k", "v")) == [("a", 3.0), ("b", 9.0)]
    assert rows(profile.count_by(df, "k")) == [("a", 2), ("b", 1)]
    assert [r.k for r in profile.top_totals(df, "k", "v", 1).collect()] == ["b"]


def test_random_sample_is_seeded(spark, rows):
    df = spark.range(1000).coalesce(1)
    first, again = (rows(profile.random_sample(df, 10, seed=3)) for _ in range(2))
    assert first == again and len(first) == 10


def test_quality_and_dataset_summaries(spark, rows):
    df = spark.createDataFrame(
        [("x", 1990, "maize", 1.0), ("x", 1991, "rice", 3.0)],
        "Country string, Year int, Crop string, Yield double",
    )
    assert rows(profile.quality_metrics(df)) == [(2, 2, 1, 2)]
    summary = profile.dataset_summary(df, "Country", "Crop", target="Yield")
    assert rows(summary) == [(2, 1, 2, 2, 1990, 1991, 2.0, 1.0, 3.0)]


# --- correlation -----------------------------------------------------------


@pytest.fixture
def measured(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=200)
    table = np.column_stack([x, 2 * x + rng.normal(size=200), rng.normal(size=200) * 1e6 + 1e9])
    return spark.createDataFrame([tuple(map(float, r)) for r in table], ["y", "a", "b"])


def test_matrix_equals_the_library_one(measured):
    columns = ["y", "a", "b"]
    vector = VectorAssembler(inputCols=columns, outputCol="v").transform(measured)
    want = Correlation.corr(vector, "v").head()[0].toArray()
    for row in correlate.correlation_matrix(measured, columns).collect():
        i, j = columns.index(row.col_i), columns.index(row.col_j)
        assert row.corr == pytest.approx(want[i, j], abs=1e-9)
    got = correlate.correlation_matrix(measured)
    assert got.count() == 9
    assert got.filter("col_i = col_j and abs(corr - 1) > 1e-12").count() == 0


def test_gaps_are_dropped_pair_by_pair(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, None), (2.0, 4.1, 1.0), (3.0, 5.9, 0.0), (4.0, None, 5.0), (5.0, 9.7, 2.0)],
        "a double, b double, c double",
    )
    want = df.toPandas().corr()
    for row in correlate.correlation_matrix(df).collect():
        assert row.corr == pytest.approx(want.loc[row.col_i, row.col_j])


def test_constant_and_empty_columns_have_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, None)], "a double, flat double, e double")
    found = {(r.col_i, r.col_j): r.corr for r in correlate.correlation_matrix(df).collect()}
    assert found["a", "flat"] is None and found["a", "e"] is None and found["a", "a"] == 1.0


def test_ranking_thresholds_are_strict(spark, rows):
    found = spark.createDataFrame(
        [("e", None), ("a", 0.3), ("b", -0.1), ("c", 0.05), ("d", -0.31), ("f", 0.0)],
        "feature string, corr double",
    )
    ranking = correlate.rank_correlations(found)
    assert rows(ranking, "rank", "feature", "strength", "direction") == [
        (1, "d", "Strong", "negative"), (2, "a", "Moderate", "positive"),
        (3, "b", "Weak", "negative"), (4, "c", "Very weak", "positive"),
        (5, "f", "Very weak", "negative"), (6, "e", None, "negative"),
    ]
    assert rows(correlate.select_features(ranking, "y"), "feature") == [("a",), ("d",), ("y",)]
    assert rows(correlate.strongest_feature(ranking)) == [("d", -0.31, True, False)]
    assert rows(correlate.weak_environment(ranking, ["c", "f"])) == [(True,)]
    assert rows(correlate.weak_environment(ranking, ["b", "f"])) == [(False,)]


def test_target_correlations_agree_with_the_matrix(measured):
    direct = {r.feature: r.corr for r in correlate.target_correlations(measured, "y", ["a", "b"]).collect()}
    matrix = correlate.correlation_matrix(measured).filter("col_i = 'y'").collect()
    for row in matrix:
        if row.col_j != "y":
            assert math.isclose(row.corr, direct[row.col_j], abs_tol=1e-9)


def test_profile_report_of_a_flexible_table(spark, rows):
    df = spark.createDataFrame(
        [("x", 1990, 1.0), ("y", 1991, None)], "Country_Name string, season_year int, yield_kg double"
    )
    found = {(r.section, r.column, r.metric): (r.value, r.text)
             for r in reports.flexible_profile(df).collect()}
    assert found["size", "(all)", "row_count"] == (2.0, None)
    assert found["size", "(all)", "column_count"] == (3.0, None)
    assert found["missing", "yield", "missing"] == (1.0, None)
    assert found["categorical", "area", "distinct_values"] == (2.0, "x, y")
    assert found["numeric", "year", "max"] == (1991.0, None)


def test_flexible_export(spark, tmp_path):
    df = spark.createDataFrame([("x", 1990, 1.0)], "Country string, Year int, Yield double")
    reports.flexible_export(df, str(tmp_path), ["year"], "yield_df")
    assert spark.read.parquet(str(tmp_path / "processed/prepared_data.parquet")).columns == [
        "year", "area", "yield",
    ]
    assert spark.read.json(str(tmp_path / "results/data_report.json")).count() == 3
    assert spark.read.csv(str(tmp_path / "results/data_sample.csv"), header=True).count() == 1


def test_explore_parts(spark):
    df = spark.createDataFrame(
        [(0, 1990, 1.0, 2.0, 3.0, "x", "maize", 10.0), (1, 1991, 1.5, 2.5, 3.5, "y", "maize", 20.0),
         (1, 1991, 1.5, 2.5, 3.5, "y", "maize", 20.0)],
        "_c0 int, Year int, average_rain_fall_mm_per_year double, pesticides_tonnes double, "
        "avg_temp double, Area string, Item string, `hg/ha_yield` double",
    )
    found = reports.explore(df)
    assert found["info"].count() == 7 and found["info"].first()["row_count"] == 2
    assert [tuple(r) for r in found["total_by_item"].collect()] == [("maize", 30.0)]
    assert found["count_by_area"].agg(F.sum("row_count")).first()[0] == 2
