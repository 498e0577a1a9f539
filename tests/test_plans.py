from __future__ import annotations

import contextlib
import io
from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldpanel.operators import clean, features, neighbors
from fieldpanel.operators.regression import ModelTable
from fieldpanel.plans import compare, preprocess, reports


def physical_plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def raw(spark):
    """Two countries under several spellings, copies, gaps, bad text and an outlier."""
    rng = np.random.default_rng(12)
    yields, rain, pest, temp = [], [], [], []
    for year in range(1990, 2000):
        for mine, rain_name, pest_name, temp_name in [
            ("Viet Nam", " Vietnam ", "viet nam", "VIETNAM"), ("Narnia", "narnia", "Narnia ", "Narnia"),
        ]:
            for crop in ("Maize", "Rice", "Wheat"):
                value = float(rng.integers(100, 200))
                yields += [(mine, year, crop, value, "hg/ha")] * (2 if crop == "Rice" else 1)
            rain.append((rain_name, year, ".." if year == 1995 else str(rng.integers(500, 900))))
            pest.append((pest_name, year, float(rng.integers(1, 50))))
            temp.append((year, temp_name, float(rng.normal(15, 1))))
    yields += [("Narnia", 1990, "Maize", 1e6, "hg/ha"), ("Narnia", 1990, "Maize", None, "hg/ha"),
               ("Elsewhere", 1990, "Maize", 150.0, "hg/ha")]
    return {
        "yield": spark.createDataFrame(
            yields, "Area string, Year int, Item string, Value double, Unit string"
        ),
        "rainfall": spark.createDataFrame(
            rain, "` Area` string, Year int, `average_rain_fall_mm_per_year ` string"
        ),
        "pesticides": spark.createDataFrame(pest, "Area string, Year int, Value double"),
        "temp": spark.createDataFrame(temp, "year int, country string, avg_temp double"),
    }


@pytest.fixture(scope="module")
def exported(spark, raw):
    return preprocess.preprocess(
        raw, relative_error=0.001, processing_date=date(2024, 1, 1)
    ).toPandas()


def test_export_has_the_documented_columns(exported):
    assert list(exported.columns) == [
        *preprocess.PROCESSED, "ID", "Processing_Date", "Processing_Version", "Data_Quality_Score",
    ]
    assert len(exported.columns) == 21


def test_export_rows(exported):
    """2 countries x 9 years with rain x 3 crops; copies, the outlier and strangers are gone."""
    assert len(exported) == 54
    assert set(exported["Country"]) == {"vietnam", "narnia"}
    assert 1995 not in set(exported["Year"]) and exported["Yield"].max() < 1000
    assert exported["ID"].is_unique and set(exported["Data_Quality_Score"]) == {100}


def test_export_values_equal_pandas(exported):
    for c, name in preprocess.NORMALIZED.items():
        v = exported[c]
        assert np.allclose(exported[name], (v - v.min()) / (v.max() - v.min()))
    for c, (name, labels) in preprocess.CATEGORIES.items():
        ordered = np.sort(exported[c])
        low, high = (ordered[int(np.ceil(p * len(ordered))) - 1] for p in features.THIRDS)
        want = np.select([exported[c] <= low, exported[c] <= high], labels[:2], labels[2])
        assert (exported[name] == want).all()
    for c, name in preprocess.INDEXED.items():
        counts = exported[c].value_counts().reset_index().sort_values(
            ["count", c], ascending=[False, True]
        )
        codes = {label: float(i) for i, label in enumerate(counts[c])}
        assert (exported[name] == exported[c].map(codes)).all()


def test_quality_report_of_the_panel(spark, raw):
    report = reports.quality_report(preprocess.integrated_panel(raw)).toPandas()
    found = report.set_index(["section", "column", "metric"])["value"]
    assert found["nulls", "Yield", "nulls"] == 0
    assert found["completeness", "Rainfall", "completeness"] == 1
    assert found["coverage", "Country", "distinct_values"] == 2
    assert found["coverage", "(all)", "row_count"] == 73
    assert found["range", "Yield", "max"] == 1e6


def test_comparison_ranks_all_models(spark):
    rng = np.random.default_rng(3)
    table = pd.DataFrame(
        {
            "Country": rng.choice(["x", "y", "z"], 240),
            "Year": rng.integers(1990, 2010, 240),
            "Crop": rng.choice(["maize", "rice"], 240),
            "Rainfall": rng.normal(800, 100, 240),
            "Pesticides": rng.normal(50, 10, 240),
            "Avg_Temperature": rng.normal(15, 3, 240),
            "n": range(240),
        }
    )
    table["Yield"] = table["Rainfall"] * 2 + np.where(table["Crop"] == "rice", 500, 0) + rng.normal(0, 20, 240)
    found = compare.compare(spark.createDataFrame(table), ["Area", "n"], ModelTable())
    ranking = found["ranking"].toPandas().set_index("model")
    assert len(ranking) == 8 and sorted(ranking["rank"]) == list(range(1, 9))
    assert ranking["error"].isna().all()
    assert ranking.loc["Linear Regression", "band"] == "exceptional"
    assert any(m.startswith("KNN (k=") for m in ranking.index)
    assert compare.best_model(found["ranking"]) == ranking["rank"].idxmin()
    assert found["summary"].first()["total_records"] == 240
    assert {r.feature for r in found["correlations"].collect()} == {
        "average_rain_fall_mm_per_year", "pesticides_tonnes", "avg_temp",
    }


# --- plan shapes -----------------------------------------------------------


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "t")
    spark.range(10_000).select(
        "id", (F.col("id") % 97).cast("double").alias("v"), F.lit("text").alias("wide")
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_filters_and_columns_reach_the_scan(written):
    plan = physical_plan(clean.drop_nulls(written.select("id", "v"), ["v"]))
    assert "PushedFilters: [IsNotNull(v)]" in plan
    assert "ReadSchema: struct<id:bigint,v:double>" in plan


def test_statistics_are_literals_not_joins(written):
    plan = physical_plan(clean.zscore_filter(written, ["v"]))
    assert "Join" not in plan and "Subquery" not in plan and "Exchange" not in plan


def test_small_measures_join_without_moving_the_panel(spark, raw):
    plan = physical_plan(preprocess.integrated_panel(raw))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_copies_are_cut_before_the_shuffle(spark, written):
    """The top-k window keeps k rows per key in each task before rows move."""
    candidates = written.select(
        F.col("v").alias("_query"), F.col("id").alias("_point"), F.col("id").alias("distance")
    )
    plan = physical_plan(neighbors._top_k(candidates, 3))
    assert plan.count("WindowGroupLimit") >= 2


def test_top_totals_is_a_bounded_top_k(written):
    from fieldpanel.operators import profile

    assert "TakeOrderedAndProject" in physical_plan(profile.top_totals(written, "wide", "v", 5))
