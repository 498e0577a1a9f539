from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldpanel.functions.country_aliases import COUNTRY_ALIASES
from fieldpanel.operators import integrate, joins, keys


def test_every_alias_maps_to_its_standard_name(spark):
    names = spark.createDataFrame([(a, c) for a, c in COUNTRY_ALIASES.items()], ["Country", "want"])
    fixed = keys.standardize_keys(names.withColumn("Country", F.upper("Country")))
    assert fixed.filter("Country <> want").count() == 0
    assert len(COUNTRY_ALIASES) == 49 and len(set(COUNTRY_ALIASES.values())) == 39


def test_names_are_trimmed_lowered_or_passed_through(spark, rows):
    raw = spark.createDataFrame(
        [(1, "Côte D'Ivoire"), (2, " Viet Nam "), (3, "USSR"), (4, "Russian Federation"),
         (5, "South Korea "), (6, "Narnia"), (7, None), (8, "ivory coast")],
        ["n", "Country"],
    )
    assert rows(keys.standardize_keys(raw), "n", "Country") == [
        (1, "ivory coast"), (2, "vietnam"), (3, "russia"), (4, "russia"), (5, "south korea"),
        (6, "narnia"), (7, None), (8, "ivory coast"),
    ]


def test_rules_apply_once(spark, rows):
    df = spark.createDataFrame([("a",)], ["Country"])
    assert rows(keys.standardize_keys(df, aliases={"a": "b", "b": "c"})) == [("b",)]


@pytest.fixture
def four(spark):
    def table(*names):
        return spark.createDataFrame([(n,) for n in names], "Country string")

    return {
        "rainfall": table("x", "y", "z", "x", None),
        "pesticides": table("x", "y", "w"),
        "yield": table("x", "y", "z"),
        "temp": table("x", "z", None),
    }


def test_shared_keys(four, rows):
    assert rows(keys.common_keys(four, "Country")) == [("x",)]
    assert rows(keys.keys_in_at_least(four, "Country", 3)) == [("x", 4), ("y", 3), ("z", 3)]
    assert rows(keys.key_counts(four, "Country")) == [
        ("(common)", 1), ("pesticides", 3), ("rainfall", 3), ("temp", 2), ("yield", 3),
    ]


def test_audit(spark, rows):
    tables = {
        "a": spark.createDataFrame([("USSR",), ("Russian Federation",)], ["Country"]),
        "b": spark.createDataFrame([("Russia ",)], ["Country"]),
    }
    assert rows(keys.standardize_audit(tables)) == [("(common)", 0, 1), ("a", 2, 1), ("b", 1, 1)]


def test_presence_over_a_hundred_tables(spark):
    """Table i holds the keys 'all', its own number and, if even, 'even'."""
    tables = {
        f"t{i}": spark.createDataFrame(
            [("all",), (str(i),)] + ([("even",)] if i % 2 == 0 else []), ["c"]
        ).coalesce(1)
        for i in range(100)
    }
    counts = {r.dataset: r.n_keys for r in keys.key_counts(tables, "c").collect()}
    assert counts == {"(common)": 1} | {f"t{i}": 2 + (i % 2 == 0) for i in range(100)}
    found = {r.key: r.n_datasets for r in keys.keys_in_at_least(tables, "c", 2).collect()}
    assert found == {"all": 100, "even": 50}
    assert [r.key for r in keys.common_keys(tables, "c").collect()] == ["all"]


def test_duplicates(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, 1)], "a int, b int")
    assert rows(keys.duplicate_count(df)) == [(4, 2, 2)]
    assert rows(keys.duplicate_count(df.limit(0))) == [(0, 0, 0)]


def test_sorted_distinct(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], ["v"])
    assert [r.v for r in keys.sorted_distinct(df, "v").collect()] == ["a", "b"]


# --- joins -----------------------------------------------------------------


@pytest.fixture
def skewed(spark):
    """Two thirds of the left rows under one key, exact copies among them; NULL keys too."""
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, F.lit("hot"))
        .when(F.col("id") % 30 == 2, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50))
        .alias("k"),
        (F.col("id") % 7).alias("v"),
    )
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("k2", 3), ("k5", 4), ("unused", 5), (None, 6)], "k string, w int"
    )
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_a_plain_join(skewed, how):
    left, right = skewed
    want = Counter(tuple(r) for r in left.join(right, "k", how).select("k", "v", "w").collect())
    salted = joins.salted_join(left, right, ["k"], how)
    assert salted.columns == ["k", "v", "w"]
    assert Counter(tuple(r) for r in salted.collect()) == want


@pytest.fixture
def hot_on_both(spark):
    """One key holds half of both sides, one is hot on the right only, one on the left only."""
    left = spark.range(800).select(
        F.when(F.col("id") % 2 == 0, "both").when(F.col("id") % 5 == 1, "left")
        .when(F.col("id") % 50 == 3, None).when(F.col("id") < 9, "right")
        .otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
        F.col("id").alias("v"),
    )
    right = spark.range(300).select(
        F.when(F.col("id") % 2 == 0, "both").when(F.col("id") % 3 == 1, "right")
        .when(F.col("id") % 50 == 5, None).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
        (-F.col("id")).alias("w"),
    )
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
def test_keys_hot_on_both_sides_meet_in_a_grid(hot_on_both, how):
    left, right = hot_on_both
    want = Counter(tuple(r) for r in left.join(right, "k", how).select("k", "v", "w").collect())
    got = joins.salted_join(left, right, ["k"], how, hot_share=0.05)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert want[("both", 0, 0)] == 1 and len(want) > 60_000


def test_a_key_hot_on_both_sides_is_spread_over_tasks(spark, hot_on_both):
    joined = joins.salted_join(*hot_on_both, ["k"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tasks = joined.filter("k = 'both'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 0.5 * 400 * 150


def test_left_rows_without_a_hot_right_key_stay_once(spark):
    left = spark.createDataFrame([("a", 1)] * 50 + [("b", 2)] * 3, "k string, v int")
    right = spark.createDataFrame([("c", 3)] * 50, "k string, w int")
    got = joins.salted_join(left, right, ["k"], "left").collect()
    assert Counter(map(tuple, got)) == {("a", 1, None): 50, ("b", 2, None): 3}


def test_hot_key_is_spread_over_partitions(spark, skewed):
    left, right = skewed
    joined = joins.salted_join(left, right, ["k"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tasks = joined.filter("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct()
        assert tasks.count() > 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("limit", [0, 1000])
def test_attach_takes_either_way_with_equal_result(skewed, limit):
    left, right = skewed
    got = joins.attach(left, right, ["k"], "left", max_broadcast_bytes=limit)
    want = left.join(right, "k", "left")
    key = ["k", "v", "w"]
    assert Counter(map(tuple, got.select(key).collect())) == Counter(
        map(tuple, want.select(key).collect())
    )


def test_no_hot_key_means_a_plain_join(spark, tmp_path):
    left = spark.range(2000).selectExpr("id AS k", "id AS v")
    right = spark.range(0, 2000, 2).selectExpr("id AS k", "-id AS w")
    joined = joins.salted_join(left, right, ["k"])
    assert "_salt" not in joined._jdf.queryExecution().toString()
    assert joined.count() == 1000


def test_measured_bytes_follow_the_texts(spark):
    short = spark.range(10).selectExpr("repeat('a', 5) AS t")
    long = spark.range(10).selectExpr("repeat('a', 5000) AS t", "array(1, 2) AS a")
    assert joins.value_bytes(short) == 10 * 21
    assert joins.value_bytes(long) > 50_000
    assert joins.value_bytes(spark.range(0)) == 0


def test_line_items_stay_where_they_are(spark):
    """No Exchange above the fact table, even when Catalyst may not broadcast by itself."""
    from driver_queries import star

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = star.raw_yield(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BuildRight") == 2 and "BuildLeft" not in plan
    assert "hashpartitioning" not in plan


def test_fits(spark):
    assert joins.fits(spark.range(5), 5)
    assert not joins.fits(spark.range(6), 5)


def test_other_join_types_are_refused(skewed):
    with pytest.raises(ValueError, match="outer"):
        joins.salted_join(*skewed, ["k"], "outer")


# --- integration -----------------------------------------------------------


@pytest.fixture
def parts(spark):
    panel = spark.createDataFrame(
        [("a", 1990, "maize", 1.0, "t"), ("a", 1990, "rice", 2.0, "t"), ("b", 1990, "rice", 3.0, "t"),
         ("c", 1990, "rice", 4.0, "t")],
        "Country string, Year int, Crop string, Yield double, Yield_Unit string",
    )

    def measure(*found):
        return spark.createDataFrame(found, "Country string, Year int, m double")

    return panel, {
        "Rainfall": (measure(("a", 1990, 10.0), ("a", 1990, 20.0), ("b", 1990, 30.0)), "m"),
        "Pesticides": (measure(("a", 1990, 5.0), ("b", 1990, 6.0), ("c", 1990, 7.0)), "m"),
        "Avg_Temperature": (measure(("a", 1990, 15.0), ("b", 1991, 16.0)), "m"),
    }


def test_repeated_keys_multiply_rows(parts, rows):
    panel = integrate.integrate(*parts)
    assert panel.columns[-3:] == ["Rainfall", "Pesticides", "Avg_Temperature"]
    assert rows(panel, "Crop", "Rainfall") == [
        ("maize", 10.0), ("maize", 20.0), ("rice", 10.0), ("rice", 20.0),
    ]


def test_repeated_keys_can_be_averaged_or_refused(parts, rows):
    panel = integrate.integrate(*parts, on_duplicate="mean")
    assert rows(panel, "Crop", "Rainfall") == [("maize", 15.0), ("rice", 15.0)]
    with pytest.raises(Exception, match="repeated key"):
        integrate.integrate(*parts, on_duplicate="error").collect()
    with pytest.raises(ValueError, match="on_duplicate"):
        integrate.integrate(*parts, on_duplicate="first")


def test_distinct_inputs_give_the_distinct_panel(spark, parts, rows):
    panel, measures = parts
    doubled = panel.unionByName(panel)
    twice = {out: (t.unionByName(t), m) for out, (t, m) in measures.items()}
    want = rows(integrate.integrate(panel, measures).distinct())
    assert rows(integrate.integrate(doubled, twice, distinct=True)) == want
    assert len(rows(integrate.integrate(doubled, twice))) == 16 * len(want)


def test_trace_counts_what_the_joins_give(parts, rows):
    assert rows(integrate.integration_trace(*parts)) == [
        (0, "start", 4), (1, "Rainfall", 5), (2, "Pesticides", 5), (3, "Avg_Temperature", 4),
    ]


def test_trace_counts_null_keys_at_the_start_only(spark, parts, rows):
    panel, measures = parts
    nulls = spark.createDataFrame([(None, 1990, "x", 1.0, "t")], panel.schema)
    odd = {"Rainfall": (spark.createDataFrame([(None, 1990, 1.0)], "Country string, Year int, m double"), "m")}
    assert rows(integrate.integration_trace(nulls, odd)) == [(0, "start", 1), (1, "Rainfall", 0)]
