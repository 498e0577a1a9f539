from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from fieldpanel.operators import clean, shape


def test_trim_headers_refuses_collisions(spark):
    with pytest.raises(ValueError, match="collide"):
        shape.trim_headers(spark.createDataFrame([(1, 2)], ["a", " A "]))


def test_rename_ignores_absent_names_and_keeps_special_characters(spark):
    df = spark.createDataFrame([(1.0, 2)], ["Yield", "Year"])
    out = shape.rename_columns(df, {"Yield": "hg/ha_yield", "Soil": "soil"})
    assert out.columns == ["hg/ha_yield", "Year"]


def test_project_takes_names_and_expressions(spark, rows):
    df = spark.createDataFrame([(2, 3)], ["a", "b"])
    assert rows(shape.project(df, {"x": "b", "y": F.col("a") * 2})) == [(3, 4)]


def test_strict_cast_fails_where_safe_cast_gives_null(spark, rows):
    df = spark.createDataFrame([("1.5",), ("..",), ("",)], ["v"])
    assert rows(shape.cast_columns(df, {"v": "double"}, safe=True)) == [(None,), (None,), (1.5,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        shape.cast_columns(df, {"v": "double"}).collect()


def test_roles_are_ranked_and_one_to_one():
    roles = shape.identify_columns(
        ["average_rain_fall_mm_per_year", "Year", "pesticides_tonnes", "avg_temp", "Area", "Item",
         "Yield_Category", "hg/ha_yield", "Temperature_Category"]
    )
    assert roles == {
        "year": "Year",
        "rainfall": "average_rain_fall_mm_per_year",
        "pesticide": "pesticides_tonnes",
        "temperature": "avg_temp",
        "area": "Area",
        "crop": "Item",
        "yield": "hg/ha_yield",
    }


def test_derived_columns_do_not_take_a_role():
    roles = shape.identify_columns(["Yield_Category", "Yield", "Yield_Normalized", "Country_Index",
                                    "Country", "YEAR"])
    assert roles == {"year": "YEAR", "area": "Country", "yield": "Yield"}


def test_rainfall_alone_does_not_become_the_year():
    assert shape.identify_columns(["average_rain_fall_mm_per_year"]) == {
        "rainfall": "average_rain_fall_mm_per_year"
    }


def test_prepare_keeps_roles_and_a_few_extras(spark):
    names = ["Year", "Country", *[f"x{i}" for i in range(8)]]
    df = spark.createDataFrame([tuple(range(10))], names)
    assert shape.prepare_columns(df, n_extra=5).columns == ["year", "area", "x0", "x1", "x2", "x3", "x4"]
    plain = df.select("x0", "x1")
    assert shape.prepare_columns(plain).columns == ["x0", "x1"]


def test_inspect(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, hg/ha string".replace("hg/ha", "s"))
    assert rows(shape.inspect(df)) == [(1, "n", "int", 2), (2, "s", "string", 2)]


def test_metadata(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "k string, v double")
    out = shape.add_metadata(df, processing_date=date(2024, 5, 1)).orderBy("k").collect()
    assert [r.Data_Quality_Score for r in out] == [100, 50]
    assert {r.Processing_Version for r in out} == {"v1.0"}
    assert {r.Processing_Date for r in out} == {date(2024, 5, 1)}
    assert len({r.ID for r in out}) == 2
    stable = shape.add_metadata(df.repartition(5), id_columns=["k", "v"])
    again = shape.add_metadata(df.coalesce(1), id_columns=["k", "v"])
    assert {r.ID for r in stable.collect()} == {r.ID for r in again.collect()}
    assert dict(stable.dtypes)["ID"] == "string"


def test_values_with_bars_backslashes_and_nulls_have_ids_of_their_own(spark):
    keys = [("a|b", "c"), ("a", "b|c"), ("a\\", "|b"), ("a\\|", "b"), (None, "x"), ("\\N", "x")]
    df = spark.createDataFrame(keys, "k string, v string")
    found = shape.add_metadata(df, id_columns=["k", "v"]).select("ID").distinct()
    assert found.count() == len(keys)


def test_all_columns_are_kept_unless_told_otherwise(spark):
    df = spark.createDataFrame([(1,) * 9], ["year", *[f"c{i}" for i in range(8)]])
    assert len(shape.prepare_columns(df).columns) == 9
    assert shape.prepare_columns(df, n_extra=5).columns == ["year", *[f"c{i}" for i in range(5)]]


def test_null_and_empty_text_have_different_keys(spark):
    df = spark.createDataFrame([("", "x"), (None, "x")], "k string, v string")
    assert len({r.ID for r in shape.add_metadata(df, id_columns=["k", "v"]).collect()}) == 2


def test_clean_rainfall(spark, rows):
    raw = spark.createDataFrame(
        [("Albania", 1990, "1485"), ("Albania", 1991, ".."), (None, 1990, "1"),
         ("Angola", None, "1"), ("Angola", 1990, None), ("Angola", 1992, "")],
        "Area string, Year int, average_rain_fall_mm_per_year string",
    )
    cleaned = clean.clean_rainfall(raw)
    assert cleaned.columns == ["Country", "Year", "average_rain_fall_mm_per_year"]
    assert rows(cleaned) == [("Albania", 1990, 1485.0)]


def test_clean_yield_keeps_null_items(spark, rows):
    raw = spark.createDataFrame(
        [("Albania", 1990, None, "36613", "hg/ha"), ("Albania", 1991, "Maize", None, "hg/ha")],
        "Area string, Year int, Item string, Value string, Unit string",
    )
    assert rows(clean.clean_yield(raw)) == [("Albania", 1990, None, 36613.0, "hg/ha")]


def test_strict_tables_fail_on_bad_numbers(spark):
    raw = spark.createDataFrame([("A", 1990, "..")], "Area string, Year int, Value string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.clean_pesticides(raw).collect()


def test_clean_temp_renames_lower_case_columns(spark):
    raw = spark.createDataFrame([(1990, "Albania", 16.37)], "year int, country string, avg_temp double")
    assert clean.clean_temp(raw).columns == ["Country", "Year", "avg_temp"]


def test_zscore_filter(spark, rows):
    values = [(float(i % 10), 1.0) for i in range(100)] + [(1000.0, 1.0), (None, 1.0)]
    df = spark.createDataFrame(values, "v double, flat double")
    kept = clean.zscore_filter(df, ["v", "flat"])
    assert kept.count() == 100  # the outlier and the NULL go, the constant column filters nothing
    assert kept.exceptAll(df).count() == 0


def test_zscore_of_one_row_keeps_it(spark):
    df = spark.createDataFrame([(5.0,)], "v double")
    assert clean.zscore_filter(df, ["v"]).count() == 1


def test_drop_nulls_keeps_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "v double")
    assert clean.drop_nulls(df, ["v"]).count() == 2


def test_dedup(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2)], "a int, b int")
    assert clean.dedup_rows(df).count() == 2


def test_inspection_shows_the_first_rows(spark):
    df = spark.createDataFrame([(3, "c"), (1, None), (2, "b")], "n int, `odd name` string")
    plain = shape.inspect(df)
    assert plain.columns == ["ordinal", "column", "dtype", "row_count"]
    found = {r["column"]: (r["sample"], r.row_count) for r in shape.inspect(df, ["n"], 2).collect()}
    assert found == {"n": (["1", "2"], 3), "odd name": ([None, "b"], 3)}
    assert shape.inspect(df.limit(0), ["n"]).collect()[0]["sample"] == []
