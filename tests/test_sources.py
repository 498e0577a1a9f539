from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from fieldpanel import staging
from fieldpanel.operators import shape
from fieldpanel.sources import readers, sinks
from fieldpanel.sources.catalog import Dataset, DatasetCatalog


@pytest.fixture
def project(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "rainfall.csv").write_text(
        " Area,Year, average_rain_fall_mm_per_year \nAlbania,1990,1485\nAngola,1991,..\n"
    )
    (raw / "pesticides.csv").write_text("Area,Year,Value\nAlbania,1990,121.0\n")
    (raw / "temp.csv").write_text("year,country,avg_temp\n1990,Albania,16.37\n")
    (raw / "yield_df.csv").write_text(",Area,Item\n0,Albania,Maize\n")
    return tmp_path


def test_inferred_csv_keeps_blank_headers_and_bad_text(spark, project):
    df = DatasetCatalog.under(str(project)).load(spark, "rainfall")
    assert df.columns == [" Area", "Year", " average_rain_fall_mm_per_year "]
    assert dict(df.dtypes)["Year"] == "int"
    assert dict(df.dtypes)[" average_rain_fall_mm_per_year "] == "string"
    trimmed = shape.trim_headers(df)
    assert trimmed.columns == ["Area", "Year", "average_rain_fall_mm_per_year"]


def test_blank_header_gets_a_stray_name_that_is_dropped(spark, project):
    df = DatasetCatalog.under(str(project)).load(spark, "yield_df")
    assert df.columns == ["_c0", "Area", "Item"]
    assert shape.drop_if_exists(df).columns == ["Area", "Item"]


def test_declared_schema_checks_the_header(spark, project):
    catalog = DatasetCatalog.under(str(project), declared=True)
    assert dict(catalog.load(spark, "pesticides").dtypes)["Value"] == "double"
    assert catalog.load(spark, "pesticides").first()["Value"] == 121.0
    with pytest.raises(Exception, match="header"):
        catalog.load(spark, "temp").collect()


def test_unknown_dataset_names_the_known_ones(spark, project):
    with pytest.raises(KeyError, match="rainfall"):
        DatasetCatalog.under(str(project)).load(spark, "soil")


def test_load_all_reports_what_is_missing(spark, project):
    loaded, failed = DatasetCatalog.under(str(project)).load_all(spark)
    assert set(loaded) == {"yield_df", "temp", "rainfall", "pesticides"}
    assert list(failed) == ["yield"]


def test_folders(project):
    assert DatasetCatalog.folders("hdfs://h/p/")["raw"] == "hdfs://h/p/raw/"


def test_csv_roundtrip_with_nulls_and_delimiter(spark, tmp_path, rows):
    df = spark.createDataFrame([("a,b", 1.5), (None, None)], "name string, v double")
    path = str(tmp_path / "out")
    sinks.write_csv(df, path, delimiter=";", single_file=True)
    assert len(list((tmp_path / "out").glob("part-*.csv"))) == 1
    back = readers.read_csv(spark, path, df.schema, sep=";")
    assert rows(back) == rows(df)


def test_parquet_by_partition(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 1990), (2, 1991)], "v int, Year int")
    sinks.write_parquet(df, str(tmp_path / "t"), partition_by=["Year"])
    assert (tmp_path / "t" / "Year=1990").is_dir()
    assert rows(readers.read_table(spark, str(tmp_path / "t"))) == rows(df)


def test_save_rejects_unknown_formats(spark, tmp_path):
    df = spark.range(3)
    sinks.save(df, str(tmp_path / "p"), "parquet")
    sinks.save(df, str(tmp_path / "c"), "csv")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3
    with pytest.raises(ValueError, match="xml"):
        sinks.save(df, str(tmp_path / "x"), "xml")


def test_sample_is_the_first_rows_in_order(spark, tmp_path):
    sinks.write_sample(spark.range(100), str(tmp_path / "s"), ["id"], 5)
    back = readers.read_csv(spark, str(tmp_path / "s"), "id bigint")
    assert sorted(r.id for r in back.collect()) == [0, 1, 2, 3, 4]


def test_metrics_need_a_model_column(spark, tmp_path):
    with pytest.raises(ValueError, match="model"):
        sinks.write_metrics(spark.range(1), str(tmp_path / "m"))


def test_profile_sink_stamps_date_and_source(spark, tmp_path):
    profile = spark.createDataFrame([("a", "int", 3, 0)], "column string, dtype string, d int, m int")
    sinks.write_profile(profile, str(tmp_path / "r"), "yield_df", total_rows=12)
    row = spark.read.json(str(tmp_path / "r")).first()
    assert row["source"] == "yield_df" and row["report_date"]
    assert (row["total_rows"], row["total_columns"]) == (12, 1)


def test_read_table_other_formats(spark, tmp_path):
    spark.range(4).write.orc(str(tmp_path / "o"))
    catalog = DatasetCatalog({"o": Dataset(str(tmp_path / "o"), "orc")})
    assert catalog.load(spark, "o").count() == 4


def test_missing_parquet_is_an_analysis_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.read_table(spark, str(tmp_path / "none"))


def test_stage_writes_below_the_checkpoint_folder(spark):
    root = staging.staging_root(spark)
    assert root.startswith(spark.conf.get("spark.checkpoint.dir"))
    staged = staging.stage(spark.range(10), "ten")
    assert staged.count() == 10 and root in staged.inputFiles()[0]
