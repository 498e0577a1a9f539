"""Whole jobs as a user runs them: load by name, preprocess, profile, export, read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from driver_queries import star
from driver_queries.plans import NUMBERS, PROCESSED_SQL
from driver_queries.registry import query, read, rounded
from fieldpanel.operators import shape
from fieldpanel.plans import preprocess, reports
from fieldpanel.sources import readers, sinks
from fieldpanel.sources.catalog import DatasetCatalog
from fieldpanel.staging import staging_path

RAW_NAMES = ("yield", "temp", "rainfall", "pesticides")


def saved_project(spark, sf_dir, names=RAW_NAMES):
    """A project folder with the raw tables as CSV; ``yield_df`` is missing from it."""
    root = staging_path(spark, "project")
    tables = star.raw_tables(spark, sf_dir)
    for name in names:
        sinks.save(tables[name], f"{DatasetCatalog.folders(root)['raw']}{name}.csv", "csv")
    return root


@query(
    "catalog_load_all",
    f"""WITH {star.RAW}
    SELECT 'yield' AS dataset, 'loaded' AS status, count(*) AS row_count,
           count("Value") AS n_values FROM raw_yield
    UNION ALL SELECT 'temp', 'loaded', count(*), count(avg_temp) FROM raw_temp
    UNION ALL SELECT 'rainfall', 'loaded', count(*), count(average_rain_fall_mm_per_year)
      FROM raw_rainfall
    UNION ALL SELECT 'pesticides', 'loaded', count(*), count("Value") FROM raw_pesticides
    UNION ALL SELECT 'yield_df', 'unreadable', 0, 0""",
)
def catalog_load_all(spark, sf_dir):
    """All datasets of a saved project: rows and values of each that can be read."""
    root = saved_project(spark, sf_dir)
    loaded, failed = DatasetCatalog.under(root, declared=True).load_all(spark)
    value = {"temp": "avg_temp", "rainfall": "average_rain_fall_mm_per_year"}
    parts = [
        df.agg(
            F.lit(name).alias("dataset"),
            F.lit("loaded").alias("status"),
            F.count("*").alias("row_count"),
            F.count(value.get(name, "Value")).alias("n_values"),
        )
        for name, df in loaded.items()
    ]
    for name in failed:
        none = F.lit(0).cast("bigint")
        parts.append(
            spark.range(1).select(
                F.lit(name).alias("dataset"), F.lit("unreadable").alias("status"),
                none.alias("row_count"), none.alias("n_values"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "catalog_load",
    f"""WITH {star.RAW} SELECT trim("Area") AS "Area", "Year", "Value" FROM raw_pesticides""",
)
def catalog_load(spark, sf_dir):
    """One dataset by its name, types inferred."""
    root = saved_project(spark, sf_dir, ["pesticides"])
    found = DatasetCatalog.under(root).load(spark, "pesticides")
    return found.withColumn("Area", F.trim("Area"))


SAMPLE_COLUMNS = ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


@query(
    "schema_sample",
    f"""WITH first_rows AS (SELECT {', '.join(SAMPLE_COLUMNS)} FROM lineitem
      ORDER BY l_orderkey, l_linenumber, l_quantity LIMIT 3),
    n AS (SELECT count(*) AS row_count FROM lineitem)
    """ + " UNION ALL ".join(
        f"""SELECT {i} AS ordinal, '{c}' AS "column", '{t}' AS dtype, row_count,
        (SELECT string_agg(CAST({c} AS VARCHAR), ', '
                           ORDER BY l_orderkey, l_linenumber, l_quantity) FROM first_rows) AS sample
        FROM n"""
        for i, (c, t) in enumerate(zip(SAMPLE_COLUMNS, ("bigint", "int", "double", "string")), 1)
    ),
)
def schema_sample(spark, sf_dir):
    """Columns, types, row count and the first three rows."""
    items = read(spark, sf_dir, "lineitem").select(*SAMPLE_COLUMNS)
    found = shape.inspect(items, ["l_orderkey", "l_linenumber", "l_quantity"], 3)
    return found.withColumn("sample", F.array_join("sample", ", "))


def exported(spark, sf_dir):
    root = staging_path(spark, "job")
    return root, preprocess.preprocess_and_export(
        star.raw_tables(spark, sf_dir), root, relative_error=0.0001,
        processing_date=date(2024, 1, 1), id_columns=["Country", "Year", "Crop", "Yield_Unit"],
    )


@query(
    "preprocess_export",
    f"""WITH {PROCESSED_SQL}
    SELECT "Country", "Year", "Crop", "Yield_Unit", round("Yield", 6) AS "Yield",
           round("Rainfall", 6) AS "Rainfall", round("Pesticides", 6) AS "Pesticides",
           round("Avg_Temperature", 6) AS "Avg_Temperature", "Country_Index", "Crop_Index",
           'v1.0' AS "Processing_Version"
    FROM kept JOIN by_country USING ("Country") JOIN by_crop USING ("Crop")""",
)
def preprocess_export(spark, sf_dir):
    """The export of the preprocessing job, read back from its CSV files."""
    root, found = exported(spark, sf_dir)
    path = f"{root}/processed/processed_data.csv"
    back = readers.read_csv(spark, path, found["processed"].schema)
    return rounded(
        back.select(
            "Country", "Year", "Crop", "Yield_Unit", *NUMBERS, "Country_Index", "Crop_Index",
            "Processing_Version",
        ),
        6,
        *NUMBERS,
    )


_RANKED = ("Rainfall", "Pesticides", "Avg_Temperature", "Country_Index", "Crop_Index")


@query(
    "preprocess_ranking",
    f"""WITH {PROCESSED_SQL}, processed AS (
      SELECT * FROM kept JOIN by_country USING ("Country") JOIN by_crop USING ("Crop")),
    correlations AS ({" UNION ALL ".join(
        f'''SELECT '{c}' AS feature, round(corr("Yield", "{c}"), 6) + 0.0 AS corr FROM processed'''
        for c in _RANKED)})
    SELECT CAST(row_number() OVER (ORDER BY abs(corr) DESC, feature) AS INTEGER) AS rank,
           feature, corr,
           CASE WHEN abs(corr) > 0.3 THEN 'Strong' WHEN abs(corr) > 0.1 THEN 'Moderate'
                WHEN abs(corr) > 0.05 THEN 'Weak' ELSE 'Very weak' END AS strength,
           CASE WHEN corr > 0 THEN 'positive' ELSE 'negative' END AS direction
    FROM correlations""",
)
def preprocess_ranking(spark, sf_dir):
    """The ranking that the preprocessing job returns beside its export."""
    _, found = exported(spark, sf_dir)
    return rounded(found["ranking"].drop("abs_corr"), 6, "corr")


def flexible_job(spark, sf_dir):
    """The raw yield table under other column names, prepared and exported."""
    raw = star.raw_yield(spark, sf_dir).withColumnsRenamed(
        {"Area": "Country_Name", "Year": "season_year", "Item": "crop_type", "Value": "yield_kg"}
    )
    root = staging_path(spark, "flexible")
    reports.flexible_export(raw, root, ["area", "year", "crop", "yield"], "raw yield")
    return root


@query(
    "flexible_export",
    f"""WITH {star.RAW} SELECT "Year" AS year, "Area" AS area, "Item" AS crop, "Value" AS yield,
        "Unit" FROM raw_yield""",
)
def flexible_export(spark, sf_dir):
    """The prepared table, read back from the exported Parquet."""
    root = flexible_job(spark, sf_dir)
    return readers.read_table(spark, f"{root}/processed/prepared_data.parquet")


_ROLES = (
    ("year", "Year", "int"), ("area", "Area", "string"), ("crop", "Item", "string"),
    ("yield", "Value", "double"), ("Unit", "Unit", "string"),
)


@query(
    "flexible_report",
    f"WITH {star.RAW} " + " UNION ALL ".join(
        f"""SELECT 'raw yield' AS source, count(*) AS total_rows,
        CAST({len(_ROLES)} AS BIGINT) AS total_columns, '{role}' AS "column", '{t}' AS dtype,
        count(DISTINCT "{c}") AS distinct_values, count(*) - count("{c}") AS missing
        FROM raw_yield""" for role, c, t in _ROLES
    ),
)
def flexible_report(spark, sf_dir):
    """The column report of the export, with the totals of its source, read back from JSON."""
    root = flexible_job(spark, sf_dir)
    report = readers.read_table(spark, f"{root}/results/data_report.json", "json")
    return report.drop("report_date")
