"""The raw place x year x product tables, derived from the star schema.

Countries are nations under spellings that differ from table to table, so they
only join after standardization. Nations 1 and 2 share one standard name, which
repeats keys in every measure table; nation 10 is unknown to one table; some
rainfall is not a number and some yields are missing.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from driver_queries.registry import read
from fieldpanel.functions.country_aliases import COUNTRY_ALIASES
from fieldpanel.operators.joins import attach
from fieldpanel.plans.preprocess import PANEL
from fieldpanel.staging import stage

# Nation key, then its name in the yield, rainfall, pesticides and
# temp tables.
SPELLINGS = [
    (0, "Viet Nam", "Vietnam", "Viet Nam", "vietnam"),
    (1, "Russian Federation", "Russian Federation", "Russian Federation", "Russia"),
    (2, "USSR", "USSR", "USSR", "Russian Federation"),
    (3, "Côte d'Ivoire", "Cote d'Ivoire", "CÔTE D'IVOIRE", " Ivory Coast"),
    (4, "Republic of Korea", "Korea, Rep.", "Republic of Korea", "South Korea "),
    (5, "Bolivia (Plurinational State of)", "Bolivia", "bolivia", "Bolivia"),
    (6, "Iran (Islamic Republic of)", " Iran", "Iran ", "IRAN"),
    (7, "Lao People's Democratic Republic", "Lao PDR", "Lao PDR", "Laos"),
    (8, "United States of America", "United States", "united states", "United States"),
    (9, "Czechia", "Czech Republic", "Czechia", "Czech Republic"),
    (10, "Atlantis", "Atlantis", "Lemuria", "Atlantis"),
]
SPELLING_COLUMNS = ["n_nationkey", "yield_name", "rain_name", "pest_name", "temp_name"]


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


ALIAS_ROWS = ", ".join(f"({_text(a)}, {_text(c)})" for a, c in COUNTRY_ALIASES.items())
SPELLING_ROWS = ", ".join(
    f"({key}, {', '.join(_text(n) for n in names)})" for key, *names in SPELLINGS
)

# --- SQL twins -------------------------------------------------------------

RAW = f"""
aliases(alias, canonical) AS (VALUES {ALIAS_ROWS}),
spelled({', '.join(SPELLING_COLUMNS)}) AS (VALUES {SPELLING_ROWS}),
names AS (
  SELECT n.n_nationkey,
         coalesce(s.yield_name, n.n_name) AS yield_name,
         coalesce(s.rain_name, upper(n.n_name) || ' ') AS rain_name,
         coalesce(s.pest_name, ' ' || lower(n.n_name)) AS pest_name,
         coalesce(s.temp_name, n.n_name) AS temp_name
  FROM nation n LEFT JOIN spelled s ON n.n_nationkey = s.n_nationkey),
raw_yield AS (
  SELECT yield_name AS "Area", CAST(year(l_shipdate) AS INTEGER) AS "Year", p_brand AS "Item",
         CASE WHEN l_discount = 0.1 AND l_tax = 0.08 THEN NULL ELSE l_quantity END AS "Value",
         l_linestatus AS "Unit"
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN names ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey),
country_year AS (
  SELECT c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS "Year",
         count(*) AS n_all,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS n_final,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT))
              FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / 100 AS final_total,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT))
              FILTER (WHERE o_orderpriority = '1-URGENT') AS DOUBLE) / 100 AS urgent_total,
         CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS DOUBLE) / 100 AS balance_total
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
raw_rainfall AS (
  SELECT rain_name AS "Area", "Year",
         CASE WHEN n_final % 13 = 0 THEN '..' ELSE CAST(final_total / n_final AS VARCHAR) END
           AS average_rain_fall_mm_per_year
  FROM country_year JOIN names ON c_nationkey = n_nationkey),
raw_pesticides AS (
  SELECT pest_name AS "Area", "Year", urgent_total AS "Value"
  FROM country_year JOIN names ON c_nationkey = n_nationkey),
raw_temp AS (
  SELECT temp_name AS country, "Year" AS year, balance_total / n_all AS avg_temp
  FROM country_year JOIN names ON c_nationkey = n_nationkey)"""

CLEAN = RAW + """,
clean_rainfall AS (
  SELECT "Area" AS "Country", "Year",
         TRY_CAST(average_rain_fall_mm_per_year AS DOUBLE) AS average_rain_fall_mm_per_year
  FROM raw_rainfall WHERE "Area" IS NOT NULL AND "Year" IS NOT NULL
  AND TRY_CAST(average_rain_fall_mm_per_year AS DOUBLE) IS NOT NULL),
clean_pesticides AS (
  SELECT "Area" AS "Country", "Year", "Value" AS "Pesticides_Value" FROM raw_pesticides
  WHERE "Area" IS NOT NULL AND "Year" IS NOT NULL AND "Value" IS NOT NULL),
clean_yield AS (
  SELECT "Area" AS "Country", "Year", "Item", "Value" AS "Yield_Value", "Unit" FROM raw_yield
  WHERE "Area" IS NOT NULL AND "Year" IS NOT NULL AND "Value" IS NOT NULL),
clean_temp AS (
  SELECT country AS "Country", year AS "Year", avg_temp FROM raw_temp
  WHERE country IS NOT NULL AND year IS NOT NULL AND avg_temp IS NOT NULL)"""


def _standard(table: str) -> str:
    return f"""
std_{table} AS (
  SELECT coalesce(canonical, lower(trim("Country"))) AS "Country", c.* EXCLUDE ("Country")
  FROM clean_{table} c LEFT JOIN aliases ON lower(trim(c."Country")) = alias)"""


STANDARD = CLEAN + "," + ",".join(
    _standard(t) for t in ("rainfall", "pesticides", "yield", "temp")
)


def panel_sql(rainfall: str, pesticides: str, temp: str, name: str = "panel") -> str:
    return f"""
{name} AS (
  SELECT y."Country", y."Year", y."Item" AS "Crop", y."Yield_Value" AS "Yield",
         y."Unit" AS "Yield_Unit", r.average_rain_fall_mm_per_year AS "Rainfall",
         p."Pesticides_Value" AS "Pesticides", t.avg_temp AS "Avg_Temperature"
  FROM std_yield y JOIN {rainfall} r ON y."Country" = r."Country" AND y."Year" = r."Year"
  JOIN {pesticides} p ON y."Country" = p."Country" AND y."Year" = p."Year"
  JOIN {temp} t ON y."Country" = t."Country" AND y."Year" = t."Year")"""


PANEL_SQL = STANDARD + "," + panel_sql("std_rainfall", "std_pesticides", "std_temp")


def _mean(table: str, measure: str) -> str:
    return f"""
mean_{table} AS (SELECT "Country", "Year", avg({measure}) AS {measure} FROM std_{table}
  GROUP BY 1, 2)"""


# One row per (Country, Year, Crop), measures averaged over repeated keys.
MODEL_SQL = STANDARD + "," + ",".join(
    [
        _mean("rainfall", "average_rain_fall_mm_per_year"),
        _mean("pesticides", '"Pesticides_Value"'),
        _mean("temp", "avg_temp"),
        panel_sql("mean_rainfall", "mean_pesticides", "mean_temp"),
        """
model_panel AS (
  SELECT "Country", "Year", "Crop", avg("Yield") AS "Yield", max("Rainfall") AS "Rainfall",
         max("Pesticides") AS "Pesticides", max("Avg_Temperature") AS "Avg_Temperature"
  FROM panel GROUP BY 1, 2, 3)""",
    ]
)

# --- Spark -----------------------------------------------------------------


def nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = dict(zip(SPELLING_COLUMNS, map(list, zip(*SPELLINGS))))
    columns["n_nationkey"] = pa.array(columns["n_nationkey"], pa.int32())
    spelled = spark.createDataFrame(pa.table(columns))
    name = F.col("n_name")
    return read(spark, sf_dir, "nation").join(F.broadcast(spelled), "n_nationkey", "left").select(
        "n_nationkey",
        F.coalesce("yield_name", name).alias("yield_name"),
        F.coalesce("rain_name", F.concat(F.upper(name), F.lit(" "))).alias("rain_name"),
        F.coalesce("pest_name", F.concat(F.lit(" "), F.lower(name))).alias("pest_name"),
        F.coalesce("temp_name", name).alias("temp_name"),
    )


def raw_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by supplier nation.

    The suppliers meet their nation first. That table and the parts are written and
    measured, so the line items move only if a dimension is too large to copy.
    """
    suppliers = (
        read(spark, sf_dir, "supplier")
        .join(
            F.broadcast(nation_names(spark, sf_dir)),  # 25 rows at any scale
            F.col("s_nationkey") == F.col("n_nationkey"),
        )
        .select(F.col("s_suppkey").alias("l_suppkey"), "yield_name")
    )
    missing = (F.col("l_discount") == 0.1) & (F.col("l_tax") == 0.08)
    items = read(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        "l_partkey",
        F.year("l_shipdate").alias("Year"),
        F.when(missing, None).otherwise(F.col("l_quantity")).alias("Value"),
        F.col("l_linestatus").alias("Unit"),
    )
    placed = attach(items, suppliers, ["l_suppkey"])
    return attach(placed, _brands(spark, sf_dir), ["l_partkey"]).select(
        F.col("yield_name").alias("Area"), "Year", F.col("p_brand").alias("Item"), "Value", "Unit"
    )


def _brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")


def sold_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line item quantities by part brand."""
    items = read(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity")
    return attach(items, _brands(spark, sf_dir), ["l_partkey"]).select(
        F.col("p_brand").alias("Crop"), "l_quantity"
    )


def country_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order statistics per nation and year, summed in whole cents, so sums are exact."""

    def cents(amount: str) -> Column:
        return F.round(F.col(amount) * 100).cast("bigint")

    def money(total: Column) -> Column:
        return total.cast("double") / 100

    final = F.col("o_orderstatus") == "F"
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return (
        read(spark, sf_dir, "orders")
        .join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.year("o_orderdate").alias("Year"))
        .agg(
            F.count("*").alias("n_all"),
            F.count_if(final).alias("n_final"),
            money(F.sum(F.when(final, cents("o_totalprice")))).alias("final_total"),
            money(F.sum(F.when(urgent, cents("o_totalprice")))).alias("urgent_total"),
            money(F.sum(cents("c_acctbal"))).alias("balance_total"),
        )
    )


def raw_measures(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Rainfall, pesticides and temp: three readings of one written aggregate."""
    yearly = stage(
        country_year(spark, sf_dir).join(
            nation_names(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
        ),
        "country_year",
    )
    average = F.try_divide("final_total", "n_final").cast("string")
    return {
        "rainfall": yearly.select(
            F.col("rain_name").alias("Area"),
            "Year",
            F.when(F.col("n_final") % 13 == 0, "..")
            .otherwise(average)
            .alias("average_rain_fall_mm_per_year"),
        ),
        "pesticides": yearly.select(
            F.col("pest_name").alias("Area"), "Year", F.col("urgent_total").alias("Value")
        ),
        "temp": yearly.select(
            F.col("temp_name").alias("country"),
            F.col("Year").alias("year"),
            (F.col("balance_total") / F.col("n_all")).alias("avg_temp"),
        ),
    }


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"yield": raw_yield(spark, sf_dir), **raw_measures(spark, sf_dir)}


def averaged_panel(panel: DataFrame) -> DataFrame:
    """One row per (Country, Year, Crop)."""
    return panel.groupBy(*PANEL[:3]).agg(
        F.mean("Yield").alias("Yield"),
        *[F.max(c).alias(c) for c in ("Rainfall", "Pesticides", "Avg_Temperature")],
    )
