"""Sources, sinks, column shaping, cleaning and row filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from driver_queries import star
from driver_queries.registry import query, read
from fieldpanel.operators import clean, shape
from fieldpanel.plans import preprocess
from fieldpanel.plans.compare import modelling_table
from fieldpanel.sources import readers, sinks
from fieldpanel.staging import staging_path


@query("csv_roundtrip", "SELECT * FROM customer")
def csv_roundtrip(spark, sf_dir):
    customers = read(spark, sf_dir, "customer")
    path = staging_path(spark, "customer_csv")
    sinks.write_csv(customers, path)
    return readers.read_csv(spark, path, customers.schema)


@query(
    "parquet_roundtrip",
    "SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders",
)
def parquet_roundtrip(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    path = staging_path(spark, "orders_parquet")
    sinks.write_parquet(orders, path, partition_by=["o_orderstatus"])
    back = readers.read_table(spark, path, "parquet", orders.schema)
    return back.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query(
    "sample_limit",
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
       ORDER BY o_orderkey LIMIT 1000""",
)
def sample_limit(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )
    path = staging_path(spark, "orders_sample")
    sinks.write_sample(orders, path, ["o_orderkey"], 1000)
    return readers.read_csv(spark, path, orders.schema)


@query(
    "trim_headers",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity
       FROM lineitem GROUP BY 1, 2""",
)
def trim_headers(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem")
    blanked = items.toDF(*[f"  {c} " for c in items.columns])
    return (
        shape.trim_headers(blanked)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))
    )


@query(
    "rename_columns",
    """SELECT event_id AS id, user_id AS visitor, event_type AS kind, value AS amount
       FROM events""",
)
def rename_columns(spark, sf_dir):
    events = read(spark, sf_dir, "events").drop("ts", "props")
    names = {"event_id": "id", "user_id": "visitor", "event_type": "kind", "value": "amount"}
    return shape.rename_columns(events, names)


@query(
    "project_alias",
    """SELECT l_orderkey AS order_id, l_linenumber AS line, l_quantity AS quantity,
              l_extendedprice * (1 - l_discount) AS revenue FROM lineitem""",
)
def project_alias(spark, sf_dir):
    return shape.project(
        read(spark, sf_dir, "lineitem"),
        {
            "order_id": "l_orderkey",
            "line": "l_linenumber",
            "quantity": "l_quantity",
            "revenue": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        },
    )


@query("drop_if_exists", "SELECT * FROM part")
def drop_if_exists(spark, sf_dir):
    parts = read(spark, sf_dir, "part")
    indexed = parts.withColumn("_c0", F.col("p_partkey")).withColumn("Unnamed: 0", F.lit(0))
    return shape.drop_if_exists(indexed)


@query(
    "cast_strict",
    """SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
              CAST(o_custkey AS DOUBLE) AS customer FROM orders""",
)
def cast_strict(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).alias("priority"),
        F.col("o_custkey").cast("string").alias("customer"),
    )
    return shape.cast_columns(orders, {"priority": "int", "customer": "double"})


@query(
    "cast_safe",
    """SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW')
              THEN o_orderpriority ELSE substr(o_orderpriority, 1, 1) END AS DOUBLE) AS priority
       FROM orders""",
)
def cast_safe(spark, sf_dir):
    text = F.col("o_orderpriority")
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(text.isin("1-URGENT", "5-LOW"), text)
        .otherwise(F.substring(text, 1, 1))
        .alias("priority"),
    )
    return shape.cast_columns(orders, {"priority": "double"}, safe=True)


@query(
    "identify_columns",
    f"""WITH {star.PANEL_SQL}
    SELECT * FROM (
      SELECT 'year' AS role, 'Year' AS "column", count("Year") AS n_values FROM panel
      UNION ALL SELECT 'rainfall', 'average_rain_fall_mm_per_year', count("Rainfall") FROM panel
      UNION ALL SELECT 'pesticide', 'pesticides_tonnes', count("Pesticides") FROM panel
      UNION ALL SELECT 'temperature', 'avg_temp', count("Avg_Temperature") FROM panel
      UNION ALL SELECT 'area', 'Area', count("Country") FROM panel
      UNION ALL SELECT 'crop', 'Item', count("Crop") FROM panel
      UNION ALL SELECT 'yield', 'hg/ha_yield', count("Yield") FROM panel)""",
)
def identify_columns(spark, sf_dir):
    """The roles found in a modelling table, with the values each column holds."""
    table = modelling_table(preprocess.integrated_panel(star.raw_tables(spark, sf_dir)))
    roles = shape.identify_columns(table.columns)
    found = F.array(
        *[
            F.struct(
                F.lit(role).alias("role"),
                F.lit(c).alias("column"),
                F.count(F.col(f"`{c}`")).alias("n_values"),
            )
            for role, c in roles.items()
        ]
    )
    return table.agg(found.alias("found")).select(F.inline("found"))


@query(
    "prepare_columns",
    f"""WITH {star.PANEL_SQL}
    SELECT "Year" AS year, "Rainfall" AS rainfall, "Pesticides" AS pesticide,
           "Avg_Temperature" AS temperature, "Country" AS area, "Crop" AS crop,
           "Yield" AS yield, "Yield_Unit" FROM panel""",
)
def prepare_columns(spark, sf_dir):
    return shape.prepare_columns(preprocess.integrated_panel(star.raw_tables(spark, sf_dir)))


@query(
    "schema_inspect",
    """SELECT * FROM (VALUES (1, 'l_orderkey', 'bigint'), (2, 'l_partkey', 'bigint'),
         (3, 'l_suppkey', 'bigint'), (4, 'l_linenumber', 'int'), (5, 'l_quantity', 'double'),
         (6, 'l_extendedprice', 'double'), (7, 'l_discount', 'double'), (8, 'l_tax', 'double'),
         (9, 'l_returnflag', 'string'), (10, 'l_linestatus', 'string'),
         (11, 'l_shipdate', 'timestamp_ntz')) AS v(ordinal, "column", dtype)
       CROSS JOIN (SELECT count(*) AS row_count FROM lineitem)""",
)
def schema_inspect(spark, sf_dir):
    return shape.inspect(read(spark, sf_dir, "lineitem"))


@query(
    "add_metadata",
    """SELECT l_orderkey, l_linenumber, l_quantity, nullif(l_tax, 0) AS l_tax,
         md5(l_orderkey || '|' || l_linenumber || '|' || l_partkey) AS "ID",
         '2024-01-01' AS "Processing_Date", 'v1.0' AS "Processing_Version",
         CASE WHEN l_tax = 0 THEN 75 ELSE 100 END AS "Data_Quality_Score"
       FROM lineitem""",
)
def add_metadata(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
    )
    stamped = shape.add_metadata(
        items,
        processing_date=date(2024, 1, 1),
        id_columns=["l_orderkey", "l_linenumber", "l_partkey"],
        score_columns=["l_orderkey", "l_linenumber", "l_quantity", "l_tax"],
    ).drop("l_partkey")
    return stamped.withColumn("Processing_Date", F.col("Processing_Date").cast("string"))


@query(
    "clean_rainfall",
    f"WITH {star.CLEAN} SELECT * FROM clean_rainfall",
)
def clean_rainfall(spark, sf_dir):
    return clean.clean_rainfall(star.raw_measures(spark, sf_dir)["rainfall"])


@query("clean_pesticides", f"WITH {star.CLEAN} SELECT * FROM clean_pesticides")
def clean_pesticides(spark, sf_dir):
    return clean.clean_pesticides(star.raw_measures(spark, sf_dir)["pesticides"])


@query("clean_yield", f"WITH {star.CLEAN} SELECT * FROM clean_yield")
def clean_yield(spark, sf_dir):
    return clean.clean_yield(star.raw_yield(spark, sf_dir))


@query(
    "clean_temp",
    f"WITH {star.CLEAN} SELECT * FROM clean_temp",
)
def clean_temp(spark, sf_dir):
    return clean.clean_temp(star.raw_measures(spark, sf_dir)["temp"])


@query(
    "drop_nulls",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_discount, l_tax FROM lineitem
       WHERE l_discount <> 0 AND l_tax <> 0""",
)
def drop_nulls(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
    )
    return clean.drop_nulls(items, ["l_discount", "l_tax"])


@query(
    "zscore_filter",
    """SELECT event_id, event_type, value FROM events,
         (SELECT avg(value) AS m, stddev_samp(value) AS s, avg(user_id) AS um,
                 stddev_samp(user_id) AS us FROM events)
       WHERE abs((value - m) / s) <= 3 AND abs((user_id - um) / us) <= 3""",
)
def zscore_filter(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    return clean.zscore_filter(events, ["value", "user_id"]).select(
        "event_id", "event_type", "value"
    )


@query(
    "dedup_rows",
    "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey, l_quantity FROM lineitem",
)
def dedup_rows(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem")
    return clean.dedup_rows(items.select("l_returnflag", "l_linestatus", "l_suppkey", "l_quantity"))
