"""Counts, statistics and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries import star
from driver_queries.registry import exact, query, read, rounded
from fieldpanel.operators import clean, profile
from fieldpanel.plans import preprocess, reports

ITEM_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def holed_items(spark, sf_dir):
    """Line items with missing discounts and taxes."""
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_quantity",
        "l_extendedprice",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus",
    )


HOLED = """holed AS (
  SELECT l_orderkey, l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount,
         nullif(l_tax, 0) AS l_tax, nullif(l_returnflag, 'R') AS l_returnflag, l_linestatus
  FROM lineitem)"""


def each(columns, select, source):
    """One SELECT per column, ``{c}`` standing for its name."""
    return " " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {select.format(c=c)} FROM {source.format(c=c)}"
        for c in columns
    )


@query(
    "row_counts",
    """SELECT 'nation' AS dataset, count(*) AS row_count FROM nation
       UNION ALL SELECT 'supplier', count(*) FROM supplier
       UNION ALL SELECT 'customer', count(*) FROM customer
       UNION ALL SELECT 'part', count(*) FROM part
       UNION ALL SELECT 'orders', count(*) FROM orders
       UNION ALL SELECT 'lineitem', count(*) FROM lineitem
       UNION ALL SELECT 'events', count(*) FROM events""",
)
def row_counts(spark, sf_dir):
    names = ["nation", "supplier", "customer", "part", "orders", "lineitem", "events"]
    return profile.row_counts({n: read(spark, sf_dir, n) for n in names})


HOLED_COLUMNS = [
    "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus",
]


@query(
    "null_counts",
    "WITH " + HOLED + each(
        HOLED_COLUMNS, " count(*) FILTER (WHERE {c} IS NULL) AS nulls, CAST(0 AS BIGINT) AS nans",
        "holed",
    ),
)
def null_counts(spark, sf_dir):
    return profile.null_counts(holed_items(spark, sf_dir))


@query(
    "missing_report",
    "WITH " + HOLED + ", m AS (" + each(
        HOLED_COLUMNS,
        "count(*) FILTER (WHERE {c} IS NULL) AS missing, "
        "round(count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*), 6) AS missing_pct",
        "holed",
    ) + ") SELECT * FROM m WHERE missing > 0",
)
def missing_report(spark, sf_dir):
    return rounded(profile.missing_report(holed_items(spark, sf_dir)), 6, "missing_pct")


@query(
    "completeness",
    "WITH " + HOLED + ", m AS (" + each(
        ITEM_NUMBERS, "round(count({c}) * 1.0::DOUBLE / count(*), 8) AS completeness", "holed"
    ) + """) SELECT *, CASE WHEN completeness = 1 THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS status
    FROM m""",
)
def completeness(spark, sf_dir):
    return rounded(
        profile.completeness(holed_items(spark, sf_dir), ITEM_NUMBERS), 8, "completeness"
    )


@query(
    "year_coverage",
    f"WITH {star.CLEAN} " + " UNION ALL ".join(
        f"""SELECT '{t}' AS dataset, min("Year") AS min_year, max("Year") AS max_year,
            count(DISTINCT "Year") AS n_years, count(*) AS row_count FROM clean_{t}"""
        for t in ("rainfall", "pesticides", "yield", "temp")
    ),
)
def year_coverage(spark, sf_dir):
    return profile.year_coverage(preprocess.cleaned_tables(star.raw_tables(spark, sf_dir)))


@query(
    "distinct_counts",
    each(
        ["l_partkey", "l_suppkey", "l_quantity", "l_returnflag"],
        "count(DISTINCT {c}) AS distinct_values",
        "lineitem",
    ),
)
def distinct_counts(spark, sf_dir):
    return profile.distinct_counts(
        read(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]
    )


@query(
    "mean_stddev",
    each(
        ITEM_NUMBERS, "round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev", "lineitem"
    ),
)
def mean_stddev(spark, sf_dir):
    stats = profile.mean_stddev(read(spark, sf_dir, "lineitem"), ITEM_NUMBERS)
    return rounded(stats, 6, "mean", "stddev")


@query("value_ranges", each(ITEM_NUMBERS, 'min({c}) + 0.0 AS "min", max({c}) AS "max"', "lineitem"))
def value_ranges(spark, sf_dir):
    ranges = profile.value_ranges(read(spark, sf_dir, "lineitem"), ITEM_NUMBERS)
    return ranges.withColumn("min", F.col("min") + 0.0)  # no negative zero


@query(
    "variance_ratio",
    "WITH " + ", ".join(
        f"moments_{c} AS (SELECT {c}, avg({c}) OVER () AS m FROM lineitem)" for c in ITEM_NUMBERS
    ) + each(
        ITEM_NUMBERS,
        """round(var_samp({c}) / (stddev_samp({c}) * stddev_samp({c})), 6) AS variance_ratio,
        round(avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5), 4) + 0.0 AS skewness,
        round(avg(power({c} - m, 4)) / power(avg(power({c} - m, 2)), 2) - 3, 4) + 0.0 AS kurtosis
        """,
        "moments_{c}",
    ),
)
def variance_ratio(spark, sf_dir):
    stats = profile.variance_ratio(read(spark, sf_dir, "lineitem"), ITEM_NUMBERS)
    stats = stats.withColumn("variance_ratio", exact(F.col("variance_ratio"), 6))
    return rounded(stats, 4, "skewness", "kurtosis")


@query(
    "describe_stats",
    "WITH " + HOLED + each(
        ITEM_NUMBERS,
        """count({c}) AS "count", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
        min({c}) AS "min", max({c}) AS "max" """,
        "holed",
    ),
)
def describe_stats(spark, sf_dir):
    stats = profile.describe_stats(holed_items(spark, sf_dir), ITEM_NUMBERS)
    return rounded(stats, 6, "mean", "stddev")


@query(
    "describe_quartiles",
    "WITH " + HOLED + each(
        ITEM_NUMBERS,
        """count({c}) AS "count", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
        min({c}) AS "min", round(quantile_cont({c}, 0.25), 6) AS q25,
        round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75,
        max({c}) AS "max" """,
        "holed",
    ),
)
def describe_quartiles(spark, sf_dir):
    stats = reports.describe_quartiles(holed_items(spark, sf_dir), ITEM_NUMBERS)
    return rounded(stats, 6, "mean", "stddev", "q25", "q50", "q75")


@query(
    "negative_checks",
    each(["s_acctbal", "s_nationkey"], "count(*) FILTER (WHERE {c} < 0) AS negatives", "supplier")
    + " UNION ALL SELECT 'margin', count(*) FILTER (WHERE l_quantity * 1000 - l_extendedprice < 0)"
    " FROM lineitem",
)
def negative_checks(spark, sf_dir):
    suppliers = profile.negative_checks(
        read(spark, sf_dir, "supplier"), ["s_acctbal", "s_nationkey"]
    )
    margin = read(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") * 1000 - F.col("l_extendedprice")).alias("margin")
    )
    return suppliers.unionByName(profile.negative_checks(margin, ["margin"]))


@query(
    "numeric_profile",
    each(
        ["o_orderkey", "o_custkey", "o_totalprice"],
        """CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max",
        round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev""",
        "orders",
    ),
)
def numeric_profile(spark, sf_dir):
    return rounded(profile.numeric_profile(read(spark, sf_dir, "orders"), 3), 4, "mean", "stddev")


@query(
    "column_profile",
    "WITH " + HOLED + " " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(DISTINCT {c}) AS distinct_values,
            count(*) FILTER (WHERE {c} IS NULL) AS missing FROM holed"""
        for c, t in zip(HOLED_COLUMNS, ["bigint", *["double"] * 4, "string", "string"])
    ),
)
def column_profile(spark, sf_dir):
    return profile.column_profile(holed_items(spark, sf_dir))


@query(
    "categorical_profile",
    """SELECT 'l_returnflag' AS "column", count(DISTINCT l_returnflag) AS distinct_values,
              string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) AS "values"
       FROM lineitem
       UNION ALL SELECT 'l_linestatus', count(DISTINCT l_linestatus),
              string_agg(DISTINCT l_linestatus, ', ' ORDER BY l_linestatus) FROM lineitem""",
)
def categorical_profile(spark, sf_dir):
    return profile.categorical_profile(read(spark, sf_dir, "lineitem"), 2)


@query(
    "total_by_country",
    f"""WITH {star.CLEAN} SELECT "Country", sum("Yield_Value") AS total FROM clean_yield
    GROUP BY 1""",
)
def total_by_country(spark, sf_dir):
    return profile.total_by(clean.clean_yield(star.raw_yield(spark, sf_dir)), "Country", "Yield_Value")


@query(
    "total_by_crop",
    """SELECT p_brand AS "Crop", sum(l_quantity) AS total
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def total_by_crop(spark, sf_dir):
    items = star.sold_parts(spark, sf_dir)
    return profile.total_by(items, "Crop", "l_quantity").orderBy(F.desc("total"), "Crop")


@query(
    "count_by_country",
    f"""WITH {star.RAW} SELECT "Area", count(*) AS row_count FROM raw_yield GROUP BY 1""",
)
def count_by_country(spark, sf_dir):
    return profile.count_by(star.raw_yield(spark, sf_dir), "Area")


@query(
    "count_by_crop",
    """SELECT p_brand AS "Crop", count(*) AS row_count
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def count_by_crop(spark, sf_dir):
    return profile.count_by(star.sold_parts(spark, sf_dir), "Crop")


@query(
    "top_countries",
    f"""WITH {star.RAW} SELECT "Area", sum("Value") AS total FROM raw_yield GROUP BY 1
    ORDER BY total DESC, "Area" LIMIT 30""",
)
def top_countries(spark, sf_dir):
    return profile.top_totals(star.raw_yield(spark, sf_dir), "Area", "Value", 30)


@query("random_sample")
def random_sample(spark, sf_dir):
    return profile.random_sample(read(spark, sf_dir, "lineitem"), 10, seed=42)


@query(
    "quality_metrics",
    f"""WITH {star.PANEL_SQL}
    SELECT count(*) AS total_records, count(DISTINCT "Year") AS n_years,
           count(DISTINCT "Country") AS n_countries, count(DISTINCT "Crop") AS n_crops
    FROM panel""",
)
def quality_metrics(spark, sf_dir):
    return profile.quality_metrics(preprocess.integrated_panel(star.raw_tables(spark, sf_dir)))


@query(
    "dataset_summary",
    f"""WITH {star.RAW}
    SELECT count(*) AS total_records, count(DISTINCT "Area") AS n_areas,
           count(DISTINCT "Item") AS n_items, count(DISTINCT "Year") AS n_years,
           min("Year") AS min_year, max("Year") AS max_year,
           round(avg("Value"), 6) AS mean_target, min("Value") AS min_target,
           max("Value") AS max_target FROM raw_yield""",
)
def dataset_summary(spark, sf_dir):
    summary = profile.dataset_summary(star.raw_yield(spark, sf_dir), target="Value")
    return rounded(summary, 6, "mean_target")
