"""Correlations, their ranking and what is read from it."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries import star
from driver_queries.registry import query, read, rounded
from fieldpanel.operators import correlate, features
from fieldpanel.plans import preprocess
from fieldpanel.staging import stage

ITEM_FEATURES = ["l_extendedprice", "l_discount", "l_tax", "l_linenumber"]

# Supplier and order figures per line item: some depend on each other by design.
SALES = """sales AS (
  SELECT l_extendedprice * (1 - l_discount) AS revenue, l_quantity, l_extendedprice, l_discount,
         l_tax, CASE WHEN l_returnflag <> 'R' THEN l_quantity * l_tax END AS taxed
  FROM lineitem)"""
SALES_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "taxed"]


def sales(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity") * F.col("l_tax")).alias("taxed"),
    )


def corr_rows(target, columns, source):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(corr({target}, {c}), 6) + 0.0 AS corr FROM {source}"
        for c in columns
    )


RANKING = f"""WITH {SALES}, correlations AS ({corr_rows('revenue', SALES_FEATURES, 'sales')}),
ranking AS (
  SELECT CAST(row_number() OVER (ORDER BY abs(corr) DESC, feature) AS INTEGER) AS rank,
         feature, corr, abs(corr) AS abs_corr,
         CASE WHEN abs(corr) > 0.3 THEN 'Strong' WHEN abs(corr) > 0.1 THEN 'Moderate'
              WHEN abs(corr) > 0.05 THEN 'Weak' ELSE 'Very weak' END AS strength,
         CASE WHEN corr > 0 THEN 'positive' ELSE 'negative' END AS direction
  FROM correlations)"""


def ranking(spark, sf_dir):
    found = correlate.target_correlations(sales(spark, sf_dir), "revenue", SALES_FEATURES)
    return correlate.rank_correlations(rounded(found, 6, "corr"))


@query("target_correlations", corr_rows("l_quantity", ITEM_FEATURES, "lineitem"))
def target_correlations(spark, sf_dir):
    found = correlate.target_correlations(
        read(spark, sf_dir, "lineitem"), "l_quantity", ITEM_FEATURES
    )
    return rounded(found, 6, "corr")


INDEXED_FEATURES = [
    "Yield", "Rainfall", "Pesticides", "Avg_Temperature", "Country_Index", "Crop_Index",
]


def matrix_rows(columns, source):
    return " UNION ALL ".join(
        f"""SELECT '{a}' AS col_i, '{b}' AS col_j, round(corr("{a}", "{b}"), 6) + 0.0 AS corr
            FROM {source}"""
        for a in columns
        for b in columns
    )


@query(
    "correlation_matrix",
    f"""WITH {star.PANEL_SQL},
    by_country AS (SELECT "Country", row_number() OVER (ORDER BY count(*) DESC, "Country") - 1
      AS "Country_Index" FROM panel GROUP BY 1),
    by_crop AS (SELECT "Crop", row_number() OVER (ORDER BY count(*) DESC, "Crop") - 1
      AS "Crop_Index" FROM panel GROUP BY 1),
    indexed AS (SELECT * FROM panel JOIN by_country USING ("Country") JOIN by_crop USING ("Crop"))
    {matrix_rows(INDEXED_FEATURES, 'indexed')}""",
)
def correlation_matrix(spark, sf_dir):
    """The six-feature matrix of the panel, category indexes included."""
    panel = stage(preprocess.integrated_panel(star.raw_tables(spark, sf_dir)), "panel")
    for label, index in preprocess.INDEXED.items():
        panel = features.string_index(panel, label, index)
    return rounded(correlate.correlation_matrix(panel, INDEXED_FEATURES), 6, "corr")


@query("numeric_corr", f"WITH {SALES} {matrix_rows(['revenue', *SALES_FEATURES], 'sales')}")
def numeric_corr(spark, sf_dir):
    """All numeric columns, each pair over the rows in which both have a value."""
    return rounded(correlate.correlation_matrix(sales(spark, sf_dir)), 6, "corr")


@query("correlation_ranking", f"{RANKING} SELECT * FROM ranking")
def correlation_ranking(spark, sf_dir):
    return ranking(spark, sf_dir)


@query(
    "feature_selection",
    f"""{RANKING} SELECT feature, abs_corr FROM ranking WHERE abs_corr > 0.1
    UNION ALL SELECT 'revenue', CAST(1 AS DOUBLE)""",
)
def feature_selection(spark, sf_dir):
    return correlate.select_features(ranking(spark, sf_dir), "revenue")


@query(
    "strongest_feature",
    f"""{RANKING} SELECT feature, corr, abs_corr > 0.3 AS strong_predictor,
    abs_corr > 0.1 AND abs_corr <= 0.3 AS meaningful_power FROM ranking WHERE rank = 1""",
)
def strongest_feature(spark, sf_dir):
    return correlate.strongest_feature(ranking(spark, sf_dir))


@query(
    "weak_env_flag",
    f"""WITH {star.PANEL_SQL}
    SELECT abs(corr("Yield", "Rainfall")) < 0.1 AND abs(corr("Yield", "Avg_Temperature")) < 0.1
      AS weak_environment FROM panel""",
)
def weak_env_flag(spark, sf_dir):
    panel = preprocess.integrated_panel(star.raw_tables(spark, sf_dir))
    ranked = correlate.correlation_ranking(
        panel, "Yield", ["Rainfall", "Pesticides", "Avg_Temperature"]
    )
    return correlate.weak_environment(ranked)
