"""Key standardization and comparison, distinct values and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries import star
from driver_queries.registry import query, read
from fieldpanel.functions.country_aliases import COUNTRY_ALIASES
from fieldpanel.operators import keys
from fieldpanel.plans import preprocess

TABLES = ("rainfall", "pesticides", "yield", "temp")
N_ALIASES = len(COUNTRY_ALIASES)


def sources(prefix):
    return ", ".join(
        f"""{t}_keys AS (SELECT DISTINCT "Country" AS key FROM {prefix}_{t}
            WHERE "Country" IS NOT NULL)"""
        for t in TABLES
    )


def presence(prefix):
    union = " UNION ALL ".join(f"SELECT key FROM {t}_keys" for t in TABLES)
    return f"""{sources(prefix)},
    presence AS (SELECT key, count(*) AS n_datasets FROM ({union}) GROUP BY key)"""


def counts(name, prefix):
    parts = " UNION ALL ".join(
        f"""SELECT '{t}' AS dataset, count(DISTINCT "Country") AS n_keys FROM {prefix}_{t}"""
        for t in TABLES
    )
    shared = " INTERSECT ".join(f'SELECT "Country" FROM {prefix}_{t}' for t in TABLES)
    return f"""{name} AS ({parts} UNION ALL
      SELECT '(common)', count(*) FROM ({shared}))"""


def cleaned(spark, sf_dir):
    tables = preprocess.cleaned_tables(star.raw_tables(spark, sf_dir))
    return {t: tables[t] for t in TABLES}


def standardized(spark, sf_dir):
    tables = preprocess.standardized_tables(star.raw_tables(spark, sf_dir))
    return {t: tables[t] for t in TABLES}


# Every customer under one of the known spellings, some in other case or with blanks.
@query(
    "standardize_keys",
    f"""WITH aliases(alias, canonical) AS (VALUES {star.ALIAS_ROWS}),
    numbered AS (SELECT *, row_number() OVER (ORDER BY alias) - 1 AS n FROM aliases),
    raw AS (
      SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN ' ' || upper(alias) || '  '
        WHEN c_custkey % 3 = 1 THEN alias ELSE n_name END AS name
      FROM customer JOIN nation ON c_nationkey = n_nationkey
      JOIN numbered ON n = c_custkey % {N_ALIASES})
    SELECT c_custkey, name, coalesce(canonical, lower(trim(name))) AS country
    FROM raw LEFT JOIN aliases ON alias = lower(trim(name))""",
)
def standardize_keys(spark, sf_dir):
    spellings = F.array(*[F.lit(a) for a in sorted(COUNTRY_ALIASES)])
    alias = F.element_at(spellings, (F.col("c_custkey") % N_ALIASES).cast("int") + 1)
    kind = F.col("c_custkey") % 3
    named = (
        read(spark, sf_dir, "customer")
        .join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            F.when(kind == 0, F.concat(F.lit(" "), F.upper(alias), F.lit("  ")))
            .when(kind == 1, alias)
            .otherwise(F.col("n_name"))
            .alias("name"),
        )
    )
    return keys.standardize_keys(named, "name", out="country")


@query(
    "standardize_audit",
    f"""WITH {star.STANDARD}, {counts('before_counts', 'clean')}, {counts('after_counts', 'std')}
    SELECT b.dataset, b.n_keys AS before, a.n_keys AS after
    FROM before_counts b JOIN after_counts a ON b.dataset = a.dataset""",
)
def standardize_audit(spark, sf_dir):
    return keys.standardize_audit(cleaned(spark, sf_dir))


@query(
    "common_keys",
    f"""WITH {star.STANDARD}
    SELECT "Country" AS key FROM std_rainfall INTERSECT SELECT "Country" FROM std_pesticides
    INTERSECT SELECT "Country" FROM std_yield INTERSECT SELECT "Country" FROM std_temp""",
)
def common_keys(spark, sf_dir):
    return keys.common_keys(standardized(spark, sf_dir), "Country")


@query(
    "keys_in_at_least",
    f"""WITH {star.STANDARD}, {presence('std')}
    SELECT key, CAST(n_datasets AS INTEGER) AS n_datasets FROM presence WHERE n_datasets >= 3""",
)
def keys_in_at_least(spark, sf_dir):
    return keys.keys_in_at_least(standardized(spark, sf_dir), "Country", 3)


@query("key_counts", f"WITH {star.CLEAN}, {counts('found', 'clean')} SELECT * FROM found")
def key_counts(spark, sf_dir):
    return keys.key_counts(cleaned(spark, sf_dir), "Country")


@query(
    "duplicate_count",
    """WITH copies AS (SELECT count(*) AS n FROM lineitem
       GROUP BY l_suppkey, l_quantity, l_returnflag, l_linestatus)
       SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_rows,
              CAST(sum(n - 1) AS BIGINT) AS duplicates FROM copies""",
)
def duplicate_count(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem")
    return keys.duplicate_count(
        items.select("l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")
    )


@query("sorted_distinct", "SELECT DISTINCT p_name FROM part ORDER BY p_name")
def sorted_distinct(spark, sf_dir):
    return keys.sorted_distinct(read(spark, sf_dir, "part"), "p_name")
