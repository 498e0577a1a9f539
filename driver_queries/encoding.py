"""Scaling, category codes, quantiles, imputation and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import query, read, rounded
from fieldpanel.operators import features

HASH = """CAST('0x' || substr(md5(l_orderkey || '|' || l_linenumber || '|' || l_partkey), 1, 8)
          AS BIGINT) % 100"""
SPLIT_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]


def holed(spark, sf_dir):
    """Line items with missing prices and labels, for imputation."""
    return read(spark, sf_dir, "lineitem").select(
        *SPLIT_KEY,
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_linestatus") != "F", F.col("l_quantity")).alias("label"),
    )


HOLED = f"""holed AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS price,
         CASE WHEN l_linestatus <> 'F' THEN l_quantity END AS label, {HASH} < 80 AS in_train
  FROM lineitem)"""


@query(
    "minmax_normalize",
    """SELECT o_orderkey, round((o_totalprice - low) / (high - low), 8) AS price_scaled
       FROM orders, (SELECT min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders)""",
)
def minmax_normalize(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    scaled = features.minmax_normalize(orders, {"o_totalprice": "price_scaled"})
    return rounded(scaled.drop("o_totalprice"), 8, "price_scaled")


@query(
    "standard_scale",
    """SELECT o_orderkey, round((o_totalprice - m) / s, 6) + 0.0 AS price_scaled
       FROM orders, (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders)""",
)
def standard_scale(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    scaled = features.standard_scale(orders, {"o_totalprice": "price_scaled"})
    return rounded(scaled.drop("o_totalprice"), 6, "price_scaled")


@query(
    "string_index",
    """SELECT p_partkey, p_type, p_brand, CAST(ti AS DOUBLE) AS type_index,
              CAST(bi AS DOUBLE) AS brand_index
       FROM part
       JOIN (SELECT p_type AS t, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS ti
             FROM part GROUP BY 1) ON p_type = t
       JOIN (SELECT p_brand AS b, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS bi
             FROM part GROUP BY 1) ON p_brand = b""",
)
def string_index(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    parts = features.string_index(parts, "p_type", "type_index")
    return features.string_index(parts, "p_brand", "brand_index")


@query(
    "label_encode",
    """WITH raw AS (SELECT p_partkey, CASE WHEN p_size = 7 THEN NULL ELSE p_brand END AS b
         FROM part),
       codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
         FROM (SELECT DISTINCT coalesce(b, 'Unknown') AS v FROM raw))
       SELECT p_partkey, v AS brand, code AS brand_code
       FROM raw JOIN codes ON v = coalesce(b, 'Unknown')""",
)
def label_encode(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") != 7, F.col("p_brand")).alias("brand")
    )
    train, test = features.hash_split(parts, ["p_partkey"])
    train, test = features.label_encode(train, test, "brand", "brand_code")
    return train.unionByName(test)


@query(
    "onehot_drop_first",
    """WITH codes AS (SELECT p_type AS t, row_number() OVER (ORDER BY p_type) - 1 AS code
         FROM (SELECT DISTINCT p_type FROM part))
       SELECT p_partkey, CASE WHEN code > 0 THEN CAST(code - 1 AS VARCHAR) ELSE 'none' END AS slot,
              p_type AS category, CASE WHEN code > 0 THEN 1.0::DOUBLE ELSE 0.0 END AS "value"
       FROM part JOIN codes ON p_type = t""",
)
def onehot_drop_first(spark, sf_dir):
    parts = read(spark, sf_dir, "part")
    slots = features.onehot_drop_first(parts, "p_type", ["p_partkey"])
    return slots.withColumn("slot", F.coalesce(F.col("slot").cast("string"), F.lit("none")))


@query(
    "quantile_cuts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS probability,
            quantile_disc({c}, {p}) AS cut FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice")
        for p in (0.33, 0.66)
    ),
)
def quantile_cuts(spark, sf_dir):
    """Exact cuts, found by closing in on their ranks."""
    return features.quantile_cuts(
        read(spark, sf_dir, "lineitem"),
        ["l_quantity", "l_extendedprice"],
        relative_error=0,
    )


@query(
    "discretize",
    """SELECT l_orderkey, l_linenumber, l_quantity,
         CASE WHEN l_quantity <= q1 THEN 'Low' WHEN l_quantity <= q2 THEN 'Medium'
              ELSE 'High' END AS quantity_category,
         CASE WHEN l_tax <= t1 THEN 'Cold' WHEN l_tax <= t2 THEN 'Temperate'
              ELSE 'Hot' END AS tax_category
       FROM lineitem, (SELECT quantile_disc(l_quantity, 0.33) AS q1,
         quantile_disc(l_quantity, 0.66) AS q2, quantile_disc(l_tax, 0.33) AS t1,
         quantile_disc(l_tax, 0.66) AS t2 FROM lineitem)""",
)
def discretize(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax"
    )
    return features.discretize(
        items,
        {
            "l_quantity": ("quantity_category", features.AMOUNT_LABELS),
            "l_tax": ("tax_category", features.TEMPERATURE_LABELS),
        },
        relative_error=0.0001,
    ).drop("l_tax")


@query(
    "mean_impute",
    f"""WITH {HOLED}, means AS (SELECT avg(price) AS m FROM holed WHERE in_train)
    SELECT l_orderkey, l_linenumber, l_partkey, in_train,
           round(coalesce(price, m), 4) AS price FROM holed, means""",
)
def mean_impute(spark, sf_dir):
    train, test = features.hash_split(holed(spark, sf_dir).drop("label"), SPLIT_KEY)
    full_train = features.mean_impute(train, ["price"]).withColumn("in_train", F.lit(True))
    full_test = features.mean_impute(test, ["price"], fit_on=train)
    both = full_train.unionByName(full_test.withColumn("in_train", F.lit(False)))
    return rounded(both, 4, "price")


@query(
    "label_impute",
    f"""WITH {HOLED}, means AS (SELECT in_train, avg(label) AS m FROM holed GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_partkey, h.in_train,
           round(coalesce(label, m), 4) AS label
    FROM holed h JOIN means ON h.in_train = means.in_train""",
)
def label_impute(spark, sf_dir):
    train, test = features.hash_split(holed(spark, sf_dir).drop("price"), SPLIT_KEY)
    train, test = features.label_impute(train, test, "label")
    both = train.withColumn("in_train", F.lit(True)).unionByName(
        test.withColumn("in_train", F.lit(False))
    )
    return rounded(both, 4, "label")


@query(
    "hash_split",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
        CASE WHEN {HASH} < 80 THEN 'train' ELSE 'test' END AS split FROM lineitem""",
)
def hash_split(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem").select(*SPLIT_KEY)
    train, test = features.hash_split(items, SPLIT_KEY)
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )


@query("random_split")
def random_split(spark, sf_dir):
    """Rows per side of Spark's own seeded split."""
    train, test = features.random_split(read(spark, sf_dir, "lineitem"))
    sides = [
        side.select(F.lit(name).alias("split")) for name, side in (("train", train), ("test", test))
    ]
    return sides[0].unionByName(sides[1]).groupBy("split").agg(F.count("*").alias("row_count"))


@query(
    "max_bins",
    """SELECT count(DISTINCT p_brand) AS n_p_brand, count(DISTINCT p_size) AS n_p_size,
       CAST(greatest(count(DISTINCT p_brand) + 1, count(DISTINCT p_size) + 1, 64) AS INTEGER)
         AS max_bins FROM part""",
)
def max_bins(spark, sf_dir):
    return features.max_bins(read(spark, sf_dir, "part"), ["p_brand", "p_size"])
