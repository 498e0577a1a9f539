"""What SQL can state about trained models and random draws: properties of their results.

SQL cannot train a model, but it knows how many rows there are, that least squares with
an intercept and trees of means leave no residual on average, that means of labels stay
between the labels, and which rows a split or a sample may return.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries import modelling, star
from driver_queries.modelling import TABLE
from driver_queries.registry import exact, query, read
from fieldpanel.operators import features, profile, regression
from fieldpanel.staging import stage

KEYED_SQL = f"""{star.MODEL_SQL},
    keyed AS (SELECT "Country" || '|' || "Year" || '|' || "Crop" AS row_key FROM model_panel),
    sided AS (SELECT row_key,
      CAST('0x' || substr(md5(row_key), 1, 8) AS BIGINT) % 100 < 80 AS in_train FROM keyed)"""

AVERAGING = ("Decision Tree", "Random Forest")  # each prediction is a mean of training labels
BOOTSTRAPPED = ("Random Forest",)  # its trees see other rows, so residuals need not cancel


def training_fit(prepared, registry):
    """(model, n_train, mean_residual, label_range, beats_mean) on the training rows, in one pass.

    ``mean_residual`` is in deviations of the label, and NULL for forests. ``label_range``
    says whether predictions stay between the labels; it is open for models that may leave.
    """
    fitted, failed = regression.fit_all(prepared, registry)
    if failed:
        raise RuntimeError(f"models that could not be fitted: {failed}")
    scored, y = prepared.train, F.col(f"`{TABLE.target}`")
    mean = scored.agg(F.mean(y).alias("m")).first()["m"]
    rows = []
    for i, (name, model) in enumerate(fitted.items()):
        last = regression.regressor(model)
        scored = last.copy({last.predictionCol: f"p{i}"}).transform(scored)
        residual, p = y - F.col(f"p{i}"), F.col(f"p{i}")
        slack = F.stddev_pop(y) * 1e-9
        inside = (F.min(p) >= F.min(y) - slack) & (F.max(p) <= F.max(y) + slack)
        rows.append(
            F.struct(
                F.lit(name).alias("model"),
                F.count("*").alias("n_train"),
                (F.lit(None).cast("double") if name in BOOTSTRAPPED
                 else exact(F.mean(residual) / F.stddev_pop(y), 4)).alias("mean_residual"),
                (F.when(inside, "inside").otherwise("outside") if name in AVERAGING
                 else F.lit("open")).alias("label_range"),
                (F.sum(residual**2) <= F.sum((y - mean) ** 2)).alias("beats_mean"),
            )
        )
    return scored.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def training_fit_sql(names):
    listed = ", ".join(
        f"('{n}', {'NULL' if n in BOOTSTRAPPED else '0.0'}, "
        f"'{'inside' if n in AVERAGING else 'open'}')"
        for n in names
    )
    return f"""WITH {KEYED_SQL}, models(model, mean_residual, label_range) AS (VALUES {listed})
    SELECT model, n_train, CAST(mean_residual AS DOUBLE) AS mean_residual,
           label_range, TRUE AS beats_mean
    FROM models, (SELECT count(*) AS n_train FROM sided WHERE in_train)"""


@query("fit_onehot_models", training_fit_sql(regression.onehot_models()))
def fit_onehot_models(spark, sf_dir):
    """All seven models over one-hot features, on the rows they were trained from."""
    return training_fit(*modelling.prepared_onehot(spark, sf_dir))


@query("fit_scaled_models", training_fit_sql(regression.scaled_models(TABLE.target, 1)))
def fit_scaled_models(spark, sf_dir):
    """The four models over scaled features, on the rows they were trained from."""
    return training_fit(*modelling.prepared_scaled(spark, sf_dir))


@query(
    "importance_totals",
    """SELECT model, CAST(6 AS BIGINT) AS n_features, CAST(6 AS BIGINT) AS n_ranks,
           CAST(1 AS DOUBLE) AS total, TRUE AS ordered
    FROM (VALUES ('Decision Tree'), ('Random Forest'), ('Gradient Boosting')) AS m(model)""",
)
def importance_totals(spark, sf_dir):
    """Importances of a model are shares of 1 over all input columns, largest first."""
    found = modelling.feature_importance(spark, sf_dir)
    falling = F.array_sort(F.collect_list(F.struct("rank", (-F.col("importance")).alias("less"))))
    values = F.transform(falling, lambda pair: pair["less"])
    return found.groupBy("model").agg(
        F.count_distinct("feature").alias("n_features"),
        F.count_distinct("rank").alias("n_ranks"),
        exact(F.sum("importance"), 9).alias("total"),
        (values == F.array_sort(values)).alias("ordered"),
    )


@query(
    "scored_rows",
    f"WITH {KEYED_SQL} SELECT row_key, TRUE AS in_range FROM sided WHERE NOT in_train",
)
def scored_rows(spark, sf_dir):
    """Every held-out row is scored once, by the tree, between the labels of the training rows."""
    _, train, test = modelling.splits(spark, sf_dir)
    prepared = regression.prepare(train, test, regression.onehot_features(TABLE), TABLE)
    tree = regression.onehot_models(TABLE.target)["Decision Tree"]()
    model = regression.fit_model(prepared, tree)
    y = F.col(f"`{TABLE.target}`")
    row = prepared.train.agg(F.min(y).alias("low"), F.max(y).alias("high")).first()
    slack = 1e-9 * max(abs(row["low"]), abs(row["high"]))
    scored = regression.batch_score(model, test.select("row_key", *TABLE.features))
    inside = F.col("prediction").between(row["low"] - slack, row["high"] + slack)
    return scored.select("row_key", inside.alias("in_range"))


@query(
    "random_split_parts",
    """SELECT l_orderkey, count(*) AS row_count, CAST(sum(l_linenumber) AS BIGINT) AS line_sum
    FROM lineitem GROUP BY 1""",
)
def random_split_parts(spark, sf_dir):
    """Both sides of the random split together hold every row once: rows and lines per order."""
    train, test = features.random_split(read(spark, sf_dir, "lineitem"))
    return train.unionByName(test).groupBy("l_orderkey").agg(
        F.count("*").alias("row_count"), F.sum("l_linenumber").alias("line_sum")
    )


@query(
    "random_sample_members",
    "SELECT least(10, count(*)) AS n_rows, CAST(0 AS BIGINT) AS n_foreign FROM lineitem",
)
def random_sample_members(spark, sf_dir):
    """Every sampled row is a row of the table."""
    items = read(spark, sf_dir, "lineitem")
    sample = stage(profile.random_sample(items, 10, seed=42), "sample")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in items.columns]
    members = items.alias("a").join(F.broadcast(sample.alias("b")), same, "left_semi")  # ten rows
    foreign = sample.subtract(members).agg(F.count("*").alias("n_foreign"))
    return sample.agg(F.count("*").alias("n_rows")).withColumn(
        "n_foreign", F.lit(foreign.first()["n_foreign"]).cast("long")
    )
