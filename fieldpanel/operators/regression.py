"""Regression models as Spark ML pipelines."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.feature import (
    ElementwiseProduct,
    FeatureHasher,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, functions as F

from fieldpanel.operators.evaluate import metrics_of_many
from fieldpanel.operators.features import max_bins
from fieldpanel.operators.linear import MomentRegression, Moments, Penalty, moments
from fieldpanel.operators.profile import column, distinct_numbers
from fieldpanel.staging import stage, staging_path

# Columns of the modelling table.
CATEGORICAL = ("Area", "Item")
NUMERIC = ("Year", "average_rain_fall_mm_per_year", "pesticides_tonnes", "avg_temp")
TARGET = "hg/ha_yield"

# A fitted pipeline keeps the labels of indexed categories, and a coefficient per label, on the
# driver. Columns with more labels than this are hashed into slots instead.
MAX_CATEGORIES = 1_000_000
HASH_SLOTS = 1 << 14
FITS_AT_ONCE = 4  # models fitted side by side


@dataclass(frozen=True)
class ModelTable:
    """Which columns are features and which is the label."""

    categorical: Sequence[str] = CATEGORICAL
    numeric: Sequence[str] = NUMERIC
    target: str = TARGET
    logical: Mapping[str, str] = field(default_factory=dict)  # display names

    @property
    def features(self) -> list[str]:
        return [*self.categorical, *self.numeric]


def wide_categories(
    df: DataFrame, columns: Sequence[str], most: int = MAX_CATEGORIES
) -> list[str]:
    """The columns with more than ``most`` labels, by an exact distributed count."""
    return [c for c, n in distinct_numbers(df, columns).items() if n > most]


def check_categories(train: DataFrame, columns: Sequence[str], most: int = MAX_CATEGORIES) -> None:
    """Refuse category columns too wide for a pipeline that indexes every label."""
    wide = wide_categories(train, columns, most)
    if wide:
        raise ValueError(f"more than {most} categories: {', '.join(wide)}")


def hashers(columns: Sequence[str], outputs: Sequence[str], slots: int) -> list[FeatureHasher]:
    """One stage per column that sets the slot its label hashes to; NULL sets none."""
    return [
        FeatureHasher(inputCols=[c], outputCol=out, numFeatures=slots)
        for c, out in zip(columns, outputs)
    ]


def hash_collisions(df: DataFrame, columns: Sequence[str], slots: int = HASH_SLOTS) -> DataFrame:
    """(column, labels, slots_used, colliding, collision_rate) of hashed category columns.

    ``colliding`` counts the labels that share their slot with another. Each distinct label is
    hashed once, by the stage the models use.
    """
    parts = []
    for c, stage_ in zip(columns, hashers(columns, ["_slot"] * len(columns), slots)):
        labels = df.select(column(c)).filter(column(c).isNotNull()).distinct()
        # the text of a sparse vector is (size,[slots],[values])
        slot = F.regexp_extract(F.col("_slot").cast("string"), r"\[(\d+)\]", 1)
        parts.append(
            stage_.transform(labels).groupBy(slot.alias("slot")).agg(F.count("*").alias("n"))
            .agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("labels"),
                F.count("*").alias("slots_used"),
                F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("colliding"),
            )
            .select(
                F.lit(c).alias("column"), "labels", "slots_used", "colliding",
                F.coalesce(F.try_divide("colliding", "labels"), F.lit(0.0)).alias("collision_rate"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def onehot_features(
    table: ModelTable, hashed: Sequence[str] = (), slots: int = HASH_SLOTS
) -> Pipeline:
    """Indexers, one-hot encoders and the assembler; unseen labels keep a slot of their own.

    Category columns in ``hashed`` get hashed slots: nothing is learnt of their labels.
    """
    indexed = [c for c in table.categorical if c not in hashed]
    stages: list = hashers(hashed, [f"{c}Vec" for c in hashed], slots)
    if indexed:
        numbers = [f"{c}Index" for c in indexed]
        stages += [
            StringIndexer(inputCols=indexed, outputCols=numbers, handleInvalid="keep"),
            OneHotEncoder(inputCols=numbers, outputCols=[f"{c}Vec" for c in indexed]),
        ]
    vectors = [f"{c}Vec" for c in table.categorical]
    assembler = VectorAssembler(inputCols=[*vectors, *table.numeric], outputCol="features")
    return Pipeline(stages=[*stages, assembler])


class WithoutLastSlot(Estimator):
    """Fits a stage that cuts the last slot off a vector; a single slot becomes 0."""

    def __init__(self, vector: str, out: str):
        super().__init__()
        self.vector, self.out = vector, out

    def _fit(self, dataset: DataFrame) -> Transformer:
        size = dataset.schema[self.vector].metadata["ml_attr"]["num_attrs"]
        if size == 1:
            zero = Vectors.dense([0.0])
            return ElementwiseProduct(inputCol=self.vector, outputCol=self.out, scalingVec=zero)
        kept = list(range(size - 1))
        return VectorSlicer(inputCol=self.vector, outputCol=self.out, indices=kept)


def scaled_features(
    table: ModelTable, train_rows: int, hashed: Sequence[str] = (), slots: int = HASH_SLOTS
) -> Pipeline:
    """Numbers scaled to population deviation 1 beside one-hot slots without the first label.

    Indexing in descending text order puts the alphabetically first label into the
    last slot, which is left out. The slot of labels unseen in training is dropped
    by the encoder, so such rows have 0 in all slots. Spark scales by the sample
    deviation; the constant factor turns that into the population deviation. Category columns
    in ``hashed`` get hashed slots, all of which stay.
    """
    indexed = [c for c in table.categorical if c not in hashed]
    stages: list = hashers(hashed, [f"{c}Vec" for c in hashed], slots)
    if indexed:
        numbers = [f"{c}Index" for c in indexed]
        slotted = [f"{c}Slots" for c in indexed]
        stages += [
            StringIndexer(
                inputCols=indexed,
                outputCols=numbers,
                stringOrderType="alphabetDesc",
                handleInvalid="keep",
            ),
            OneHotEncoder(inputCols=numbers, outputCols=slotted, dropLast=True),
            *[WithoutLastSlot(a, f"{c}Vec") for a, c in zip(slotted, indexed)],
        ]
    correction = float(np.sqrt(train_rows / max(train_rows - 1, 1)))
    vectors = [f"{c}Vec" for c in table.categorical]
    return Pipeline(
        stages=[
            *stages,
            VectorAssembler(inputCols=list(table.numeric), outputCol="numbers"),
            StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
            ElementwiseProduct(
                inputCol="scaled",
                outputCol="standard",
                scalingVec=Vectors.dense([correction] * len(table.numeric)),
            ),
            VectorAssembler(inputCols=["standard", *vectors], outputCol="features"),
        ]
    )


# --- registries ------------------------------------------------------------


def onehot_models(target: str = TARGET, bins: int = 64) -> dict[str, Callable[[], Estimator]]:
    """The Spark ML line-up: name -> estimator over one-hot features."""
    trees = {"labelCol": target, "seed": 42, "maxBins": bins}

    def linear(reg: float, share: float) -> Callable[[], Estimator]:
        wide = partial(LinearRegression, labelCol=target, regParam=reg, elasticNetParam=share)
        penalty = Penalty(l1=reg * share, l2=reg * (1 - share))
        return partial(MomentRegression, target, penalty, wide)

    return {
        "Linear Regression": linear(0.01, 0.0),
        "Ridge Regression": linear(0.1, 0.0),
        "Lasso Regression": linear(0.01, 1.0),
        "Elastic Net": linear(0.05, 0.5),
        "Decision Tree": partial(DecisionTreeRegressor, maxDepth=10, **trees),
        "Random Forest": partial(RandomForestRegressor, maxDepth=10, numTrees=50, **trees),
        "Gradient Boosting": partial(GBTRegressor, maxIter=50, maxDepth=6, **trees),
    }


def scaled_models(target: str, train_rows: int) -> dict[str, Callable[[], Estimator]]:
    """The line-up over scaled features, with penalties per the usual alpha = 1.

    The lasso penalty is per row as it is. The ridge penalty applies to the sum of
    squares, so its share per row is 1 / rows.
    """
    plain = {"l2_per_label": False, "standardize": False}
    wide = partial(LinearRegression, labelCol=target, standardization=False)
    ridge = Penalty(l2=1.0 / train_rows, **plain)
    return {
        "Linear Regression": partial(MomentRegression, target, Penalty(), partial(wide)),
        "Lasso": partial(
            MomentRegression, target, Penalty(l1=1.0, **plain),
            partial(wide, regParam=1.0, elasticNetParam=1.0),
        ),
        "Ridge": partial(MomentRegression, target, ridge, partial(WideRidge, target, train_rows)),
        "Decision Tree": partial(DecisionTreeRegressor, labelCol=target, maxDepth=30, seed=0),
    }


class WideRidge(Estimator):
    """Spark's iterative ridge; it divides the penalty by the label's deviation while solving."""

    def __init__(self, label: str, train_rows: int):
        super().__init__()
        self.label, self.train_rows = label, train_rows

    def _fit(self, dataset: DataFrame) -> Transformer:
        deviation = dataset.agg(F.stddev(F.col(f"`{self.label}`")).alias("s")).first()["s"] or 0.0
        return LinearRegression(
            labelCol=self.label, regParam=deviation / self.train_rows, elasticNetParam=0.0,
            standardization=False, solver="l-bfgs",
        ).fit(dataset)


def tree_bins(df: DataFrame, table: ModelTable = ModelTable(), most: int = MAX_CATEGORIES) -> int:
    """The tree bin count that fits the categories; hashed ones are slots and need none."""
    counts = distinct_numbers(df, table.categorical)
    return max_bins(df, [c for c, n in counts.items() if n <= most]).first()["max_bins"]


# --- fitting ---------------------------------------------------------------


@dataclass(frozen=True)
class Prepared:
    """Feature vectors of both splits, computed once and written for all models."""

    encoder: PipelineModel
    train: DataFrame
    test: DataFrame
    target: str
    _known: dict[str, Moments] = field(default_factory=dict, repr=False, compare=False)
    _lock: object = field(default_factory=threading.Lock, repr=False, compare=False)

    @property
    def width(self) -> int:
        return self.train.schema["features"].metadata["ml_attr"]["num_attrs"]

    def moments(self) -> Moments:
        """The training moments, from the first model that asks: one pass for all of them."""
        with self._lock:
            if not self._known:
                self._known["train"] = moments(self.train, self.target)
            return self._known["train"]


def prepare(
    train: DataFrame,
    test: DataFrame,
    features: Pipeline | Callable[..., Pipeline],
    table: ModelTable = ModelTable(),
    most: int = MAX_CATEGORIES,
) -> Prepared:
    """Fit the feature stages on ``train`` only and write both feature tables.

    ``features`` may be a function of ``hashed``, the columns with more than ``most`` labels;
    stages that were made already must index every label, so wide columns are refused.
    """
    if isinstance(features, Pipeline):
        check_categories(train, table.categorical, most)
    else:
        features = features(hashed=wide_categories(train, table.categorical, most))
    encoder = features.fit(train)
    columns = ["features", F.col(f"`{table.target}`").cast("double").alias(table.target)]
    return Prepared(
        encoder,
        stage(encoder.transform(train).select(*columns), "train_features"),
        stage(encoder.transform(test).select(*columns), "test_features"),
        table.target,
    )


def fit_model(prepared: Prepared, estimator: Estimator) -> PipelineModel:
    """The feature stages and one fitted regressor as a single scoring pipeline."""
    if isinstance(estimator, MomentRegression) and estimator.fits(prepared.width):
        fitted = estimator.model(prepared.moments())
    else:
        fitted = estimator.fit(prepared.train)
    return PipelineModel(stages=[*prepared.encoder.stages, fitted])


def regressor(model: PipelineModel) -> Transformer:
    return model.stages[-1]


def fit_all(
    prepared: Prepared,
    registry: Mapping[str, Callable[[], Estimator]],
    at_once: int = FITS_AT_ONCE,
) -> tuple[dict[str, PipelineModel], dict[str, str]]:
    """Fit every model, ``at_once`` of them side by side.

    Each fit has its own thread, job group and scheduler pool, so one that waits for its last
    tasks leaves the cluster to the others (with ``spark.scheduler.mode`` FAIR they also share
    it evenly). A model that its data or parameters rule out is reported and does not stop the
    others; failures of the cluster pass on once the running fits have ended.
    """
    context = prepared.train.sparkSession.sparkContext

    def fit(name: str) -> PipelineModel | str:
        context.setLocalProperty("spark.scheduler.pool", f"fit {name}")
        context.setJobGroup(f"fit {name}", f"fit {name}", interruptOnCancel=False)
        try:
            return fit_model(prepared, registry[name]())
        except (PySparkException, ValueError) as error:
            return f"{type(error).__name__}: {error}".splitlines()[0]

    fitted: dict[str, PipelineModel] = {}
    failed: dict[str, str] = {}
    with ThreadPoolExecutor(max(at_once, 1)) as pool:
        waiting = {
            name: pool.submit(inheritable_thread_target(prepared.train.sparkSession)(fit), name)
            for name in registry
        }
    for name, done in waiting.items():
        found = done.result()
        if isinstance(found, str):
            failed[name] = found
        else:
            fitted[name] = found
    return fitted, failed


def evaluate_all(prepared: Prepared, models: Mapping[str, PipelineModel]) -> DataFrame:
    """(model, r2, mae, rmse) of every model from one pass over the test features."""
    scored = prepared.test
    columns = {}
    for i, (name, model) in enumerate(models.items()):
        columns[name] = f"prediction_{i}"
        fitted = regressor(model).copy({regressor(model).predictionCol: columns[name]})
        scored = fitted.transform(scored)
    return metrics_of_many(scored, prepared.target, columns)


def compare_models(
    prepared: Prepared, registry: Mapping[str, Callable[[], Estimator]]
) -> DataFrame:
    """(model, r2, mae, rmse, error), one row per registered model."""
    fitted, failed = fit_all(prepared, registry)
    spark = prepared.train.sparkSession
    schema = "model string, r2 double, mae double, rmse double, error string"
    result = spark.createDataFrame(
        [(name, None, None, None, reason) for name, reason in failed.items()], schema
    )
    if fitted:
        metrics = evaluate_all(prepared, fitted)
        result = metrics.withColumn("error", F.lit(None).cast("string")).unionByName(result)
    return result


def batch_score(model: PipelineModel, requests: DataFrame) -> DataFrame:
    """Predict for a table of feature rows: all request columns plus the prediction."""
    return model.transform(requests).select(*requests.columns, "prediction")


# --- interpretation --------------------------------------------------------


def slot_names(scored: DataFrame, features: str = "features") -> list[str]:
    """Name of every feature vector slot, from the assembler's column metadata."""
    attributes = scored.schema[features].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for group in attributes.values() for a in group)
    return [name for _, name in slots]


def logical_feature(slot: str, table: ModelTable) -> str:
    """The input column a slot was made from."""
    for c in table.categorical:
        if slot.startswith(f"{c}Vec_"):
            return c
    return slot


def coefficients(
    model: PipelineModel, prepared: Prepared, table: ModelTable = ModelTable()
) -> DataFrame:
    """(slot, feature, name, coefficient, direction, magnitude) of a linear model."""
    values = regressor(model).coefficients.toArray()
    rows = [
        (
            i,
            logical_feature(name, table),
            name,
            float(value),
            "increases" if value > 0 else "decreases",
            float(abs(value)),
        )
        for i, (name, value) in enumerate(zip(slot_names(prepared.train), values))
    ]
    return prepared.train.sparkSession.createDataFrame(
        rows,
        "slot int, feature string, name string, coefficient double, direction string, "
        "magnitude double",
    )


def feature_importance(
    models: Mapping[str, PipelineModel], prepared: Prepared, table: ModelTable = ModelTable()
) -> DataFrame:
    """(model, feature, importance, rank): one-hot slots summed to their input column."""
    names = slot_names(prepared.train)
    rows = []
    for model_name, model in models.items():
        sums = dict.fromkeys(table.features, 0.0)
        for slot, value in enumerate(regressor(model).featureImportances.toArray()):
            sums[logical_feature(names[slot], table)] += float(value)
        ranked = sorted(sums.items(), key=lambda item: (-item[1], item[0]))
        rows += [(model_name, f, v, i) for i, (f, v) in enumerate(ranked, 1)]
    return prepared.train.sparkSession.createDataFrame(
        rows, "model string, feature string, importance double, rank int"
    )


def tree_shape(models: Mapping[str, PipelineModel], spark) -> DataFrame:
    """(model, depth, nodes) of single-tree models."""
    rows = [(n, regressor(m).depth, regressor(m).numNodes) for n, m in models.items()]
    return spark.createDataFrame(rows, "model string, depth int, nodes int")


def tree_splits(
    models: Mapping[str, PipelineModel], prepared: Prepared, table: ModelTable = ModelTable()
) -> DataFrame:
    """(model, tree, node, name, feature, threshold, values, gain, rows, prediction, low, high).

    One row per node; leaves have no name and no children. ``rows`` are the training rows of the
    node, ``low`` and ``high`` its child nodes: values up to ``threshold`` go to ``low``, or those
    in ``values`` where the feature is a one-hot slot. The nodes are read from the models as
    they are saved, so a large forest stays a table.
    """
    spark = prepared.train.sparkSession
    names = slot_names(prepared.train)
    slots = F.broadcast(  # as wide as the feature vector
        spark.createDataFrame(
            [(i, n, logical_feature(n, table)) for i, n in enumerate(names)],
            "slot int, name string, feature string",
        )
    )
    parts = []
    for model_name, model in models.items():
        path = staging_path(spark, "tree")
        regressor(model).write().overwrite().save(path)
        data = spark.read.parquet(f"{path}/data")
        single = "nodeData" not in data.columns
        node = (lambda c: F.col(c)) if single else (lambda c: F.col(f"nodeData.{c}"))
        split, inner = node("split"), node("leftChild") >= 0
        number = split["numCategories"] < 0
        parts.append(
            data.select(
                F.lit(model_name).alias("model"),
                (F.lit(0) if single else F.col("treeID")).alias("tree"),
                node("id").alias("node"),
                F.when(inner, split["featureIndex"]).alias("slot"),
                F.when(inner & number, F.get(split["leftCategoriesOrThreshold"], 0)).alias(
                    "threshold"
                ),
                F.when(inner & ~number, split["leftCategoriesOrThreshold"]).alias("values"),
                F.when(inner, node("gain")).alias("gain"),
                node("rawCount").alias("rows"),
                node("prediction").alias("prediction"),
                F.when(inner, node("leftChild")).alias("low"),
                F.when(inner, node("rightChild")).alias("high"),
            )
        )
    return reduce(DataFrame.unionByName, parts).join(slots, "slot", "left").select(
        "model", "tree", "node", "name", "feature", "threshold", "values", "gain", "rows",
        "prediction", "low", "high",
    )
