"""Linear regression of every penalty from one matrix of moments.

A single pass adds up the products of all pairs of features and label (a Gram matrix, summed in
the JVM over a tree of tasks). Least squares, ridge, lasso and elastic net, and any other
penalty later, are then solved on that matrix alone: in closed form without an absolute
penalty, by coordinate descent with one. The matrix has the square of the feature width, so
it is used up to ``MAX_WIDTH`` features; wider models are left to Spark's iterative solver.

With centred features z of deviation 1 and their coefficients g, the fit minimises

    |y - zg|^2 / (2 rows) + l1 * sum u|g| + l2 / 2 * sum (u g)^2

where u is 1, or 1 / deviation if penalties apply to the features as they are. Deviations are
those of the population. A feature without spread gets the coefficient 0.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.base import Estimator, Transformer
from pyspark.ml.common import _py2java
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegressionModel
from pyspark.ml.util import Identifiable
from pyspark.ml.wrapper import JavaParams
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, functions as F

MAX_WIDTH = 4096  # features; the matrix then has 128 MiB on the driver
SWEEPS = 20_000  # at most; a sweep passes over all coefficients once
PRECISE = 1e-12  # largest change of a sweep, in deviations of the label, that ends the descent


@dataclass(frozen=True)
class Moments:
    """Rows, means, population deviations, correlations, and covariances with the label."""

    rows: int
    mean: np.ndarray
    deviation: np.ndarray
    label_mean: float
    label_deviation: float
    correlation: np.ndarray
    with_label: np.ndarray  # of the features of deviation 1

    @classmethod
    def of_gram(cls, gram: np.ndarray) -> Moments:
        """From the Gram matrix of (features..., label, 1)."""
        rows = gram[-1, -1]
        mean = gram[-1, :-1] / rows
        centred = gram[:-1, :-1] / rows - np.outer(mean, mean)
        variance = np.diag(centred).copy()
        # what rounding leaves of a column without spread counts as none
        variance[variance <= 1e-12 * np.diag(gram)[:-1] / rows] = 0
        deviation = np.sqrt(variance)
        unit = np.divide(1, deviation, out=np.zeros_like(deviation), where=deviation > 0)
        correlation = centred[:-1, :-1] * np.outer(unit[:-1], unit[:-1])
        return cls(
            int(round(rows)), mean[:-1], deviation[:-1], float(mean[-1]), float(deviation[-1]),
            correlation, centred[:-1, -1] * unit[:-1],
        )


def moments(df: DataFrame, label: str, features: str = "features") -> Moments:
    """The moments of a feature vector and a label, in one pass over ``df``."""
    target = F.col(f"`{label}`").cast("double").alias("y")
    table = df.select(F.col(features).alias("x"), target, F.lit(1.0).alias("one"))
    if table.isEmpty():
        raise ValueError("no training rows")
    whole = VectorAssembler(inputCols=["x", "y", "one"], outputCol="v").transform(table)
    rows = MLUtils.convertVectorColumnsFromML(whole.select("v"), "v")
    return Moments.of_gram(RowMatrix(rows).computeGramianMatrix().toArray())


@dataclass(frozen=True)
class Penalty:
    """``l1`` and ``l2`` of the objective.

    ``l2_per_label`` divides ``l2`` by the label's deviation, as Spark does; ``standardize``
    says whether the penalties apply to the features of deviation 1.
    """

    l1: float = 0.0
    l2: float = 0.0
    l2_per_label: bool = True
    standardize: bool = True


def solve(known: Moments, penalty: Penalty) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) of the features as they are."""
    width = len(known.mean)
    spread = known.deviation > 0
    unit = np.divide(1, known.deviation, out=np.zeros(width), where=spread)
    weight = np.ones(width) if penalty.standardize else unit
    l1 = penalty.l1 * weight
    l2 = penalty.l2 * weight**2
    if penalty.l2_per_label and known.label_deviation > 0:
        l2 = l2 / known.label_deviation
    matrix = known.correlation + np.diag(l2)
    some = np.flatnonzero(spread)
    scaled = np.zeros(width)
    if known.label_deviation > 0 and len(some):
        part = matrix[np.ix_(some, some)]
        if penalty.l1 > 0:
            scaled[some] = _descend(
                part, known.with_label[some], l1[some], PRECISE * known.label_deviation
            )
        else:
            scaled[some] = np.linalg.lstsq(part, known.with_label[some], rcond=1e-13)[0]
    found = scaled * unit
    return found, float(known.label_mean - known.mean @ found)


def _descend(matrix: np.ndarray, target: np.ndarray, l1: np.ndarray, change: float) -> np.ndarray:
    """Coordinate descent: each coefficient in turn takes its best value, the others fixed."""
    found = np.zeros(len(target))
    rest = target.copy()  # target - matrix @ found
    diagonal = np.diag(matrix)
    for _ in range(SWEEPS):
        largest = 0.0
        for j in range(len(found)):
            reach = rest[j] + diagonal[j] * found[j]
            new = np.sign(reach) * max(abs(reach) - l1[j], 0.0) / diagonal[j]
            step = new - found[j]
            if step:
                rest -= matrix[:, j] * step
                found[j] = new
                largest = max(largest, abs(step))
        if largest <= change:
            break
    return found


class MomentRegression(Estimator):
    """A linear regression solved from moments; ``wide`` fits what is wider than MAX_WIDTH."""

    def __init__(
        self, label: str, penalty: Penalty, wide: Callable[[], Estimator], features: str = "features"
    ):
        super().__init__()
        self.label, self.penalty, self.wide, self.features = label, penalty, wide, features

    def fits(self, width: int) -> bool:
        return width <= MAX_WIDTH

    def model(self, known: Moments) -> LinearRegressionModel:
        """The fitted model, an ordinary one of Spark's: it scores, is saved and loaded."""
        from pyspark import SparkContext

        coefficients, intercept = solve(known, self.penalty)
        context = SparkContext._active_spark_context
        made = JavaParams._new_java_obj(
            "org.apache.spark.ml.regression.LinearRegressionModel",
            Identifiable._randomUID.__func__(LinearRegressionModel),
            _py2java(context, Vectors.dense(coefficients)),
            intercept,
        )
        found = LinearRegressionModel(made)
        return found.setFeaturesCol(self.features)

    def _fit(self, dataset: DataFrame) -> Transformer:
        width = dataset.schema[self.features].metadata["ml_attr"]["num_attrs"]
        if not self.fits(width):
            return self.wide().fit(dataset)
        return self.model(moments(dataset, self.label, self.features))
