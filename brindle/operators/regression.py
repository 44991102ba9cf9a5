"""Linear regression on labelled points `label, features`.

For squared error the gradient and the loss at any weights follow from the second moments of
`[label, features]`. These are taken once, by one distributed aggregation for all splits; descent
and grid search then work on a `d x d` matrix instead of scanning the data at every step.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.functions.arrays import dot
from brindle.operators.grouping import hash_split
from brindle.operators.moments import Moments, moments_by
from brindle.session import materialize

TRAIN, VALIDATION, TEST = 0, 1, 2


def label_range(points: DataFrame) -> DataFrame:
    return points.agg(F.min("label").alias("min_label"), F.max("label").alias("max_label"))


def shift_labels(points: DataFrame) -> DataFrame:
    """Labels minus the smallest label."""
    return points.withColumn("label", F.col("label") - points.agg(F.min("label")).scalar())


def label_counts(points: DataFrame) -> DataFrame:
    return points.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def first_features(points: DataFrame, d: int) -> DataFrame:
    return points.withColumn("features", F.slice("features", 1, d))


def squared_error(label: Column, prediction: Column) -> Column:
    return (label - prediction) * (label - prediction)


def rmse(label: Column, prediction: Column) -> Column:
    """Aggregate: root of the mean squared error."""
    return F.sqrt(F.avg(squared_error(label, prediction)))


def predict(points: DataFrame, weights: Sequence[float], intercept: float = 0.0) -> DataFrame:
    """`label, prediction`"""
    return points.select("label", (dot(F.col("features"), weights) + intercept).alias("prediction"))


def gradient(points: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Sum of `(w . x - y) x` as one row `g1, g2, ...`."""
    residual = dot(F.col("features"), weights) - F.col("label")
    return points.agg(
        *[F.sum(residual * F.col("features")[j]).alias(f"g{j + 1}") for j in range(len(weights))]
    )


def baseline_errors(points: DataFrame, split: str = "split") -> DataFrame:
    """RMSE per split of predicting the mean training label, from one pass.

    Count, sum and sum of squares of each split are all it takes; the window is over these few rows.
    """
    y = F.col("label").cast("double")
    sums = points.groupBy(split).agg(
        F.count("label").alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q")
    )
    mean = F.max(F.when(F.col(split) == TRAIN, F.col("s") / F.col("n"))).over(Window.partitionBy())
    total = F.col("q") - 2 * F.col("_mean") * F.col("s") + F.col("n") * F.col("_mean") * F.col("_mean")
    error = F.sqrt(F.greatest(F.try_divide(total, "n"), F.lit(0.0)))
    return sums.withColumn("_mean", mean).select(split, error.alias("rmse"))


def split_moments(points: DataFrame, split: str = "split") -> dict[int, Moments]:
    """Second moments of `[label, features]` for every split, in one pass."""
    joint = points.select(
        split, F.concat(F.array(F.col("label").cast("double")), "features").alias("v")
    )
    return moments_by(joint, "v", F.col(split))


@dataclass(frozen=True)
class LinearModel:
    weights: np.ndarray
    intercept: float = 0.0

    def error(self, m: Moments) -> float:
        """RMSE over the points behind `m`."""
        # residual = r . [label, features, 1]
        r = np.concatenate([[-1.0], self.weights, [self.intercept]])
        full = np.block([[m.outer, m.total[:, None]], [m.total[None, :], np.array([[float(m.n)]])]])
        return math.sqrt(max(r @ full @ r, 0.0) / m.n)


def gradient_descent(train: Moments, iterations: int) -> tuple[LinearModel, list[float]]:
    """Batch gradient descent from zero without intercept, step `1 / (n sqrt(i + 1))`.

    Also returns the training RMSE before every update.
    """
    products, target = train.outer[1:, 1:], train.outer[1:, 0]
    weights = np.zeros(len(target))
    errors = []
    for i in range(iterations):
        errors.append(LinearModel(weights).error(train))
        weights = weights - (products @ weights - target) / (train.n * math.sqrt(i + 1))
    return LinearModel(weights), errors


def regularized_descent(
    train: Moments,
    reg: float = 0.1,
    iterations: int = 500,
    step: float = 1.0,
    tolerance: float = 0.001,
) -> LinearModel:
    """Full-batch descent with an L2 penalty and an intercept.

    Follows the stochastic-descent trainer of `pyspark.mllib` with a mini-batch fraction of 1: the
    intercept starts at 1 and is penalized too, the step decays with the root of the iteration, and
    descent stops when the weights move less than `tolerance` times their norm.
    """
    products = np.block(
        [
            [train.outer[1:, 1:], train.total[1:, None]],
            [train.total[None, 1:], np.array([[float(train.n)]])],
        ]
    )
    target = np.concatenate([train.outer[1:, 0], train.total[:1]])
    weights = np.zeros(len(target))
    weights[-1] = 1.0
    for i in range(1, iterations + 1):
        size = step / math.sqrt(i)
        moved = weights * (1 - size * reg) - size * (products @ weights - target) / train.n
        close = np.linalg.norm(moved - weights) < tolerance * max(np.linalg.norm(moved), 1.0)
        weights = moved
        if i > 1 and close:
            break
    return LinearModel(weights[:-1], float(weights[-1]))


def grid_search(
    train: Moments,
    validation: Moments,
    first: float = 0.1,
    others: Sequence[float] = (1.0, 1e-10, 1e-5),
    **descent,
) -> tuple[list[tuple[float, float]], float, LinearModel]:
    """Validation RMSE per regularization, the best one and its model.

    The model for `first` is the one to beat; a later one must be strictly better.
    """
    errors, best, best_model, best_error = [], first, None, math.inf
    for reg in (first, *others):
        model = regularized_descent(train, reg, **descent)
        error = model.error(validation)
        errors.append((reg, error))
        if error < best_error:
            best, best_model, best_error = reg, model, error
    return errors, best, best_model


def feature_columns(points: DataFrame, d: int) -> DataFrame:
    """The features as columns `x1, x2, ...`, which the stages of a pipeline name."""
    return points.withColumns({f"x{i + 1}": F.col("features")[i] for i in range(d)}).drop("features")


class _GivenFolds(CrossValidator):
    """Folds by a column that is known to hold the numbers below `numFolds`: the library passes every row
    through Python to check them, for each fold and side."""

    def _kFold(self, dataset: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        fold = F.col(self.getFoldCol())
        return [(dataset.where(fold != i), dataset.where(fold == i)) for i in range(self.getNumFolds())]


def cross_validated(
    points: DataFrame, d: int, regs: Sequence[float], key: Sequence[str], folds: int = 3, seed: int = 7
) -> CrossValidatorModel:
    """The library's linear regression with the best L2 penalty by cross-validation.

    Folds are drawn by a hash of `key`, so rows of one key stay together and folds do not depend on
    partitions; the points are written with them once. The library divides the penalty by the deviation of the
    labels. `avgMetrics` has the
    mean RMSE for each of `regs`; `bestModel` is fitted on all points.
    """
    regression = LinearRegression(labelCol="label", elasticNetParam=0.0, standardization=False, solver="normal")
    pipeline = Pipeline(
        stages=[VectorAssembler(inputCols=[f"x{i + 1}" for i in range(d)], outputCol="features"), regression]
    )
    search = _GivenFolds(
        estimator=pipeline,
        estimatorParamMaps=ParamGridBuilder().addGrid(regression.regParam, list(regs)).build(),
        evaluator=RegressionEvaluator(labelCol="label", metricName="rmse"),
        numFolds=folds,
        foldCol="fold",
        parallelism=min(4, len(regs)),
    )
    dealt = hash_split(feature_columns(points, d), key, [1.0] * folds, seed, "fold")
    names = [f"x{i + 1}" for i in range(d)]
    return search.fit(materialize(dealt.select("label", *names, "fold"), "folds"))


def library_error(model: CrossValidatorModel, points: DataFrame, d: int) -> float:
    """RMSE of the best model over other points."""
    return RegressionEvaluator(labelCol="label", metricName="rmse").evaluate(model.transform(feature_columns(points, d)))
