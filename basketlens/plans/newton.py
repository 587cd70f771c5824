"""Logistic regression by Newton steps over grouped sums, for any number of groups at once.

A step is one aggregate: the gradient, the upper half of the Hessian and the loss of every group at
its own weights. What reaches the driver has a row per group and does not grow with the data. The
gradient at the weights returned comes with them, as the certificate of the optimum.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.plans.scaling import VECTOR
from basketlens.session import materialize

MAX_STEPS = 50
GRADIENT = 1e-9  # done when no entry of the gradient is larger, per row


@dataclass
class Solution:
    weights: np.ndarray
    intercept: float
    gradient: np.ndarray  # of the penalised summed loss, the intercept's entry last
    rows: int
    means: np.ndarray
    deviations: np.ndarray
    steps: int


class LogisticScores(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Saved stage that adds ``probability`` (a vector of both classes) and ``prediction``, as plain expressions."""

    weights = Param(Params._dummy(), "weights", "one number per feature")
    constant = Param(Params._dummy(), "constant", "the intercept")

    def __init__(self, weights: Sequence[float] | None = None, constant: float | None = None):
        super().__init__()
        if weights is not None:
            self._set(weights=[float(w) for w in weights], constant=float(constant or 0.0))

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.getOrDefault(self.weights))

    @property
    def intercept(self) -> float:
        return self.getOrDefault(self.constant)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x, p = f"{self.uid}_x", f"{self.uid}_p"
        score = F.lit(self.intercept)
        for i, weight in enumerate(self.getOrDefault(self.weights)):
            score = score + F.lit(float(weight)) * F.get(x, F.lit(i))
        rows = dataset.withColumn(x, vector_to_array(VECTOR)).withColumn(p, 1 / (1 + F.exp(-score)))
        return rows.withColumns(
            {"probability": array_to_vector(F.array(1 - F.col(p), F.col(p))), "prediction": (F.col(p) > 0.5).cast("double")}
        ).drop(x, p)


def _pairs(width: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(width) for j in range(i, width)]


def _sums(width: int) -> list[Column]:
    """Loss, gradient and Hessian of the summed loss at ``score``, from ``x0..`` and the 0/1 column ``y``."""
    p, y, score = F.col("p"), F.col("y"), F.col("score")
    # log(1 + exp(-|s|)) does not overflow
    loss = F.greatest(score, F.lit(0.0)) - score * y + F.log1p(F.exp(-F.abs(score)))
    curve = p * (1 - p)
    return [
        F.sum(loss).alias("loss"),
        *[F.sum((p - y) * F.col(f"x{i}")).alias(f"g{i}") for i in range(width)],
        *[F.sum(curve * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"h{i}_{j}") for i, j in _pairs(width)],
    ]


def scaled_rows(train: DataFrame, group: str, features: Sequence[str], label: str) -> tuple[DataFrame, dict]:
    """Stored ``group, y, x0..`` with a constant 1 last, scaled within each group, and the numbers it is scaled by."""
    moments = train.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(name).alias(f"m{i}") for i, name in enumerate(features)],
        *[F.stddev_pop(name).alias(f"d{i}") for i, name in enumerate(features)],
    )
    known = moments.collect()  # one row per group
    every = range(len(features))
    fitted = {
        row[group]: (row["n"], np.array([row[f"m{i}"] for i in every]), np.array([row[f"d{i}"] or 1.0 for i in every]))
        for row in known
    }
    spark = train.sparkSession
    table = spark.createDataFrame(
        [(key, *map(float, m), *map(float, d)) for key, (_, m, d) in fitted.items()],
        f"{group} {train.schema[group].dataType.simpleString()}, "
        + ", ".join([f"m{i} double" for i in every] + [f"d{i} double" for i in every]),
    )
    rows = train.join(F.broadcast(table), group).select(
        group,
        F.col(label).cast("double").alias("y"),
        *[((F.col(name) - F.col(f"m{i}")) / F.col(f"d{i}")).alias(f"x{i}") for i, name in enumerate(features)],
        F.lit(1.0).alias(f"x{len(features)}"),
    )
    return materialize(rows, "scaled"), fitted


def solve(
    train: DataFrame, group: str, features: Sequence[str], label: str = "churn", penalty: float = 1.0
) -> dict[object, Solution]:
    """Per group, the weights that minimise the summed loss plus ``|w|^2 / (2 penalty)``; the intercept is free.

    A step that does not lower the loss is halved. A group whose label is constant has no finite
    intercept; its weights are those at which the steps end.
    """
    width = len(features) + 1
    rows, fitted = scaled_rows(train, group, features, label)
    kind = train.schema[group].dataType.simpleString()
    ridge = np.array([1.0 / penalty] * (width - 1) + [0.0])
    at = {key: np.zeros(width) for key in fitted}
    last: dict[object, tuple[float, np.ndarray, np.ndarray]] = {}  # loss, weights and step that led from them
    done: dict[object, Solution] = {}
    for number in range(1, MAX_STEPS + 1):
        for row in _step(rows, group, kind, at, width):
            key = row[group]
            w, (n, means, deviations) = at[key], fitted[key]
            loss = row["loss"] + 0.5 * float(ridge @ (w * w))
            gradient = np.array([row[f"g{i}"] for i in range(width)]) + ridge * w
            if key in last and loss > last[key][0] + 1e-12 * abs(loss) and np.abs(last[key][2]).max() > 1e-12:
                before, start, step = last[key]
                last[key] = (before, start, step / 2)
                at[key] = start + step / 2
                continue
            if np.abs(gradient).max() <= GRADIENT * n or number == MAX_STEPS:
                done[key] = Solution(w[:-1], float(w[-1]), gradient, n, means, deviations, number)
                del at[key]
                continue
            hessian = np.zeros((width, width))
            for i, j in _pairs(width):
                hessian[i, j] = hessian[j, i] = row[f"h{i}_{j}"]
            hessian += np.diag(ridge + 1e-12 * n)
            step = -np.linalg.solve(hessian, gradient)
            last[key] = (loss, w, step)
            at[key] = w + step
        if not at:
            break
    return done


def _step(rows: DataFrame, group: str, kind: str, at: dict[object, np.ndarray], width: int) -> list:
    """One row of sums per group that is still on its way; the weights travel as a table of a row per group."""
    names = [f"w{i}" for i in range(width)]
    table = rows.sparkSession.createDataFrame(
        [(key, *map(float, w)) for key, w in at.items()], f"{group} {kind}, " + ", ".join(f"{name} double" for name in names)
    )
    score = F.lit(0.0)
    for i, name in enumerate(names):
        score = score + F.col(name) * F.col(f"x{i}")
    scored = rows.join(F.broadcast(table), group).withColumn("score", score).withColumn("p", 1 / (1 + F.exp(-F.col("score"))))
    return scored.groupBy(group).agg(*_sums(width)).collect()
