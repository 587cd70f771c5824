"""Scaling as a saved ML stage: plain SQL expressions with the fitted numbers in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VECTOR = "scaled"


def _temporary(name: str) -> str:
    return f"_scaled_{name}"


def _expression(name: str, log_features: Sequence[str]) -> str:
    return f"log1p({name})" if name in log_features else f"double({name})"


def fit_scaling(df: DataFrame, features: Sequence[str], log_features: Sequence[str] = ()) -> list:
    """Stages that turn ``features`` into one centred vector of unit population deviation.

    The fitted numbers, two per feature, are all that reaches the driver. Spark's
    own scaler divides by the sample deviation, which would change the weight of
    the penalty in a model fitted on the result.
    """
    expressions = {name: _expression(name, log_features) for name in features}
    fitted = df.agg(
        *[
            F.struct(F.avg(F.expr(text)).alias("mean"), F.stddev_pop(F.expr(text)).alias("deviation")).alias(name)
            for name, text in expressions.items()
        ]
    ).first()
    every = [fitted[name] for name in features]
    return scaling_stages(features, [row["mean"] for row in every], [row["deviation"] for row in every], log_features)


def scaling_stages(
    features: Sequence[str],
    means: Sequence[float],
    deviations: Sequence[float | None],
    log_features: Sequence[str] = (),
) -> list:
    """The same stages from known numbers; a feature without deviation is only centred."""
    parts = []
    for name, mean, deviation in zip(features, means, deviations):
        text = _expression(name, log_features)
        divisor = float(deviation) if deviation else 1.0  # a constant column becomes 0
        parts.append(f"({text} - {float(mean)!r}D) / {divisor!r}D AS {_temporary(name)}")
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"),
        VectorAssembler(
            inputCols=[_temporary(name) for name in features], outputCol=VECTOR, handleInvalid="error"
        ),
    ]


def scale(df: DataFrame, stages: list) -> DataFrame:
    return PipelineModel(stages=stages).transform(df)


def drop_working_columns(df: DataFrame) -> DataFrame:
    working = [name for name in df.columns if name.startswith("_scaled_")]
    return df.drop(*working, VECTOR, "rawPrediction")
