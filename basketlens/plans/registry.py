"""Models in use: all models of a version are switched at once, and only past the gate."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from basketlens import manifest

_STATE = "model_version int, folder string, score double"


@dataclass
class InUse:
    model_version: int
    folder: str
    score: float


def in_use(spark: SparkSession, root: str) -> InUse | None:
    """The version in use; None before the first one."""
    _, rows = manifest.current(spark, f"{root}/in_use")
    return InUse(*rows[0]) if rows else None


def publish(
    spark: SparkSession, root: str, version: int, parts: dict[str, Callable[[str], object]], score: float
) -> bool:
    """Store the parts of a version and put it in use if its score is at least that of the one in use.

    Every attempt has a folder of its own, written once. The switch is a new state in a log: it comes after all
    parts are stored, so a part that fails leaves the version before, and no reader sees models of two versions.
    A switch by another job meanwhile leads to the gate again, against the new score.
    """
    folder = f"{root}/models/{version}-{uuid.uuid4().hex}"
    for name, write in parts.items():
        write(f"{folder}/{name}")
    while True:
        number, rows = manifest.current(spark, f"{root}/in_use")
        if rows and score < InUse(*rows[0]).score:
            return False
        try:
            manifest.commit(spark.createDataFrame([(version, folder, float(score))], _STATE), f"{root}/in_use", number)
            return True
        except manifest.Conflict:
            continue


def saved(model: PipelineModel) -> Callable[[str], object]:
    return lambda path: model.write().save(path)


def stored(table: DataFrame) -> Callable[[str], object]:
    return lambda path: table.write.parquet(path)


def load(spark: SparkSession, root: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{_folder(spark, root)}/{name}")


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{_folder(spark, root)}/{name}")


def _folder(spark: SparkSession, root: str) -> str:
    found = in_use(spark, root)
    if found is None:
        raise LookupError(f"no model is in use under {root}")
    return found.folder
