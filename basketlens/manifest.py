"""A log of write-once versions: which folders of a table, or which models, are in use.

A version is a folder ``version=<n>`` with one small file that holds the whole state. It appears when
its file is moved into place, so a reader sees a version as a whole or not at all, and a writer that
dies leaves the one before. Two writers that start from one version can not both add the next.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from basketlens.session import remove_folder, subfolders

VERSION = "version"


class Conflict(Exception):
    """Another writer added a version meanwhile."""


def current(spark: SparkSession, path: str) -> tuple[int, list[Row]]:
    """Number and rows of the latest version; 0 and none if there is no version."""
    table = history(spark, path)
    if table is None:
        return 0, []
    latest = table.agg(F.max(VERSION)).first()[0]
    return latest or 0, table.where(F.col(VERSION) == latest).drop(VERSION).collect() if latest else []


def history(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of all versions that are kept, with their number."""
    try:
        return spark.read.option("basePath", path).parquet(path)
    except AnalysisException:  # nothing was committed so far
        return None


def commit(rows: DataFrame, path: str, after: int) -> int:
    """Add ``rows`` as the version that follows ``after``; ``Conflict`` if that is not the latest any more."""
    spark = rows.sparkSession
    version = after + 1
    while True:
        try:
            rows.coalesce(1).write.mode("errorifexists").parquet(f"{path}/{VERSION}={version}")
            return version
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            if current(spark, path)[0] != after:
                raise Conflict(f"version {version} of {path} was added by another writer") from error
            version += 1  # the folder of a writer that died


def forget(spark: SparkSession, path: str, before: int) -> None:
    """Remove the versions before ``before``."""
    for name in subfolders(spark, path):
        number = name.removeprefix(f"{VERSION}=")
        if number != name and number.isdigit() and int(number) < before:
            remove_folder(spark, f"{path}/{name}")
