"""CSV and Parquet scans and sinks for transactions, features and stage outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.schemas import CORRUPT, RFM, TRANSACTIONS

_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',  # a quote inside quotes is doubled
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False, multi_line: bool = False
) -> DataFrame:
    """CSV with a fixed schema, one pass.

    A malformed row is an error unless ``keep_corrupt`` asks for it in a column
    of its own, see :func:`split_corrupt`; no row is filled with nulls unseen.
    Line breaks inside quotes need ``multi_line``, which reads a file as one piece.
    """
    reader = spark.read.options(**_CSV).option("multiLine", multi_line)
    if not keep_corrupt:
        return reader.schema(schema).option("mode", "FAILFAST").csv(path)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return reader.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def split_corrupt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the text of malformed ones for a quarantine that can be counted."""
    good = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, rows.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Partitioned writes go through a rebalance, which splits a large partition
    value over tasks and packs small ones together, so files stay of even size."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(name) for name in partition_by])
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_transactions(df: DataFrame, path: str) -> None:
    """Enriched transactions by year and month, so that time windows prune folders."""
    write_parquet(df, path, ["invoice_year", "invoice_month"])


def read_transactions(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    if kind == "csv":
        return read_csv(spark, path, TRANSACTIONS)
    return spark.read.parquet(path)


def read_features(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    return read_csv(spark, path, RFM) if kind == "csv" else read_parquet(spark, path, RFM)


def write_features(df: DataFrame, path: str, view: str | None = None) -> DataFrame:
    """Store the feature table and optionally name it as a view."""
    write_parquet(df, path)
    stored = read_parquet(df.sparkSession, path, df.schema)
    if view:
        stored.createOrReplaceTempView(view)
    return stored
