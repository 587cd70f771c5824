"""Append-only prediction logs and the product catalogue table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.schemas import CATALOGUE, CHURN_LOG, PREDICTION_LOG

JOB = "job"  # every job owns the folder job=<name> of a log


def request_id(*parts: Column) -> Column:
    """Repeatable id: the same request gets the same id when a batch is written again."""
    return F.md5(F.concat_ws("_", *[part.cast("string") for part in parts]))


def log_rows(scored: DataFrame, schema: T.StructType, created_at: Column | None = None) -> DataFrame:
    """Shape scored rows like a log: cast columns, blank for a missing customer, batch time."""
    moment = F.current_timestamp().cast("timestamp_ntz") if created_at is None else created_at
    frame = scored if "created_at" in scored.columns else scored.withColumn("created_at", moment)
    frame = frame.withColumn("customer_id", F.coalesce(F.col("customer_id").cast("string"), F.lit("")))
    return frame.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema.fields])


def append_predictions(scored: DataFrame, path: str, job: str) -> None:
    """Add the rows of ``job``; a job that is repeated replaces its own rows and no others."""
    _append(log_rows(scored, PREDICTION_LOG), path, job)


def append_churn_predictions(scored: DataFrame, path: str, job: str) -> None:
    _append(log_rows(scored, CHURN_LOG), path, job)


def _append(rows: DataFrame, path: str, job: str) -> None:
    (
        rows.withColumn(JOB, F.lit(job))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(JOB)
        .parquet(path)
    )


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PREDICTION_LOG).parquet(path).select(*PREDICTION_LOG.names)


def read_churn_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHURN_LOG).parquet(path).select(*CHURN_LOG.names)


def replace_catalogue(products: DataFrame, path: str) -> None:
    """Truncate and load."""
    rows = products.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CATALOGUE.fields])
    rows.write.mode("overwrite").parquet(path)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATALOGUE).parquet(path)
