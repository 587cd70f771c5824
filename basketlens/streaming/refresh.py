"""Feature table kept current by micro-batches.

A batch adds its own sums per customer, invoice and moment and touches nothing
that came before, so its cost does not grow with the number of batches. Recency
and the trailing windows depend on the latest date of all rows, which moves with
every batch, and an invoice may go on in a later one; both are put together when
the table is read. ``compact`` keeps the number of files a read opens small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.constants import RFM_COLUMNS
from basketlens.operators import rfm
from basketlens.streaming import changelog

_MONEY = "decimal(38,6)"  # sums of decimals do not depend on the order of arrival


def batch_moments(transactions: DataFrame) -> DataFrame:
    """Invoice moments of one batch, with or without a customer."""
    return combined_moments(rfm.prepare_lines(transactions).withColumn("value", F.col("value").cast(_MONEY)))


def combined_moments(moments: DataFrame) -> DataFrame:
    return rfm.invoice_moments(moments).withColumn("value", F.col("value").cast(_MONEY))


def run_refresh(stream: DataFrame, base: str) -> None:
    changelog.collect(stream, base, batch_moments)


def compact(spark: SparkSession, base: str) -> None:
    changelog.compact(spark, f"{base}/rows", combined_moments)


def current_features(spark: SparkSession, base: str) -> DataFrame:
    """The seven-column feature table as of the latest row seen."""
    moments = combined_moments(changelog.read_partials(spark, f"{base}/rows"))
    return rfm.rfm_wide_from(moments).select(*RFM_COLUMNS)
