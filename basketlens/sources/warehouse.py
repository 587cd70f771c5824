"""Table scans with a projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.functions.text import snake_name
from basketlens.schemas import RAW_TRANSACTIONS, TRANSACTIONS


def project_transactions(raw: DataFrame) -> DataFrame:
    """Eight named and cast columns of a raw transactions table, cancellations included."""
    kinds = {field.name: field.dataType for field in TRANSACTIONS.fields}
    return raw.select(
        *[
            F.col(field.name).cast(
                "bigint" if field.name == "Quantity" else kinds[snake_name(field.name)]
            ).alias(snake_name(field.name))
            for field in RAW_TRANSACTIONS.fields
        ]
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return project_transactions(spark.table(name))
