"""Value and time features of a transaction row. All row-local, one stage with the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.numeric import number_or_zero


def parse_invoice_date(df: DataFrame, pattern: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Text dates become timestamps; text that does not parse becomes null.

    Use :func:`unparsed_dates` to see how many rows that concerns.
    """
    if dict(df.dtypes)["invoice_date"] != "string":
        return df
    parsed = F.try_to_timestamp(F.col("invoice_date"), F.lit(pattern))
    return df.withColumn("invoice_date", parsed.cast("timestamp_ntz"))


def unparsed_dates(df: DataFrame, pattern: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    parsed = F.try_to_timestamp(F.col("invoice_date"), F.lit(pattern))
    return df.agg(
        F.count_if(F.col("invoice_date").isNotNull() & parsed.isNull()).alias("unparsed"),
        F.count(F.lit(1)).alias("total"),
    )


def with_order_value(df: DataFrame) -> DataFrame:
    return df.withColumn("order_value", F.col("quantity") * F.col("unit_price"))


def with_time_parts(df: DataFrame) -> DataFrame:
    moment = F.col("invoice_date")
    return df.withColumns(
        {"invoice_year": F.year(moment), "invoice_month": F.month(moment), "invoice_hour": F.hour(moment)}
    )


def with_numeric(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, number_or_zero(F.col(name)))


def enrich(df: DataFrame) -> DataFrame:
    return df.transform(parse_invoice_date).transform(with_order_value).transform(with_time_parts)
