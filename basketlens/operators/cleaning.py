"""Cleaning of raw transactions and the validity split of scoring requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.text import snake_name


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_name(name) for name in df.columns])


def with_customer(df: DataFrame) -> DataFrame:
    return df.where(F.col("customer_id").isNotNull())


def positive_quantity(df: DataFrame) -> DataFrame:
    return df.where(F.col("quantity") > 0)


def clean_sales(raw: DataFrame) -> DataFrame:
    """Sales only: cancellations are dropped together with anonymous rows."""
    return raw.transform(snake_case_columns).transform(with_customer).transform(positive_quantity)


def clean_keep_returns(raw: DataFrame) -> DataFrame:
    """Cancellations stay, so that cancellation rates can be computed later."""
    return raw.transform(snake_case_columns).transform(with_customer)


SEGMENTATION_REQUEST = {"recency": "double", "frequency": "double", "avg_order_value": "double"}
CHURN_REQUEST = SEGMENTATION_REQUEST | {
    "spending_velocity": "double",
    "cancellation_rate": "double",
    "preferred_shopping_hour": "int",
}

_LARGEST = 1.7976931348623157e308  # NaN sorts after every number, so it is not in this range either


def _complaint(name: str, kind: str) -> Column:
    given = F.col(name)
    parsed = given.try_cast(kind)
    return (
        F.when(given.isNull(), F.lit(f"{name}: missing"))
        .when(parsed.isNull(), F.lit(f"{name}: not a number"))
        .when(~parsed.cast("double").between(-_LARGEST, _LARGEST), F.lit(f"{name}: not finite"))
        .when(parsed < 0, F.lit(f"{name}: negative"))
    )


def check_requests(requests: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Add ``reasons``: one text per broken rule, an empty array for a valid row.

    Every ruled field must be present, a finite number and not negative. A field that
    is not a column of ``requests`` is missing in every row.
    """
    absent = {name: F.lit(None).cast("string") for name in rules if name not in requests.columns}
    frame = requests.withColumns(absent) if absent else requests
    complaints = [_complaint(name, kind) for name, kind in rules.items()]
    return frame.withColumn("reasons", F.array_compact(F.array(*complaints)))


def split_requests(requests: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Valid rows with typed fields, and the quarantined rest with its reasons."""
    checked = check_requests(requests, rules)
    valid = (
        checked.where(F.size("reasons") == 0)
        .drop("reasons")
        .withColumns({name: F.col(name).try_cast(kind) for name, kind in rules.items()})
    )
    return valid, checked.where(F.size("reasons") > 0)
