"""Customer features: recency, frequency, value, velocity, cancellations, shopping hour.

Lines are first summed up per (customer, invoice) and then per customer, so
distinct invoice counts turn into plain counts: no ``count(distinct)`` and no
row expansion. Both levels combine before they shuffle; a customer with a third
of all lines is spread over its invoices first and reaches the second shuffle as
one partial row per partition. The shopping hour has two levels of its own, per
(customer, hour) and per customer, and meets the rest on the customer, by which
both are then partitioned already.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.constants import (
    DEFAULT_SHOPPING_HOUR,
    LONG_WINDOW_DAYS,
    RFM_COLUMNS,
    SHORT_WINDOW_DAYS,
)
from basketlens.functions.numeric import number_or_zero, ratio, round_half_even
from basketlens.functions.temporal import days_before, whole_days_between
from basketlens.functions.text import invoice_text, is_cancellation
from basketlens.session import materialize

def latest_date(transactions: DataFrame) -> Column:
    """Largest invoice date over all rows, with or without a customer, as a scalar subquery."""
    return transactions.agg(F.max("invoice_date").alias("latest")).scalar()


def prepare_lines(transactions: DataFrame) -> DataFrame:
    """What the features need of a line, with null invoices and bad values settled."""
    given = (
        F.col("order_value")
        if "order_value" in transactions.columns
        else F.col("quantity") * F.col("unit_price")
    )
    sold = F.coalesce(F.col("quantity") > 0, F.lit(False))
    return transactions.select(
        "customer_id",
        invoice_text(F.col("invoice_no")).alias("invoice_no"),
        "invoice_date",
        F.lit(1).cast("long").alias("lines"),
        sold.alias("sold"),
        F.when(sold, number_or_zero(given)).alias("value"),
    )


def invoice_moments(lines: DataFrame) -> DataFrame:
    """Lines summed up per customer, invoice and time, in the same columns.

    Nothing here depends on the dates one looks back from, so the result serves
    any number of cutoffs. Store it when several are needed: it has about a row
    per invoice, and the latest dates come from it instead of from the lines.
    """
    return lines.groupBy("customer_id", "invoice_no", "invoice_date").agg(
        F.sum("lines").alias("lines"), F.bool_or("sold").alias("sold"), F.sum("value").alias("value")
    )


def invoice_measures(
    lines: DataFrame, keys: Sequence[str], anchor: Column, within: Column | None = None
) -> DataFrame:
    """Sum lines or moments up per key and invoice; ``within`` limits the measures, not the rows."""
    within = F.lit(True) if within is None else within
    moment = F.col("invoice_date")
    value = F.when(within, F.col("value"))
    return lines.groupBy(*keys, "invoice_no").agg(
        F.max(anchor).alias("anchor"),
        F.max(moment).alias("last_any"),
        F.max(F.when(within, moment)).alias("last_seen"),
        F.bool_or(within).alias("counted"),
        F.bool_or(within & F.col("sold")).alias("sold"),
        F.sum(value).alias("monetary"),
        F.sum(F.when(moment >= days_before(anchor, SHORT_WINDOW_DAYS), value)).alias("monetary_30"),
        F.sum(F.when(moment >= days_before(anchor, LONG_WINDOW_DAYS), value)).alias("monetary_90"),
    )


def customer_measures(invoices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """From invoice sums to one row per key."""
    cancelled = F.col("counted") & is_cancellation(F.col("invoice_no"))
    return invoices.groupBy(*keys).agg(
        F.max("anchor").alias("anchor"),
        F.max("last_any").alias("last_any"),
        F.max("last_seen").alias("last_seen"),
        F.count_if("sold").alias("frequency"),
        *[
            F.coalesce(F.sum(name), F.lit(0.0)).alias(name)
            for name in ("monetary", "monetary_30", "monetary_90")
        ],
        F.count_if(cancelled).alias("cancelled_orders"),
        F.count_if("counted").alias("total_orders"),
    )


def preferred_hours(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hour with the most lines per key, the earliest on ties.

    Count and hour are packed into one number, larger for the earlier of two
    hours, so that the choice is a plain maximum.
    """
    counts = (
        lines.where(F.col("invoice_date").isNotNull())
        .groupBy(*keys, F.hour("invoice_date").alias("hour"))
        .agg(F.sum("lines").alias("lines"))
    )
    packed = F.max(F.col("lines") * 32 + (31 - F.col("hour")))
    return counts.groupBy(*keys).agg((31 - packed % 32).cast("int").alias("preferred_shopping_hour"))


def wide_measures(
    lines: DataFrame, keys: Sequence[str], anchor: Column, within: Column | None = None
) -> DataFrame:
    """All sums per key from lines or moments; keys without a counted row have no ``last_seen``."""
    counted = lines if within is None else lines.where(within)
    sums = customer_measures(invoice_measures(lines, keys, anchor, within), keys)
    hour = F.coalesce("preferred_shopping_hour", F.lit(DEFAULT_SHOPPING_HOUR))
    return sums.join(preferred_hours(counted, keys), list(keys), "left").withColumn(
        "preferred_shopping_hour", hour
    )


def finish_features(wide: DataFrame) -> DataFrame:
    """Derive the rounded features from the wide sums."""
    orders = F.greatest(F.col("frequency"), F.lit(1))
    velocity = ratio(F.col("monetary_30"), F.col("monetary_90") / F.lit(3.0))
    return wide.withColumns(
        {
            "recency": whole_days_between(F.col("last_seen"), F.col("anchor")),
            "frequency": F.col("frequency").cast("int"),
            "avg_order_value": round_half_even(F.col("monetary") / orders, 2),
            "spending_velocity": round_half_even(F.coalesce(velocity, F.lit(1.0)), 2),
            "cancellation_rate": round_half_even(
                F.col("cancelled_orders") / F.greatest(F.col("total_orders"), F.lit(1)), 4
            ),
        }
    )


WIDE_COLUMNS = [*RFM_COLUMNS, "monetary", "monetary_30", "monetary_90", "cancelled_orders", "total_orders"]


def stored_moments(transactions: DataFrame) -> DataFrame:
    """Invoice moments of all rows, with or without a customer, written to the shared folder."""
    return materialize(invoice_moments(prepare_lines(transactions)), "moments")


def rfm_wide_from(rows: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Features plus the sums behind them, from prepared lines or from moments."""
    anchor = latest_date(rows) if as_of is None else as_of
    known = rows.where(F.col("customer_id").isNotNull()).withColumn("anchor_date", anchor)
    wide = wide_measures(known, ["customer_id"], F.col("anchor_date"))
    return finish_features(wide).select(*WIDE_COLUMNS)


def rfm_wide(
    transactions: DataFrame, as_of: Column | None = None, store_invoices: bool = False
) -> DataFrame:
    """Features plus the sums behind them.

    ``as_of`` is the moment recency and the trailing windows look back from.
    Left out, it is the latest date of all rows. For a stored table that is one
    more scan of the date column, and the shopping hour is one of two columns.
    Where the transactions are a join or another costly plan, ``store_invoices``
    runs that plan once and takes everything from the stored invoice moments.
    """
    return rfm_wide_from(
        stored_moments(transactions) if store_invoices else prepare_lines(transactions), as_of
    )


def rfm_features(
    transactions: DataFrame, as_of: Column | None = None, store_invoices: bool = False
) -> DataFrame:
    """The seven-column feature table, one row per customer."""
    return rfm_wide(transactions, as_of, store_invoices).select(*RFM_COLUMNS)


def sales_metrics(transactions: DataFrame) -> DataFrame:
    """Distinct sale invoices and sale value per customer that has a sale."""
    sales = prepare_lines(transactions).where(F.col("sold") & F.col("customer_id").isNotNull())
    return (
        sales.groupBy("customer_id", "invoice_no")
        .agg(F.sum("value").alias("value"))
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("frequency"), F.sum("value").alias("monetary"))
    )


def customer_dates(transactions: DataFrame) -> DataFrame:
    """First and last date per customer, written to the shared folder.

    Rows without a customer keep a row of their own, so the latest date of all
    rows can be read off here as well, without another scan of the lines.
    """
    dates = transactions.groupBy("customer_id").agg(
        F.min("invoice_date").alias("first_seen"), F.max("invoice_date").alias("last_seen")
    )
    return materialize(dates, "dates")


def latest_of(dates: DataFrame) -> Column:
    return dates.agg(F.max("last_seen").alias("latest")).scalar()


def recency(transactions: DataFrame) -> DataFrame:
    """Days since the last row of each customer, cancellations included."""
    dates = customer_dates(transactions)
    return dates.where(F.col("customer_id").isNotNull()).select(
        "customer_id", whole_days_between(F.col("last_seen"), latest_of(dates)).alias("recency")
    )


def recency_with_sales(transactions: DataFrame) -> DataFrame:
    """Every customer with its sales metrics, zero where it has none (the join form)."""
    return (
        recency(transactions)
        .join(sales_metrics(transactions), "customer_id", "left")
        .na.fill({"frequency": 0, "monetary": 0.0})
    )
