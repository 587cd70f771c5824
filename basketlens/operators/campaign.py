"""Customer profiles, recommendations and campaign texts for many customers at once."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.constants import (
    APOLOGY_CANCELLATION_OVER,
    APOLOGY_TEXT,
    CAMPAIGN_TEXT,
    DEFAULT_PROFILE,
    DEFAULT_RECOMMENDATIONS,
    FALLBACK_AT_RISK,
    FALLBACK_LOYAL,
    FALLBACK_RECENCY_OVER,
    LOYALTY_CODE,
    LOYALTY_OFFER,
    SHIPPING_CODE,
    TOP_K,
    UNKNOWN_PRODUCT,
    WINBACK_CODE,
    WINBACK_OFFER,
    WINBACK_VELOCITY_UNDER,
)
from basketlens.functions.text import money_text
from basketlens.operators.profiles import rule_label
from basketlens.operators.ranking import latest_per_key
from basketlens.operators.similarity import similar_products

PROFILE_COLUMNS = list(DEFAULT_PROFILE)


def latest_product(transactions: DataFrame) -> DataFrame:
    """Description of the last described line of each customer.

    Lines of the same moment are told apart by invoice and stock code.
    """
    described = transactions.where(F.col("description").isNotNull() & F.col("customer_id").isNotNull())
    newest = ["invoice_date", "invoice_no", "stock_code"]
    return latest_per_key(described, ["customer_id"], newest, ["description"]).withColumnRenamed(
        "description", "last_purchased"
    )


def latest_churn_score(log: DataFrame) -> DataFrame:
    newest = ["created_at", "request_id"]
    return latest_per_key(log, ["customer_id"], newest, ["churn_probability", "is_churn"])


def for_customers(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose customer, as text, is among the requested ids."""
    wanted = ids.select(F.col("customer_id").cast("string").alias("customer_id")).distinct()
    return df.withColumn("customer_id", F.col("customer_id").cast("string")).join(
        wanted, "customer_id", "left_semi"
    )


def customer_profiles(rfm: DataFrame, transactions: DataFrame, churn_log: DataFrame) -> DataFrame:
    """Features with segment, last product and churn score, each with its fallback.

    ``rfm`` may carry a ``segment`` from a model; otherwise the label rules decide.
    """
    segmented = (
        rfm
        if "segment" in rfm.columns
        else rfm.withColumn(
            "segment", rule_label(F.col("recency"), F.col("frequency"), F.col("avg_order_value"))
        )
    )
    at_risk = F.col("recency") > FALLBACK_RECENCY_OVER

    def fallback(place: int) -> Column:
        return F.when(at_risk, FALLBACK_AT_RISK[place]).otherwise(FALLBACK_LOYAL[place])

    return (
        segmented.join(latest_product(transactions), "customer_id", "left")
        .join(latest_churn_score(churn_log), "customer_id", "left")
        .withColumns(
            {
                "last_purchased": F.coalesce("last_purchased", F.lit(UNKNOWN_PRODUCT)),
                "churn_probability": F.coalesce("churn_probability", fallback(0)),
                "is_churn": F.coalesce("is_churn", fallback(1)),
            }
        )
        .select("customer_id", *PROFILE_COLUMNS)
    )


def profiles_or_default(ids: DataFrame, profiles: DataFrame) -> DataFrame:
    """A row per requested id; an id without a profile gets the standard one."""
    known = profiles.withColumn("known", F.lit(True))
    return ids.select("customer_id").join(known, "customer_id", "left").select(
        "customer_id",
        *[
            F.when(F.col("known"), F.col(name)).otherwise(F.lit(value)).alias(name)
            for name, value in DEFAULT_PROFILE.items()
        ],
    )


def default_recommendations(spark: SparkSession, k: int = TOP_K) -> DataFrame:
    rows = [(place, *item) for place, item in enumerate(DEFAULT_RECOMMENDATIONS[:k], start=1)]
    return spark.createDataFrame(
        rows, "rank int, stock_code string, description string, unit_price double, similarity double"
    )


def _as_list(recommendations: DataFrame, key: Sequence[str]) -> DataFrame:
    """At most k recommendations per key, as one array in rank order."""
    item = F.struct("rank", "stock_code", "description", "unit_price", "similarity")
    return recommendations.groupBy(*key).agg(F.sort_array(F.collect_list(item)).alias("items"))


def recommend(profiles: DataFrame, catalogue: DataFrame, vectors: DataFrame, k: int = TOP_K) -> DataFrame:
    """Profiles with ``items``: what resembles the last product, or the standard list.

    ``vectors`` has ``description`` and ``embedding`` of products, in the
    catalogue or not; only a last product without a vector gets the standard
    list. Similarity depends on the product only, so it is computed once per
    distinct last product and looked up by customers; a product sold to a third
    of the customers costs as much as any other.
    """
    last = profiles.select(F.col("last_purchased").alias("description")).distinct()
    known = vectors.where(F.col("embedding").isNotNull()).dropDuplicates(["description"])
    asked = last.join(known, "description").select(
        F.col("description").alias("query_id"), F.col("description").alias("query_text"), "embedding"
    )
    found = _as_list(similar_products(asked, catalogue, k), ["query_id"])
    standard = _as_list(default_recommendations(profiles.sparkSession, k), [])
    return (
        profiles.join(found, F.col("last_purchased") == F.col("query_id"), "left")
        .withColumn("items", F.coalesce("items", standard.scalar()))
        .drop("query_id")
    )


def recommendation_rows(recommended: DataFrame) -> DataFrame:
    return recommended.select("customer_id", F.inline("items"))


def with_offers(profiles: DataFrame) -> DataFrame:
    """Offer codes, offer text, apology and sending hour."""
    winback = (F.col("is_churn") == 1) | (F.col("spending_velocity") < WINBACK_VELOCITY_UNDER)
    apology = F.col("cancellation_rate") > APOLOGY_CANCELLATION_OVER
    return profiles.withColumns(
        {
            "offer": F.when(winback, F.lit(WINBACK_OFFER)).otherwise(F.lit(LOYALTY_OFFER)),
            "apology": F.when(apology, F.lit(APOLOGY_TEXT)).otherwise(F.lit("")),
            "offer_codes": F.array_compact(
                F.array(
                    F.when(winback, F.lit(WINBACK_CODE)).otherwise(F.lit(LOYALTY_CODE)),
                    F.when(apology, F.lit(SHIPPING_CODE)),
                )
            ),
            "send_hour": F.col("preferred_shopping_hour"),
        }
    )


def _fill(text: str, values: dict[str, Column]) -> Column:
    """Concatenate the pieces of ``text``, with a column in place of each {name}."""
    pieces = re.split(r"\{(\w+)\}", text)
    parts = [F.lit(piece) if place % 2 == 0 else values[piece] for place, piece in enumerate(pieces)]
    return F.concat(*parts)


def with_campaign_text(offered: DataFrame) -> DataFrame:
    """Fill the campaign text in; it lists as many recommendations as there are."""
    lines = F.transform(
        "items",
        lambda item, place: F.concat(
            (place + 1).cast("string"),
            F.lit(".  **"),
            item.getField("description"),
            F.lit("** — $"),
            money_text(item.getField("unit_price")),
        ),
    )
    values = {
        "customer_id": F.col("customer_id"),
        "apology": F.col("apology"),
        "last_purchased": F.col("last_purchased"),
        "recommendations": F.array_join(lines, "\n"),
        "offer": F.col("offer"),
        "hour": F.col("send_hour").cast("string"),
    }
    return offered.withColumn("campaign_draft", _fill(CAMPAIGN_TEXT, values))


def campaigns(
    ids: DataFrame,
    rfm: DataFrame,
    transactions: DataFrame,
    churn_log: DataFrame,
    catalogue: DataFrame,
    vectors: DataFrame,
    k: int = TOP_K,
) -> DataFrame:
    """One campaign per requested customer id."""
    profiles = profiles_or_default(ids, customer_profiles(rfm, transactions, churn_log))
    return profiles.transform(recommend, catalogue, vectors, k).transform(with_offers).transform(with_campaign_text)
