"""Prediction logs, catalogue and scoring requests as views over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.constants import RFM_COLUMNS
from basketlens.operators.churn import training_frame
from basketlens.operators.enrich import enrich
from basketlens.operators.profiles import rule_cluster, rule_label
from basketlens.operators.ranking import global_row_number
from basketlens.operators.reports import product_rollup
from basketlens.operators.rfm import latest_date, rfm_wide, rfm_wide_from, stored_moments
from basketlens.operators.similarity import product_catalogue
from basketlens.schemas import CHURN_LOG, PREDICTION_LOG
from basketlens.session import materialize
from basketlens.sources.star import retail_transactions, table

VERSIONS = (1, 2, 3)


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return retail_transactions(spark, folder)


def stored_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The join of the order tables, run once, for queries whose parts all read the transactions."""
    return materialize(transactions(spark, folder).drop("country"), "transactions")


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return transactions(spark, folder).transform(enrich)


def features_wide(spark: SparkSession, folder: str) -> DataFrame:
    """The transactions are a join here, so it is run once and its invoices are stored."""
    return rfm_wide(transactions(spark, folder), store_invoices=True)


def features(spark: SparkSession, folder: str) -> DataFrame:
    return features_wide(spark, folder).select(*RFM_COLUMNS)


def stored_features(spark: SparkSession, folder: str) -> DataFrame:
    """The wide feature table as a stored table, for queries that read it several times."""
    return materialize(features_wide(spark, folder), "features")


def stored_training_frame(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(churn_training_frame(spark, folder), "training")


def churn_training_frame(spark: SparkSession, folder: str) -> DataFrame:
    return training_frame(transactions(spark, folder))


def _number() -> Column:
    return F.col("customer_id").cast("long")


def _versions(rfm: DataFrame, moments: DataFrame) -> DataFrame:
    """Every row once per model version, scored some minutes before the latest sale."""
    version = F.col("version")
    back = -((_number() % 1000) * version).cast("int")
    return (
        rfm.withColumn("version", F.explode(F.array(*[F.lit(v) for v in VERSIONS])))
        .withColumn("latest", latest_date(moments))
        .withColumns(
            {
                "recency": F.col("recency").cast("double"),
                "model_version": version.cast("string"),
                "feature_version": F.lit("rfm_v1"),
                "response_time_ms": (_number() * version) % 97 + F.lit(0.5),
                "created_at": F.timestamp_add("MINUTE", back, F.col("latest")),
            }
        )
    )


def prediction_log(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer scored once by each of three model versions."""
    moments = stored_moments(transactions(spark, folder))
    label = rule_label(F.col("recency"), F.col("frequency"), F.col("avg_order_value"))
    scored = rule_cluster(rfm_wide_from(moments)).withColumn("label", label)
    return (
        _versions(scored, moments)
        .withColumn("request_id", F.md5(F.concat_ws("_", "customer_id", "model_version")))
        .select(*PREDICTION_LOG.names)
    )


def churn_log_of(rfm: DataFrame, moments: DataFrame) -> DataFrame:
    """Scores for most customers; those with a number divisible by ten have none."""
    probability = F.least(F.lit(1.0), F.col("recency") / F.lit(365.0)) / F.col("version")
    return (
        _versions(rfm.where(_number() % 10 != 0), moments)
        .withColumns(
            {
                "request_id": F.md5(F.concat_ws("_", F.lit("churn"), "customer_id", "model_version")),
                "churn_probability": probability,
                "is_churn": (probability >= 0.5).cast("int"),
            }
        )
        .select(*CHURN_LOG.names)
    )


def churn_log(spark: SparkSession, folder: str) -> DataFrame:
    moments = stored_moments(transactions(spark, folder))
    return churn_log_of(rfm_wide_from(moments), moments)


def features_and_churn_log(spark: SparkSession, folder: str, bought: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Both from one pass over the transactions, the features stored as any later stage reads them."""
    moments = stored_moments(transactions(spark, folder) if bought is None else bought)
    stored = materialize(rfm_wide_from(moments).select(*RFM_COLUMNS), "features")
    return stored, churn_log_of(stored, moments)


def product_vectors(spark: SparkSession, folder: str, bought: DataFrame | None = None) -> DataFrame:
    """``description, embedding`` of every product; the r-th description by text has the vector with id r."""
    bought = transactions(spark, folder) if bought is None else bought
    products = product_rollup(bought).select("description").distinct()
    ranked = global_row_number(products, ["description"]).select("description", (F.col("rank") - 1).alias("vec_id"))
    vectors = table(spark, folder, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding")
    )
    return materialize(ranked.join(vectors, "vec_id").select("description", "embedding"), "vectors")


def catalogue_rows(
    spark: SparkSession, folder: str, vectors: DataFrame | None = None, bought: DataFrame | None = None
) -> DataFrame:
    bought = transactions(spark, folder) if bought is None else bought
    vectors = product_vectors(spark, folder, bought) if vectors is None else vectors
    products = product_catalogue(bought)
    return products.join(vectors, "description", "left").select("stock_code", "description", "unit_price", "embedding")


def catalogue(
    spark: SparkSession, folder: str, vectors: DataFrame | None = None, bought: DataFrame | None = None
) -> DataFrame:
    """The catalogue as a stored table, for queries that read it several times."""
    return materialize(catalogue_rows(spark, folder, vectors, bought), "catalogue")


def scoring_requests(spark: SparkSession, folder: str) -> DataFrame:
    return requests_from(table(spark, folder, "customer"))


def requests_from(customers: DataFrame) -> DataFrame:
    """Untyped scoring requests: account data stands in for features, some of it unfit.

    Balances may be negative, segments are no numbers, some numbers are not finite, and some values are absent.
    """
    number = F.col("c_custkey")
    balance = F.floor("c_acctbal").cast("long").cast("string")
    return customers.select(
        F.when(number % 9 != 0, number.cast("string")).alias("customer_id"),
        balance.alias("recency"),
        F.when(number % 7 == 0, F.col("c_mktsegment"))
        .when(number % 13 == 1, F.lit("NaN"))
        .when(number % 13 == 2, F.lit("Infinity"))
        .when(number % 13 == 3, F.lit("-Infinity"))
        .otherwise(F.col("c_nationkey").cast("string"))
        .alias("frequency"),
        F.when(number % 11 != 0, number.cast("string")).alias("avg_order_value"),
        F.lit("1.0").alias("spending_velocity"),
        F.lit("0.25").alias("cancellation_rate"),
        (number % 24).cast("string").alias("preferred_shopping_hour"),
    )
