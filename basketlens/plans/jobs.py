"""Training of the models that serve together, and what they say about customers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.constants import CHURN_FEATURES, CUTOFF_DAYS, MEDIUM, SEGMENTATION_FEATURES, SPLIT_SEED
from basketlens.operators import churn
from basketlens.operators.profiles import with_segment
from basketlens.operators.rfm import rfm_features
from basketlens.plans import churn_models, registry, segmentation
from basketlens.session import materialize

SEGMENTATION, CHURN, PROFILE = "segmentation", "churn", "cluster_profile"


def training_job(
    transactions: DataFrame,
    output: str,
    version: int,
    days: int = CUTOFF_DAYS,
    ks: Iterable[int] = (4,),
    features: Sequence[str] = tuple(SEGMENTATION_FEATURES),
    seed: int = SPLIT_SEED,
) -> bool:
    """Fit the segmentation and the churn model and put both in use, if the churn model passes the gate.

    Both models and the profile with the clusters' names move together or not at all.
    """
    customers = materialize(rfm_features(transactions), "features")
    fitted, _, _, profile = segmentation.segmentation_job(customers, ks, features, seed)
    train, test = churn_models.split_training(churn.training_frame(transactions, days), seed=seed)
    model = churn_models.fit(churn_models.LOGISTIC, train, tuple(CHURN_FEATURES), seed)
    score = churn_models.evaluate(test, model, churn_models.LOGISTIC, days, 0.0).first()["churn_f1"]
    parts = {
        SEGMENTATION: registry.saved(fitted.model),
        CHURN: registry.saved(model),
        PROFILE: registry.stored(profile.coalesce(1)),
    }
    return registry.publish(transactions.sparkSession, output, version, parts, score)


def with_model_segment(spark: SparkSession, customers: DataFrame, output: str) -> DataFrame:
    """Feature rows with the ``segment`` that the models in use give them; the default where there is no name."""
    clustered = segmentation.assign_clusters(customers, registry.load(spark, output, SEGMENTATION))
    named = with_segment(clustered, registry.table(spark, output, PROFILE)).drop("cluster")
    return named.withColumn("segment", F.coalesce("segment", F.lit(MEDIUM)))
