"""Scoring of request streams and logging of the predictions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.operators.cleaning import CHURN_REQUEST, SEGMENTATION_REQUEST, split_requests
from basketlens.operators.profiles import label_predictions
from basketlens.plans.churn_models import predict
from basketlens.plans.segmentation import assign_clusters
from basketlens.schemas import CHURN_LOG, PREDICTION_LOG
from basketlens.sources.logs import log_rows, request_id
from basketlens.streaming.changelog import write_batch

FEATURE_VERSION = "rfm_v1"


def _stamped(scored: DataFrame, version: str, batch: int, rules: dict[str, str]) -> DataFrame:
    """Log fields.

    Response time is a property of single requests and stays empty in bulk. Ids
    come from the request and its batch, so a repeated batch has the same ones.
    """
    return scored.withColumns(
        {
            "request_id": request_id(F.lit(version), F.lit(batch), F.coalesce("customer_id", F.lit("")), *map(F.col, rules)),
            "model_version": F.lit(version),
            "feature_version": F.lit(FEATURE_VERSION),
            "response_time_ms": F.lit(None).cast("double"),
        }
    )


def score_segments(
    model: PipelineModel, labels: DataFrame, version: str, path: str
) -> Callable[[DataFrame, int], None]:
    """Batch writer: valid requests are scored into the log, the rest goes to quarantine."""

    def write(requests: DataFrame, batch: int) -> None:
        valid, bad = split_requests(requests, SEGMENTATION_REQUEST)
        scored = label_predictions(assign_clusters(valid, model), labels)
        write_batch(log_rows(_stamped(scored, version, batch, SEGMENTATION_REQUEST), PREDICTION_LOG), batch, f"{path}/log")
        write_batch(bad, batch, f"{path}/quarantine")

    return write


def score_churn(model: PipelineModel, version: str, path: str) -> Callable[[DataFrame, int], None]:
    def write(requests: DataFrame, batch: int) -> None:
        valid, bad = split_requests(requests, CHURN_REQUEST)
        scored = predict(valid, model)
        write_batch(log_rows(_stamped(scored, version, batch, CHURN_REQUEST), CHURN_LOG), batch, f"{path}/log")
        write_batch(bad, batch, f"{path}/quarantine")

    return write
