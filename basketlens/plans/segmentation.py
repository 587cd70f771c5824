"""Customer segmentation with KMeans: fit, choose k, assign, profile, store."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.constants import LOG_SCALED_FEATURES, SEGMENTATION_FEATURES, SPLIT_SEED
from basketlens.operators.profiles import segment_customers, with_segment
from basketlens.operators.splits import exact_split, train_test
from basketlens.plans import lloyd, silhouette
from basketlens.plans.scaling import VECTOR, drop_working_columns, fit_scaling, scale
from basketlens.session import materialize


@dataclass
class FittedSegmentation:
    model: PipelineModel
    k: int
    silhouette: float
    scores: list[tuple[int, float]] = field(default_factory=list)
    fits: dict[int, lloyd.Fit] = field(default_factory=dict)  # the best of its starts for every k


def fit_segmentation(
    features: DataFrame,
    k: int = 4,
    columns: Sequence[str] = tuple(SEGMENTATION_FEATURES),
    seed: int = SPLIT_SEED,
    starts: int = 10,
) -> PipelineModel:
    """Select, log-scale, centre and cluster; ``starts`` seeds are tried together, the least cost wins."""
    return choose_k(features, [k], columns, seed, starts, metric=None).model


def assign_clusters(df: DataFrame, model: PipelineModel) -> DataFrame:
    return drop_working_columns(model.transform(df))


def choose_k(
    train: DataFrame,
    ks: Iterable[int],
    columns: Sequence[str] = tuple(SEGMENTATION_FEATURES),
    seed: int = SPLIT_SEED,
    starts: int = 1,
    metric: str | None = "squared",
) -> FittedSegmentation:
    """Fit every k on one scaled frame and keep the best silhouette, the first k on ties.

    ``metric`` names the silhouette: ``squared`` needs two linear passes for all k, ``euclidean`` bounds the
    plain one by summaries of cells; None scores nothing and keeps the first k.
    """
    stages = fit_scaling(train, columns, LOG_SCALED_FEATURES)
    rows = materialize(lloyd.points(scale(train, stages)), "points")
    best = lloyd.best_by_k(lloyd.fit_all(rows, [(k, seed + number) for k in ks for number in range(starts)]))
    centres = [fit.centres for fit in best.values()]
    if metric == "euclidean":
        found = [value for value, _ in silhouette.euclidean(rows, centres)]
    else:
        found = lloyd.silhouettes(rows, centres) if metric else [0.0] * len(centres)
    scores = list(zip(best, found))
    k, score = max(scores, key=lambda pair: pair[1])
    model = PipelineModel(stages=[*stages, lloyd.NearestCentre(best[k].centres)])
    return FittedSegmentation(model, k, score, scores, best)


def scores_frame(spark, scores: Sequence[tuple[int, float]]) -> DataFrame:
    return spark.createDataFrame(list(scores), "k int, silhouette double")


def total_inertia(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Inertia of one cluster: rows times the summed variances."""
    variances = sum((F.var_pop(name) for name in columns), F.lit(0.0))
    return df.agg((F.count(F.lit(1)) * variances).alias("inertia"))


def elbow(
    features: DataFrame,
    ks: Sequence[int] = range(1, 11),
    columns: Sequence[str] = ("recency", "frequency", "monetary"),
    seed: int = SPLIT_SEED,
) -> DataFrame:
    """Inertia by number of clusters, on scaled columns without the log step."""
    scaled_names = [f"_scaled_{name}" for name in columns]
    scaled = scale(features, fit_scaling(features, columns)).select(*scaled_names, VECTOR)
    scaled = materialize(scaled, "scaled")
    several = [k for k in ks if k > 1]
    rows = [(fit.k, fit.cost) for fit in lloyd.fit_all(lloyd.points(scaled), [(k, seed) for k in several])]
    if 1 in ks:
        rows.insert(0, (1, float(total_inertia(scaled, scaled_names).first()[0])))
    return features.sparkSession.createDataFrame(rows, "k int, inertia double")


def principal_components(
    df: DataFrame, columns: Sequence[str] = tuple(SEGMENTATION_FEATURES)
) -> tuple[DataFrame, list[float]] | None:
    """Rows with ``pc1`` and ``pc2``, and the share of variance of each; None for one feature.

    The scaled vectors are centred already, as the projection itself does not centre.
    """
    if len(columns) < 2:
        return None
    scaled = scale(df, fit_scaling(df, columns, LOG_SCALED_FEATURES))
    fitted = PCA(k=2, inputCol=VECTOR, outputCol="_components").fit(scaled)
    values = vector_to_array("_components")
    projected = fitted.transform(scaled).withColumns({"pc1": values[0], "pc2": values[1]})
    return drop_working_columns(projected).drop("_components"), list(fitted.explainedVariance)


def segmentation_job(
    features: DataFrame,
    ks: Iterable[int] = (4,),
    columns: Sequence[str] = tuple(SEGMENTATION_FEATURES),
    seed: int = SPLIT_SEED,
    output: str | None = None,
) -> tuple[FittedSegmentation, DataFrame, DataFrame, DataFrame]:
    """Split, choose k, assign both sides, profile and label the training side.

    Returns the fit, the training rows with cluster and segment, the test rows
    with the segment looked up in the same profile, and the profile. With
    ``output`` the tables, the profile and the model are stored together, so a
    model is never read with the labels of another.
    """
    train, test = train_test(exact_split(materialize(features, "features"), seed=seed))
    fitted = choose_k(train, ks, columns, seed)
    segmented, profile = segment_customers(assign_clusters(train, fitted.model))
    assigned = with_segment(assign_clusters(test, fitted.model), profile)
    if output:
        segmented.write.mode("overwrite").parquet(f"{output}/train_clusters")
        assigned.write.mode("overwrite").parquet(f"{output}/customer_clusters")
        profile.write.mode("overwrite").parquet(f"{output}/cluster_profile")
        fitted.model.write().overwrite().save(f"{output}/model")
    return fitted, segmented, assigned, profile


def feature_set_sweep(
    features: DataFrame, experiments: dict[str, Sequence[str]], ks: Sequence[int] = (4,), seed: int = SPLIT_SEED
) -> DataFrame:
    """Silhouette and chosen k per named feature set, all on one stored training side.

    ``customers`` and ``squares`` are the rows fitted and their squared length, as the fit sums them up.
    """
    train, _ = train_test(exact_split(materialize(features, "features"), seed=seed))
    rows = []
    for name, columns in experiments.items():
        fitted = choose_k(train, ks, columns, seed)
        fit = fitted.fits[fitted.k]
        rows.append((name, ",".join(columns), fitted.k, float(fitted.silhouette), int(fit.counts.sum()), fit.squares()))
    return features.sparkSession.createDataFrame(
        rows,
        "experiment string, feature_set string, n_clusters int, silhouette double, customers long, squares double",
    )
