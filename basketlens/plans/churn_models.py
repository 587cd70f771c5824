"""Churn models: fit, predict, compare, explain, promote, store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.constants import CHURN_FEATURES, CUTOFF_DAYS, SEGMENTATION_FEATURES, SPLIT_SEED, TEST_FRACTION
from basketlens.operators import churn, metrics
from basketlens.operators.splits import exact_split, train_test
from basketlens.plans import newton
from basketlens.plans.boosting import fit_boosting
from basketlens.plans.forest import fit_forest
from basketlens.plans.scaling import VECTOR, drop_working_columns, fit_scaling, scale, scaling_stages
from basketlens.schemas import MODEL_METRICS
from basketlens.session import materialize

LOGISTIC, FOREST, BOOSTING = "LogisticRegression", "RandomForest", "GradientBoosting"
CANDIDATES = (LOGISTIC, FOREST, BOOSTING)


def fit_trees(name: str, scaled: DataFrame, width: int, seed: int = SPLIT_SEED) -> Model:
    """A tree model by name, on ``churn`` and the scaled vector of ``width`` features."""
    if name == FOREST:
        return fit_forest(scaled, width, trees=100, depth=30, seed=seed)
    if name == BOOSTING:
        return fit_boosting(scaled, width, trees=100, depth=3, step=0.1)
    raise ValueError(f"unknown model {name}")


def logistic_model(solution: newton.Solution, features: Sequence[str]) -> PipelineModel:
    """Scaling and scores of a solution as one saved model."""
    stages = scaling_stages(features, solution.means, solution.deviations)
    return PipelineModel(stages=[*stages, newton.LogisticScores(solution.weights, solution.intercept)])


def fit_logistic(
    train: DataFrame, features: Sequence[str] = tuple(CHURN_FEATURES), group: str | None = None, penalty: float = 1.0
) -> dict[object, newton.Solution]:
    """Solutions by value of ``group``, all from the same passes; without one, a single solution under 0."""
    frame = train if group else train.withColumn("_all", F.lit(0))
    return newton.solve(frame.select(group or "_all", "churn", *features), group or "_all", features, penalty=penalty)


def fit(
    name: str, train: DataFrame, features: Sequence[str] = tuple(CHURN_FEATURES), seed: int = SPLIT_SEED
) -> PipelineModel:
    """Scaling and the named model, both over all rows."""
    if name == LOGISTIC:
        return logistic_model(fit_logistic(train, features)[0], features)
    stages = fit_scaling(train, features)
    model = fit_trees(name, scale(train, stages).select("churn", VECTOR), len(features), seed)
    return PipelineModel(stages=[*stages, model])


def predict(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``is_churn`` and ``churn_probability``."""
    scored = model.transform(df).withColumns(
        {
            "churn_probability": vector_to_array("probability")[1],
            "is_churn": F.col("prediction").cast("int"),
        }
    )
    return drop_working_columns(scored).drop("probability", "prediction")


def evaluate(test: DataFrame, model: PipelineModel, name: str, days: int, churn_rate: float) -> DataFrame:
    """One row of the metrics table; the churn rate is that of all labelled customers."""
    scored = predict(test, model).withColumn("model", F.lit(name)).withColumn("cutoff_days", F.lit(days))
    return (
        metrics.binary_scores(scored, ["model", "cutoff_days"], prediction="is_churn")
        .withColumn("churn_rate", F.lit(churn_rate))
        .select(*MODEL_METRICS.names)
    )


def weights(model: PipelineModel, features: Sequence[str] = tuple(CHURN_FEATURES)) -> list[tuple[str, str, float]]:
    """(kind, feature, value): coefficients of a linear model, importances of trees."""
    fitted: Model = model.stages[-1]
    kind = "coefficient" if hasattr(fitted, "coefficients") else "importance"
    values = fitted.coefficients if kind == "coefficient" else fitted.featureImportances
    return [(kind, name, float(value)) for name, value in zip(features, values.toArray())]


def weights_frame(spark: SparkSession, rows: Sequence[tuple[str, str, str, float]]) -> DataFrame:
    return spark.createDataFrame(list(rows), "model string, kind string, feature string, value double")


def split_training(frame: DataFrame, test_fraction: float = TEST_FRACTION, seed: int = SPLIT_SEED):
    """Stored stratified split, so that every model sees the same rows."""
    stored = materialize(frame, "training")
    return train_test(exact_split(stored, test_fraction, seed, stratify="churn"))


def compare_candidates(
    frame: DataFrame,
    days: int = CUTOFF_DAYS,
    names: Sequence[str] = CANDIDATES,
    features: Sequence[str] = tuple(CHURN_FEATURES),
    seed: int = SPLIT_SEED,
) -> tuple[dict[str, PipelineModel], DataFrame, DataFrame]:
    """Fit each candidate on one split; the models, their metrics and their weights."""
    train, test = split_training(frame, seed=seed)
    rate = train.unionByName(test).agg(F.avg("churn")).first()[0]
    fitted = {name: fit(name, train, features, seed) for name in names}
    table = None
    for name, model in fitted.items():
        row = evaluate(test, model, name, days, rate)
        table = row if table is None else table.unionByName(row)
    rows = [(name, *row) for name, model in fitted.items() for row in weights(model, features)]
    return fitted, table, weights_frame(frame.sparkSession, rows)


def cutoff_sensitivity(
    transactions: DataFrame,
    cutoffs: Sequence[int] = (90, 120, 180),
    features: Sequence[str] = tuple(SEGMENTATION_FEATURES),
    seed: int = SPLIT_SEED,
) -> DataFrame:
    """Logistic coefficients per cutoff; frames, splits and fits of all cutoffs share their passes."""
    solutions = cutoff_solutions(transactions, cutoffs, features, seed)
    rows = [(days, name, float(value)) for days in cutoffs for name, value in zip(features, solutions[days].weights)]
    return transactions.sparkSession.createDataFrame(
        rows, "cutoff_days int, feature string, coefficient double"
    )


def cutoff_solutions(
    transactions: DataFrame,
    cutoffs: Sequence[int] = (90, 120, 180),
    features: Sequence[str] = tuple(SEGMENTATION_FEATURES),
    seed: int = SPLIT_SEED,
) -> dict[object, newton.Solution]:
    """The solution on the training side of every cutoff."""
    frames = materialize(churn.training_frames(transactions, cutoffs), "frames")
    train, _ = train_test(exact_split(frames, seed=seed, stratify=["cutoff_days", "churn"]))
    return fit_logistic(train, features, "cutoff_days")


# --- store and promote ----------------------------------------------------------


def save_model(model: PipelineModel, root: str, name: str, version: int) -> str:
    path = f"{root}/{name}/version={version}"
    model.write().overwrite().save(path)
    return path


def load_model(root: str, name: str, version: int) -> PipelineModel:
    return PipelineModel.load(f"{root}/{name}/version={version}")


def record_metrics(table: DataFrame, version: int, path: str) -> None:
    """Metrics of one version; a version that is recorded again replaces itself."""
    (
        table.withColumn("version", F.lit(version))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("version")
        .parquet(path)
    )


def production_version(spark: SparkSession, path: str, model: str = LOGISTIC) -> int | None:
    """Last version of ``model`` that passed the gate, from the metrics table."""
    versions = spark.read.parquet(path).where(F.col("model") == model)
    gated = metrics.promotion_gate(versions, "version").where("in_production").select("version").first()
    return None if gated is None else gated["version"]


def promote(spark: SparkSession, output: str) -> int | None:
    """Name the version in production that the gate lets through, for all models of a job's output."""
    version = production_version(spark, f"{output}/model_metrics")
    if version is not None:
        spark.createDataFrame([(version,)], "version int").coalesce(1).write.mode("overwrite").parquet(f"{output}/production")
    return version


def churn_job(
    transactions: DataFrame,
    days: int = CUTOFF_DAYS,
    names: Sequence[str] = CANDIDATES,
    seed: int = SPLIT_SEED,
    output: str | None = None,
    version: int = 1,
) -> tuple[dict[str, PipelineModel], DataFrame, DataFrame]:
    """From transactions to fitted, compared and stored churn models.

    The logistic model is the one that is stored for use, whatever the others
    score, and only a version that passes the gate is put into production: the
    table ``production`` then names it.
    """
    fitted, table, explained = compare_candidates(churn.training_frame(transactions, days), days, names, seed=seed)
    if output:
        save_model(fitted[LOGISTIC], output, "churn", version)
        record_metrics(table, version, f"{output}/model_metrics")
        promote(transactions.sparkSession, output)
    return fitted, table, explained
