import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from basketlens import constants as C
from basketlens.operators import metrics
from basketlens.plans import churn_models, segmentation
from basketlens.plans.scaling import VECTOR, fit_scaling, scale
from basketlens.session import materialize, working_path
from checks import fixtures as fx


@pytest.fixture(scope="module")
def features(spark, folder):
    return materialize(fx.features_wide(spark, folder), "test-features")


@pytest.fixture(scope="module")
def split(spark, folder):
    return churn_models.split_training(fx.churn_training_frame(spark, folder))


def test_scaled_vectors(features):
    stages = fit_scaling(features, C.SEGMENTATION_FEATURES, C.LOG_SCALED_FEATURES)
    values = np.array(
        [r[0] for r in scale(features, stages).select(vector_to_array(VECTOR)).collect()]
    )
    assert np.allclose(values.mean(axis=0), 0, atol=1e-9) and np.allclose(values.std(axis=0), 1)


def test_segmentation_is_repeatable_and_ours_agrees_with_the_evaluator(features):
    first = segmentation.fit_segmentation(features, starts=2)
    again = segmentation.fit_segmentation(features, starts=2)
    assert np.allclose(first.stages[-1].clusterCenters(), again.stages[-1].clusterCenters())
    clustered = first.transform(features)
    wanted = ClusteringEvaluator(featuresCol=VECTOR, predictionCol="cluster").evaluate(clustered)
    parts = vector_to_array(VECTOR)
    points = clustered.select("cluster", *[parts[i].alias(f"x{i}") for i in range(3)])
    assert abs(metrics.silhouette_squared(points, ["x0", "x1", "x2"]).first()[0] - wanted) < 1e-9


def test_choose_k_takes_the_best_score(features):
    fitted = segmentation.choose_k(features, [2, 3])
    assert [k for k, _ in fitted.scores] == [2, 3]
    assert fitted.silhouette == max(score for _, score in fitted.scores)
    assert fitted.model.stages[-1].getK() == fitted.k


def test_inertia_falls(features):
    rows = segmentation.elbow(features, [1, 2, 4, 8]).orderBy("k").collect()
    costs = [r.inertia for r in rows]
    assert [r.k for r in rows] == [1, 2, 4, 8]
    assert abs(costs[0] - 3 * features.count()) < 1e-6  # three columns of unit variance
    assert costs == sorted(costs, reverse=True)


def test_principal_components(features):
    assert segmentation.principal_components(features, ["recency"]) is None
    projected, shares = segmentation.principal_components(features)
    stages = fit_scaling(features, C.SEGMENTATION_FEATURES, C.LOG_SCALED_FEATURES)
    x = np.array([r[0] for r in scale(features, stages).select(vector_to_array(VECTOR)).collect()])
    eigen = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert np.allclose(shares, eigen[:2] / eigen.sum())
    found = projected.agg(F.var_samp("pc1"), F.var_samp("pc2"), F.avg("pc1")).first()
    assert np.allclose(found[:2], eigen[:2]) and abs(found[2]) < 1e-9


def test_segmentation_job_stores_both_sides(spark, features):
    output = working_path(spark, "test-job")
    fitted, train, test, profile = segmentation.segmentation_job(features, ks=(3,), output=output)
    assert fitted.k == 3 and profile.count() == 3
    stored = [spark.read.parquet(f"{output}/{s}") for s in ("train_clusters", "customer_clusters")]
    assert stored[0].count() + stored[1].count() == features.count()
    assert stored[1].where("segment is null").count() == 0


def test_logistic_regression_is_at_the_optimum_of_the_summed_loss(split):
    """Gradient of sum(loss) + |w|^2 / 2 at the solution, intercept not penalised."""
    train, _ = split
    model = churn_models.fit(churn_models.LOGISTIC, train)
    fitted = model.stages[-1]
    rows = model.transform(train).select("churn", vector_to_array(VECTOR)).collect()
    y, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    w, b = fitted.coefficients.toArray(), fitted.intercept
    residual = 1 / (1 + np.exp(-(x @ w + b))) - y
    assert np.abs(x.T @ residual + w).max() < 1e-4 and abs(residual.sum()) < 1e-4


def test_models_predict_and_explain(spark, split):
    train, test = split
    model = churn_models.fit(churn_models.FOREST, train, C.SEGMENTATION_FEATURES)
    scored = churn_models.predict(test, model)
    assert scored.columns == [*test.columns, "churn_probability", "is_churn"]
    assert scored.where("is_churn <> cast(churn_probability > 0.5 as int) and churn_probability <> 0.5").count() == 0
    kinds = churn_models.weights(model, C.SEGMENTATION_FEATURES)
    assert {k for k, _, _ in kinds} == {"importance"} and abs(sum(v for _, _, v in kinds) - 1) < 1e-9


def test_save_load_and_promote(spark, split):
    train, test = split
    root = working_path(spark, "test-models")
    model = churn_models.fit(churn_models.LOGISTIC, train)
    for version in (1, 2):
        churn_models.save_model(model, root, "churn", version)
        table = churn_models.evaluate(test, model, churn_models.LOGISTIC, 90, 0.5)
        churn_models.record_metrics(table, version, f"{root}/model_metrics")
    assert churn_models.production_version(spark, f"{root}/model_metrics") == 2
    again = churn_models.predict(test, churn_models.load_model(root, "churn", 2))
    assert again.exceptAll(churn_models.predict(test, model)).count() == 0


def test_boosting_runs_with_a_cut_lineage(split):
    train, test = split
    model = churn_models.fit(churn_models.BOOSTING, train, C.SEGMENTATION_FEATURES)
    assert churn_models.evaluate(test, model, churn_models.BOOSTING, 90, 0.5).first().accuracy > 0.4
