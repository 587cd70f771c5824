import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from basketlens.plans import boosting, churn_models
from basketlens.plans.scaling import VECTOR, fit_scaling, scale
from basketlens.session import materialize, working_path

NAMES = ["f0", "f1", "f2"]


def rows_of(spark, n=4000):
    """Features of few values, so that both libraries know the same bins; a fifth of the labels are noise."""
    def draw(i):
        return F.pmod(F.xxhash64("id", F.lit(i)), F.lit(10_000)) / 10_000.0

    values = [F.floor(draw(i) * size).alias(f"f{i}") for i, size in enumerate((20, 7, 30))]
    rows = spark.range(n).select("id", *values, (draw(8) < 0.2).alias("noise"), draw(9).alias("coin"))
    label = F.when(F.col("noise"), F.col("coin") < 0.5).otherwise((F.col("f0") > 9) != (F.col("f1") * F.col("f2") > 40))
    return materialize(rows.select("id", *NAMES, label.cast("int").alias("churn")), "boosted")


def test_trees_are_those_of_spark(spark):
    """Same probabilities and importances, past the place where margins are kept."""
    rows = rows_of(spark)
    scaled = scale(rows, fit_scaling(rows, NAMES))
    model = boosting.fit_boosting(scaled, 3, trees=25)
    other = GBTClassifier(labelCol="churn", featuresCol=VECTOR, maxIter=25, maxDepth=3, stepSize=0.1, seed=1).fit(scaled)
    def found(fitted):
        said = fitted.transform(scaled).select("id", vector_to_array("probability")[1].alias("p"), "prediction")
        return np.array(said.orderBy("id").collect())

    mine, theirs = found(model), found(other)
    assert np.allclose(mine, theirs, atol=1e-9) and 0.8 < np.mean(mine[:, 2]) + 0.5
    assert np.allclose(model.featureImportances.toArray(), other.featureImportances.toArray(), atol=1e-9)


def test_a_level_is_one_job_and_its_tasks_do_not_depend_on_the_files(spark, monkeypatch):
    jobs = []
    summed = boosting._summed

    def counted(state, *rest):
        jobs.append(state.getNumPartitions())
        return summed(state, *rest)

    monkeypatch.setattr(boosting, "_summed", counted)
    monkeypatch.setattr(boosting, "LEAST_ROWS", 100)
    rows = rows_of(spark)
    boosting.fit_boosting(scale(materialize(rows.repartition(60), "parts"), fit_scaling(rows, NAMES)), 3, trees=2)
    assert len(jobs) == 6 and 1 < max(jobs) <= spark.sparkContext.defaultParallelism


def test_sums_of_many_tasks_meet_on_the_executors(spark, monkeypatch):
    monkeypatch.setattr(boosting, "LEAST_ROWS", 100)
    rows = rows_of(spark, 800)
    scaled = scale(materialize(rows.repartition(6), "parts"), fit_scaling(rows, NAMES))
    wanted = boosting.fit_boosting(scaled, 3, trees=3)
    monkeypatch.setattr(boosting, "FEW_PARTS", 1)
    found = boosting.fit_boosting(scaled, 3, trees=3)
    assert np.allclose(found.featureImportances.toArray(), wanted.featureImportances.toArray())


def fitted(rows, trees=3):
    stages = fit_scaling(rows, NAMES)
    return PipelineModel(stages=[*stages, boosting.fit_boosting(scale(rows, stages), 3, trees=trees)])


def test_one_label_odd_labels_and_no_rows(spark):
    rows = spark.range(50).select(F.lit(1.0).alias("f0"), F.col("id").alias("f1"), F.lit(2).alias("f2"))
    for churn in (0, 1):
        labelled = rows.withColumn("churn", F.lit(churn))
        assert {row.is_churn for row in churn_models.predict(labelled, fitted(labelled)).collect()} == {churn}
    for label in (2, None):
        with pytest.raises(Exception, match="labels must be 0 or 1"):
            fitted(rows.withColumn("churn", F.lit(label).cast("int")))
    scaled = scale(labelled, fit_scaling(labelled, NAMES))
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit_boosting(scaled.where("f1 < 0"), 3)


def test_the_candidate_is_fitted_without_a_gathered_model(spark, monkeypatch):
    monkeypatch.setattr(churn_models, "fit_boosting", lambda scaled, width, **settings: (width, settings))
    assert churn_models.fit_trees(churn_models.BOOSTING, None, 3) == (3, {"trees": 100, "depth": 3, "step": 0.1})


def test_a_saved_boosting_says_the_same(spark):
    rows = rows_of(spark, 800)
    model = fitted(rows, 12)
    root = working_path(spark, "boosted")
    churn_models.save_model(model, root, "boosting", 1)
    loaded = churn_models.load_model(root, "boosting", 1)
    assert churn_models.predict(rows, loaded).exceptAll(churn_models.predict(rows, model)).count() == 0
