import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from basketlens.plans import churn_models, forest
from basketlens.plans.scaling import VECTOR, fit_scaling, scale
from basketlens.session import materialize, working_path


def noisy(spark, n=6000):
    """Two features decide most labels, one does not; a fifth of the labels are noise."""
    def draw(i):
        return F.pmod(F.xxhash64("id", F.lit(i)), F.lit(10_000)) / 10_000.0

    rows = spark.range(n).select("id", *[draw(i).alias(f"f{i}") for i in range(3)], (draw(8) < 0.2).alias("noise"), draw(9).alias("coin"))
    label = F.when(F.col("noise"), F.col("coin") < 0.5).otherwise((F.col("f0") > 0.5) != (F.col("f1") > 0.3))
    return materialize(rows.select("id", "f0", "f1", "f2", label.cast("int").alias("churn")), "noisy")


def fitted(spark, rows, **settings):
    names = ["f0", "f1", "f2"]
    stages = fit_scaling(rows, names)
    model = forest.fit_forest(scale(rows, stages).select("churn", VECTOR), 3, **settings)
    return PipelineModel(stages=[*stages, model])


def accuracy(model, rows):
    scored = churn_models.predict(rows, model)
    return scored.agg(F.avg((F.col("is_churn") == F.col("churn")).cast("double"))).first()[0]


def test_deep_trees_learn_what_a_line_can_not(spark):
    rows = noisy(spark)
    train, test = rows.where("id % 4 > 0"), rows.where("id % 4 = 0")
    for leaf_rows in (600, 1 << 20):  # levels from histograms and parts below them, and parts alone
        model = fitted(spark, train, trees=10, seed=3, leaf_rows=leaf_rows)
        assert accuracy(model, test) > 0.8
        assert accuracy(model, train) > 0.87  # depth 30 follows the noise of its own rows
        shares = model.stages[-1].featureImportances.toArray()
        assert abs(shares.sum() - 1) < 1e-9 and shares.min() > 0 and shares.argmin() == 2


def test_one_full_tree_is_what_its_rows_say(spark):
    """By every feature and with all rows drawn once, a tree tells apart all rows whose bins differ."""
    rows = spark.createDataFrame([(a, b, int((a + b) % 2 == 0 or a == 3)) for a in range(8) for b in range(8) for _ in range(5)], "f0 int, f1 int, churn int")
    stages = fit_scaling(rows, ["f0", "f1"])
    scaled = scale(rows, stages)
    model = forest.fit_forest(scaled.select("churn", VECTOR), 2, trees=60, seed=1, leaf_rows=40)
    found = model.transform(scaled).select("f0", "f1", "churn", vector_to_array("probability")[1].alias("p"), "prediction").collect()
    assert len(found) == 320 and all((row.p > 0.5) == (row.churn == 1) == (row.prediction == 1.0) for row in found)


def test_a_part_holds_few_rows_and_the_driver_no_deep_tree(spark):
    """The first levels on the driver have some nodes per part; what lies below is in the stored parts."""
    rows = noisy(spark)
    stages = fit_scaling(rows, ["f0", "f1", "f2"])
    model = forest.fit_forest(scale(rows, stages).select("churn", VECTOR), 3, trees=10, seed=5, leaf_rows=500)
    parts = model.parts.select("tree", "part", (F.length("feature")).alias("nodes")).collect()
    held = sum(len(tree.feature) for tree in model.grown)
    assert {part.tree for part in parts} == set(range(10))
    assert sum(part.nodes for part in parts) > 20 * held and max(part.nodes for part in parts) < 2 * 500
    opened = {(number, node) for number, tree in enumerate(model.grown) for node, mark in enumerate(tree.feature) if mark == forest._OPEN}
    assert opened == {(part.tree, part.part) for part in parts}


def test_one_label_and_equal_rows_end_in_leaves(spark):
    for churn, wanted in ((0, 0.0), (1, 1.0)):
        rows = spark.range(50).select(F.lit(1.0).alias("f0"), F.col("id").alias("f1"), F.lit(2).alias("f2"), F.lit(churn).alias("churn"))
        model = fitted(spark, rows, trees=3, seed=1, leaf_rows=10)
        assert {row.churn_probability for row in churn_models.predict(rows, model).collect()} == {wanted}
    rows = spark.range(60).select(F.lit(1.0).alias("f0"), F.lit(1.0).alias("f1"), F.lit(1.0).alias("f2"), (F.col("id") % 3 == 0).cast("int").alias("churn"))
    shares = {row.churn_probability for row in churn_models.predict(rows, fitted(spark, rows, trees=40, seed=1)).collect()}
    assert len(shares) == 1 and abs(shares.pop() - 1 / 3) < 0.08


def test_a_saved_forest_says_the_same(spark):
    rows = noisy(spark, 800)
    model = fitted(spark, rows, trees=8, seed=2, leaf_rows=100)
    root = working_path(spark, "forests")
    churn_models.save_model(model, root, "forest", 1)
    loaded = churn_models.load_model(root, "forest", 1)
    assert churn_models.predict(rows, loaded).exceptAll(churn_models.predict(rows, model)).count() == 0
    assert np.allclose(loaded.stages[-1].featureImportances.toArray(), model.stages[-1].featureImportances.toArray())


def test_candidates_are_compared_without_deep_trees_on_the_driver(spark):
    """The comparison fits the stored forest, and its metrics and weights come from it."""
    rows = noisy(spark, 400).withColumn("customer_id", F.col("id").cast("string"))
    models, table, explained = churn_models.compare_candidates(rows, names=[churn_models.FOREST], features=["f0", "f1", "f2"])
    assert isinstance(models[churn_models.FOREST].stages[-1], forest.ForestModel)
    assert table.first().accuracy > 0.5 and explained.count() == 3
