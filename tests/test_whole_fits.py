import numpy as np
from pyspark.sql import functions as F

from basketlens.plans import churn_models, forest
from basketlens.plans.newton import LogisticScores
from basketlens.plans.scaling import VECTOR, fit_scaling, scale
from basketlens.session import materialize

NAMES = ["f0", "f1"]


def many(spark, n):
    values = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)).alias(f"f{i}") for i in range(2)]
    return spark.range(n).select(F.col("id").cast("string").alias("customer_id"), *values, (F.col("id") % 2).cast("int").alias("churn"))


def counting(monkeypatch):
    """Rows given to each tree fit, which itself is not run."""
    seen = {}

    def fit_trees(name, scaled, width, seed):
        seen[name] = scaled.count()
        return LogisticScores([0.0] * width, 0.0)

    monkeypatch.setattr(churn_models, "fit_trees", fit_trees)
    return seen


def test_candidates_are_compared_on_fits_of_the_whole_training_side(spark, monkeypatch):
    seen, names = counting(monkeypatch), [churn_models.FOREST, churn_models.BOOSTING]
    _, table, _ = churn_models.compare_candidates(many(spark, 1_300_000), names=names, features=NAMES)
    assert seen == dict.fromkeys(names, 1_040_000)
    assert {row.model for row in table.collect()} == set(names)


def test_a_fit_reads_every_row(spark, monkeypatch):
    seen, rows = counting(monkeypatch), many(spark, 1_100_000)
    for name in (churn_models.FOREST, churn_models.BOOSTING):
        assert len(churn_models.fit(name, rows, NAMES).stages) == 3
    assert seen == {churn_models.FOREST: 1_100_000, churn_models.BOOSTING: 1_100_000}


def test_a_part_is_copied_for_the_rows_that_reach_it_alone(spark, monkeypatch):
    """Parts meet their own rows in blocks; what is copied does not grow with the rows of other parts."""
    rows = materialize(many(spark, 6000), "rows")
    scaled = scale(rows, fit_scaling(rows, NAMES))
    model = forest.fit_forest(scaled.select("churn", VECTOR), 2, trees=5, seed=1, leaf_rows=300)

    def shares():
        return model.transform(scaled).select("customer_id", "probability").orderBy("customer_id").collect()

    wanted = shares()
    binned = scaled.select(F.monotonically_increasing_id().alias("id"), forest._bins(forest.vector_to_array(VECTOR), model.limits).alias("x"))
    asked = materialize(binned.dropDuplicates(["x"]), "asked")
    reached = forest._routed(asked, model.grown, 2, votes=True).where("part >= 0").groupBy("tree", "part").count().collect()
    size = int(np.median([row["count"] for row in reached]))
    monkeypatch.setattr(forest, "BLOCK_ROWS", size)
    found = {(row.tree, row.part): row.blocks for row in forest._crowded(asked, model.grown, 2).collect()}
    assert found == {(row.tree, row.part): -(-row["count"] // size) for row in reached if row["count"] > size}
    assert 0 < len(found) < len(reached) and asked.count() > 3 * size
    assert shares() == wanted
