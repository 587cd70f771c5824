"""KMeans of many settings, Newton steps, the bounded silhouette and splits by selection, against brute force."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.operators import splits
from basketlens.plans import lloyd, newton, silhouette
from basketlens.plans.scaling import VECTOR
from basketlens.session import materialize, working_path


def stored(spark, values, parts=3):
    rows = spark.createDataFrame([([float(x) for x in row],) for row in values], "x array<double>")
    return materialize(rows.repartition(parts), "test-points")


def blobs(seed, n=900, k=4, width=3):
    pick = np.random.default_rng(seed)
    middle = pick.normal(size=(k, width)) * 3
    values = middle[np.arange(n) % k] + pick.normal(size=(n, width))
    return (values - values.mean(axis=0)) / values.std(axis=0)


def far(values, centres):
    return ((values[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)


@pytest.fixture(scope="module")
def cloud():
    return blobs(3)


@pytest.fixture(scope="module")
def rows(spark, cloud):
    return stored(spark, cloud)


def test_settings_together_cost_what_they_cost_alone(rows, cloud):
    settings = [(4, 1), (4, 2), (2, 1), (7, 5)]
    together = lloyd.fit_all(rows, settings)
    for pair, fit in zip(settings, together):
        (alone,) = lloyd.fit_all(rows, [pair])
        assert abs(alone.cost - fit.cost) < 1e-9 * fit.cost and np.allclose(alone.centres, fit.centres)
        assert abs(far(cloud, fit.centres).min(axis=1).sum() - fit.cost) < 1e-6
        assert fit.counts.sum() == len(cloud) and abs(fit.squares() - (cloud**2).sum()) < 1e-6
        own = far(cloud, fit.centres).argmin(axis=1)
        for c in range(fit.k):  # at rest: each centre is the mean of its rows, up to the tolerance
            assert np.linalg.norm(cloud[own == c].mean(axis=0) - fit.centres[c]) <= lloyd.TOLERANCE + 1e-9


def test_starts_find_separate_groups(spark):
    pick = np.random.default_rng(1)
    middle = np.array([[0, 0], [9, 0], [0, 9], [9, 9], [4.5, 20]], float)
    values = np.vstack([m + pick.normal(size=(60, 2)) * 0.1 for m in middle])
    values -= values.mean(axis=0)
    best = lloyd.best_by_k(lloyd.fit_all(stored(spark, values), [(5, s) for s in range(6)]))[5]
    assert sorted(best.counts) == [60] * 5 and best.cost < 0.04 * len(values)


def test_fewer_points_than_clusters(spark):
    fits = lloyd.fit_all(stored(spark, [[1.0, 0.0], [-1.0, 0.0]] * 5), [(2, 0), (3, 0)])
    assert [round(f.cost, 9) for f in fits] == [0, 0] and all(f.counts.sum() == 10 for f in fits)
    same = lloyd.fit_all(stored(spark, [[0.0, 0.0]] * 4), [(2, 0)])[0]
    assert same.cost == 0 and sorted(same.counts) == [0, 4]
    with pytest.raises(ValueError):
        lloyd.fit_all(stored(spark, []), [(2, 0)])


def test_nearest_centre_is_saved_and_loaded(spark, cloud):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField(VECTOR, VectorUDT())])
    frame = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(cloud[:50])], schema)
    centres = cloud[[3, 7, 7, 11]]  # a tie goes to the lower number
    path = working_path(spark, "test-centres")
    PipelineModel(stages=[lloyd.NearestCentre(centres)]).write().save(path)
    model = PipelineModel.load(path)
    assert model.stages[0].getK() == 4 and np.allclose(model.stages[0].clusterCenters(), centres)
    found = {r.n: r.cluster for r in model.transform(frame).collect()}
    assert found == dict(enumerate(far(cloud[:50], centres).argmin(axis=1).tolist()))


def plain(values, own):
    gaps = np.sqrt(far(values, values))
    labels = np.unique(own)
    scores = []
    for i in range(len(values)):
        mine = own == own[i]
        if mine.sum() < 2:
            scores.append(0.0)
            continue
        a = gaps[i, mine].sum() / (mine.sum() - 1)
        b = min(gaps[i, own == c].mean() for c in labels if c != own[i])
        scores.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(scores))


def squared(values, own):
    gaps = far(values, values)
    scores = []
    for i in range(len(values)):
        mine = own == own[i]
        a = gaps[i, mine].sum() / (mine.sum() - 1)
        b = min(gaps[i, own == c].mean() for c in np.unique(own) if c != own[i])
        scores.append((b - a) / max(a, b))
    return float(np.mean(scores))


def test_squared_silhouettes_of_all_settings(rows, cloud):
    settings = [cloud[:3], cloud[:6], cloud[:1]]
    found = lloyd.silhouettes(rows, settings)
    for centres, score in zip(settings[:2], found):
        assert abs(score - squared(cloud, far(cloud, centres).argmin(axis=1))) < 1e-9
    assert found[2] == -1.0


@pytest.mark.parametrize("cells", [30, 300, 2000])
def test_bounds_hold_the_plain_silhouette(rows, cloud, cells, monkeypatch):
    """Few cells, a good number, and more than rows, when nothing is summed up."""
    monkeypatch.setattr(silhouette, "CELLS", cells)
    settings = [cloud[:3], cloud[:6]]
    for centres, (value, bound) in zip(settings, silhouette.euclidean(rows, settings)):
        truth = plain(cloud, far(cloud, centres).argmin(axis=1))
        assert abs(truth - value) <= bound + 1e-9
        assert bound < {30: 0.25, 300: 0.06, 2000: 1e-3}[cells]


def test_silhouette_of_labels(spark, cloud):
    own = np.arange(len(cloud)) % 3
    own[0] = 9  # a cluster of one
    frame = spark.createDataFrame([(*map(float, v), int(c)) for v, c in zip(cloud, own)], "a double, b double, c double, cluster int")
    value, bound = silhouette.of_labels(frame, ["a", "b", "c"])
    assert abs(value - plain(cloud, own)) <= bound + 1e-9 and bound < 1e-3
    assert silhouette.of_labels(frame.withColumn("cluster", F.lit(1)), ["a", "b", "c"]) == (-1.0, 0.0)


def labelled(spark, seed, n=400):
    pick = np.random.default_rng(seed)
    x = pick.normal(size=(n, 3)) * [1, 20, 0.1] + [5, -3, 0]
    y = (x[:, 0] - 5 + x[:, 1] / 20 + pick.normal(size=n) > 0.3).astype(int)
    group = np.arange(n) % 3
    data = [(int(g), *map(float, v), int(t)) for g, v, t in zip(group, x, y)]
    return spark.createDataFrame(data, "part int, a double, b double, c double, churn int"), x, y, group


def optimum(x, y):
    """Plain gradient steps on the scaled columns, long enough."""
    z = np.column_stack([(x - x.mean(axis=0)) / x.std(axis=0), np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(20_000):
        ridge = np.append(w[:-1], 0)
        w -= (z.T @ (1 / (1 + np.exp(-z @ w)) - y) + ridge) / (len(x) * z.shape[1] / 4 + 1)
    return w


def test_groups_are_solved_together(spark):
    frame, x, y, group = labelled(spark, 5)
    solved = newton.solve(frame, "part", ["a", "b", "c"])
    assert set(solved) == {0, 1, 2}
    for g, solution in solved.items():
        wanted = optimum(x[group == g], y[group == g])
        assert np.allclose([*solution.weights, solution.intercept], wanted, atol=1e-6)
        assert np.abs(solution.gradient).max() < 1e-6 and solution.rows == (group == g).sum() and solution.steps < 15


def test_one_class_and_constant_columns(spark):
    rows = [(0, float(i % 5), 7.0, 1) for i in range(50)] + [(1, float(i % 5), 7.0, i % 5 // 3) for i in range(50)]
    solved = newton.solve(spark.createDataFrame(rows, "part int, a double, b double, churn int"), "part", ["a", "b"])
    assert solved[0].intercept > 5 and np.abs(solved[0].weights).max() < 1e-3  # all churn: as sure as the steps get
    assert abs(solved[1].weights[1]) < 1e-12 and np.abs(solved[1].gradient).max() < 1e-6  # a constant column has no weight


def test_scores_are_saved_and_loaded(spark):
    schema = T.StructType([T.StructField("_p", T.IntegerType()), T.StructField(VECTOR, VectorUDT())])
    frame = spark.createDataFrame([(i, Vectors.dense([i - 2.0, 1.0])) for i in range(5)], schema)
    path = working_path(spark, "test-scores")
    PipelineModel(stages=[newton.LogisticScores([2.0, -1.0], 0.5)]).write().save(path)
    found = {r["_p"]: (list(r.probability), r.prediction) for r in PipelineModel.load(path).transform(frame).collect()}
    for i, (both, prediction) in found.items():
        p = 1 / (1 + np.exp(-(2 * (i - 2) - 1 + 0.5)))
        assert np.allclose(both, [1 - p, p]) and prediction == float(p > 0.5)


def draws(frame, names):
    """Test ids by sorting all draws of a class."""
    import hashlib
    import math
    from collections import defaultdict

    classes = defaultdict(list)
    for row in frame.collect():
        classes[tuple(row[n] for n in names)].append((hashlib.md5(f"{row.customer_id}|42".encode()).hexdigest(), row.customer_id))
    return {c for rows in classes.values() for _, c in sorted(rows)[: math.ceil(len(rows) * 0.2)]}


@pytest.mark.parametrize("names", [[], ["churn"], ["days", "churn"]])
def test_selection_finds_what_sorting_finds(spark, names, monkeypatch):
    """Also with so short digits and so few rows that the histogram is refined several times; classes of one row and null."""
    frame = spark.range(3001).select(
        F.col("id").cast("string").alias("customer_id"),
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") == 7, 5).when(F.col("id") > 20, 0).alias("churn"),
        (F.col("id") % 2).alias("days"),
    )
    frame = materialize(frame, "test-split")
    for prefix, few in ((4, 1000), (1, 2)):
        monkeypatch.setattr(splits, "_PREFIX", prefix)
        monkeypatch.setattr(splits, "_FEW", few)
        found = splits.exact_split(frame, stratify=names or None)
        assert found.columns == [*frame.columns, "is_test"] and found.count() == 3001
        assert {r.customer_id for r in found.where("is_test").collect()} == draws(frame, names)


def test_a_split_moves_no_rows(spark):
    frame = materialize(spark.range(500).select(F.col("id").cast("string").alias("customer_id"), (F.col("id") % 3).alias("churn")), "test-split")
    plan = splits.exact_split(frame, stratify="churn")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and plan.count("Exchange") == plan.count("BroadcastExchange") and "Sort" not in plan


def test_split_of_nothing(spark):
    empty = spark.createDataFrame([], "customer_id string, churn int")
    assert splits.exact_split(empty).count() == 0 and splits.exact_split(empty, stratify="churn").count() == 0


def test_few_distances_are_held_at_once():
    """A batch of rows against some hundred seeding rows is cut so that the matrices stay small."""
    batch = pa.RecordBatch.from_pydict({"x": pa.array(list(np.ones((10_000, 3))))})
    for centres in (1, 54, 401, 4001):
        tracemalloc.start()
        seen = sum(len(lloyd.distances(chunk, np.zeros((centres, 3)))) for chunk in lloyd._chunks(iter([batch]), centres))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert seen == 10_000 and peak < 12 << 20
