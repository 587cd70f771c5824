import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketlens.operators import metrics, ranking, reports
from basketlens.operators.quantiles import exact_quantiles, to_long

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("kind", ["smooth", "hot", "small"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(7)
    n = 9 if kind == "small" else 50_000
    values = np.round(rng.lognormal(3, 1, n), 2)
    if kind == "hot":
        values[: n // 3] = 20.0  # one value holds a third of the rows
    groups = np.where(rng.random(n) < 0.3, "a", "b")
    frame = pd.DataFrame({"g": groups, "x": values})
    frame.loc[len(frame)] = ["a", np.nan]
    rows = spark.createDataFrame(frame).withColumn("x", F.when(~F.isnan("x"), F.col("x"))).repartition(7)
    found = exact_quantiles(to_long(rows, ["g"], ["x"]), ["g", "feature"], PROBS).collect()
    assert {r.g for r in found} == {"a", "b"}
    for row in found:
        wanted = frame[(frame.g == row.g) & frame.x.notna()].x.to_numpy()
        assert row.n == len(wanted)
        assert np.allclose(row.quantiles, np.quantile(wanted, PROBS), rtol=1e-12, atol=0)


def test_global_row_number_with_a_hot_key(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 50).cast("int")).alias("frequency"),
        F.format_string("%06d", F.col("id")).alias("customer_id"),
    )
    ranked = ranking.global_row_number(rows.repartition(11), ["frequency", "customer_id"]).toPandas()
    wanted = rows.toPandas().sort_values(["frequency", "customer_id"], ignore_index=True)
    ranked = ranked.sort_values("rank", ignore_index=True)
    assert ranked["rank"].tolist() == list(range(1, 30_001))
    assert ranked["customer_id"].tolist() == wanted["customer_id"].tolist()


def test_latest_per_key(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x", None), ("a", 2, "y", "p"), ("a", 2, "z", None), ("b", 1, "w", "q")],
        "k string, t int, u string, v string",
    )
    found = {r.k: r.v for r in ranking.latest_per_key(rows, ["k"], ["t", "u"], ["v"]).collect()}
    assert found == {"a": None, "b": "q"}


def test_histogram_of_one_value(spark):
    bins = reports.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 4).collect()
    assert sum(r["count"] for r in bins) == 2
    assert (min(r.lower for r in bins), max(r.upper for r in bins)) == (2.5, 3.5)


def test_box_stats(spark):
    rows = spark.createDataFrame([(0, float(x)) for x in (1, 2, 3, 4, 100)], "churn int, x double")
    row = reports.box_stats(rows, "churn", ["x"]).first()
    assert (row.q1, row.median, row.q3) == (2.0, 3.0, 4.0)
    assert (row.whisker_low, row.whisker_high, row.outliers) == (1.0, 4.0, 1)


def test_observed_count(spark):
    frame, observation = reports.observed(spark.range(42), "seen")
    frame.write.format("noop").mode("overwrite").save()
    assert observation.get == {"rows": 42}


def test_empty_log(spark):
    empty = spark.createDataFrame([], "response_time_ms double, churn_probability double")
    assert reports.average_response_time(empty).first()[0] == 0
    assert reports.average_churn_probability(empty).first()[0] == 0.0
    assert reports.total_rows(empty).first()[0] == 0


def test_versions_without_a_number_come_last(spark):
    log = spark.createDataFrame([("10",), ("9",), ("mock_v1",), ("9",)], "model_version string")
    assert [tuple(r) for r in reports.predictions_by_version(log).collect()] == [
        ("9", 2), ("10", 1), ("mock_v1", 1),
    ]


def test_report_without_predictions_of_a_class(spark):
    rows = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    report = {r.row: r for r in metrics.classification_report(rows, "y", "p").collect()}
    assert (report["1"].precision, report["1"].recall, report["1"].f1, report["1"].support) == (0, 0, 0, 1)
    assert (report["0"].precision, report["0"].recall) == (0.5, 1.0)
    assert report["accuracy"].f1 == 0.5 and report["macro avg"].recall == 0.5


def test_promotion_gate(spark):
    rows = spark.createDataFrame([(1, 0.5), (2, 0.4), (3, 0.5), (4, 0.2)], "version int, churn_f1 double")
    gated = metrics.promotion_gate(rows, "version").orderBy("version").collect()
    assert [r.promoted for r in gated] == [True, False, True, False]
    assert [r.in_production for r in gated] == [False, False, True, False]


def silhouette_of(points, labels, squared):
    far = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    far = far if squared else np.sqrt(far)
    scores = []
    for i, own in enumerate(labels):
        mine = labels == own
        if mine.sum() == 1:
            scores.append(0.0)
            continue
        a = far[i, mine].sum() / (mine.sum() - 1)
        b = min(far[i, labels == other].mean() for other in set(labels) - {own})
        scores.append((b - a) / max(a, b))
    return np.mean(scores)


def test_silhouette_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(157, 2))
    labels = rng.integers(0, 3, 157)
    labels[0] = 9  # a cluster of one point
    frame = spark.createDataFrame(pd.DataFrame({"x": points[:, 0], "y": points[:, 1], "cluster": labels}))
    found = metrics.silhouette_squared(frame, ["x", "y"])
    assert abs(found.first()[0] - silhouette_of(points, labels, True)) < 1e-9
