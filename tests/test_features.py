import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketlens.operators import churn, profiles, rfm, scoring, splits
from checks import fixtures as fx

SCHEMA = "invoice_no string, customer_id string, invoice_date timestamp_ntz, quantity int, order_value double"
END = dt.datetime(2024, 6, 30, 12)


def day(back, hour=12):
    return (END - dt.timedelta(days=back)).replace(hour=hour)


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(
        [
            # hours 9 and 15 tie; two lines of one invoice; one cancellation
            ("1", "a", day(10, 9), 1, 10.0),
            ("1", "a", day(10, 15), 2, 20.0),
            ("2", "a", day(60, 9), 1, 40.0),
            ("C3", "a", day(5, 15), -1, -5.0),
            # only a cancellation
            ("C4", "b", day(200, 20), -2, -8.0),
            # exactly on the edges of the trailing windows
            ("5", "c", END - dt.timedelta(days=30), 1, 7.0),
            ("6", "c", END - dt.timedelta(days=90), 1, 14.0),
            # no customer, but the latest date of all rows
            ("7", None, END, 1, 1.0),
            # a null invoice counts as one, a bad value as zero
            (None, "d", day(1), 1, None),
        ],
        SCHEMA,
    )


def by_customer(frame):
    return {r.customer_id: r.asDict() for r in frame.collect()}


@pytest.mark.parametrize("store", [False, True])
def test_features(lines, store):
    found = by_customer(rfm.rfm_wide(lines, store_invoices=store))
    assert set(found) == {"a", "b", "c", "d"}
    a = found["a"]
    assert (a["recency"], a["frequency"], a["monetary"]) == (4, 2, 70.0)
    assert (a["avg_order_value"], a["monetary_30"], a["monetary_90"]) == (35.0, 30.0, 70.0)
    assert a["spending_velocity"] == 1.29  # 30 / (70 / 3)
    assert (a["cancelled_orders"], a["total_orders"], a["cancellation_rate"]) == (1, 3, 0.3333)
    assert a["preferred_shopping_hour"] == 9
    b = found["b"]
    assert (b["frequency"], b["avg_order_value"], b["spending_velocity"]) == (0, 0.0, 1.0)
    assert (b["cancellation_rate"], b["preferred_shopping_hour"]) == (1.0, 20)
    c = found["c"]
    assert (c["monetary_30"], c["monetary_90"]) == (7.0, 21.0)
    d = found["d"]
    assert (d["frequency"], d["avg_order_value"], d["total_orders"]) == (1, 0.0, 1)


def test_given_date(lines):
    later = F.lit(END + dt.timedelta(days=10)).cast("timestamp_ntz")
    assert by_customer(rfm.rfm_features(lines, as_of=later))["a"]["recency"] == 14


def test_join_form_agrees(lines):
    joined = by_customer(rfm.recency_with_sales(lines))
    wide = by_customer(rfm.rfm_wide(lines))
    for customer, row in joined.items():
        assert all(row[name] == wide[customer][name] for name in ("recency", "frequency", "monetary"))


def test_cutoff_row_is_future(lines):
    past, future = churn.split_at_cutoff(lines, 90)
    assert {r.invoice_no for r in past.collect()} == {"C4"}
    assert future.count() == 8
    target = by_customer(churn.churn_target(past, future))
    assert target == {"b": {"customer_id": "b", "churn": 1}}
    assert by_customer(churn.churn_target_at(lines, 90)) == target


def test_frames_match_separate_steps(spark, folder):
    lines = fx.enriched(spark, folder)
    together = churn.training_frames(lines, [90, 180])
    for days in (90, 180):
        past, future = churn.split_at_cutoff(lines, days)
        apart = churn.features_with_target(rfm.rfm_features(past), churn.churn_target(past, future))
        one = together.where(F.col("cutoff_days") == days).drop("cutoff_days")
        assert one.exceptAll(apart).count() == 0 and apart.exceptAll(one).count() == 0


def test_partition_count_does_not_matter(spark, folder):
    wanted = fx.features(spark, folder).collect()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        again = fx.features(spark, folder).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(wanted) == sorted(again)


def test_plan_has_no_expand_or_cartesian(spark, folder):
    lines = fx.enriched(spark, folder)
    plan = rfm.rfm_features(lines)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "CartesianProduct" not in plan and "SinglePartition" not in plan.split("Subquery")[0]


def test_quartiles_of_six(spark):
    rows = spark.createDataFrame(
        [(str(i), i, 1, float(i)) for i in range(1, 7)],
        "customer_id string, recency int, frequency int, monetary double",
    )
    scores = sorted(scoring.quartile_scores(rows).collect())
    assert [r.m_score for r in scores] == [1, 1, 2, 3, 4, 4]
    assert [r.r_score for r in scores] == [4, 4, 3, 2, 1, 1]
    assert [r.f_score for r in scores] == [1, 1, 2, 3, 4, 4]  # equal frequencies go by customer id


def test_equal_edges_raise_when_strict(spark):
    rows = spark.createDataFrame(
        [(str(i), 5, i, float(i)) for i in range(8)],
        "customer_id string, recency int, frequency int, monetary double",
    )
    assert scoring.quartile_scores(rows).count() == 8
    with pytest.raises(Exception, match="quartile edges"):
        scoring.quartile_scores(rows, strict=True).collect()


def test_segments_by_score(spark):
    rows = spark.createDataFrame([("444", 4), ("141", 4), ("411", 1)], "rfm_score string, f_score int")
    usual = [r.segment for r in scoring.with_score_segment(rows).collect()]
    assert usual == ["loyal", "loyal", "at_risk"]
    fixed = [r.segment for r in scoring.with_score_segment(rows, champions_last=True).collect()]
    assert fixed == ["champions", "loyal", "at_risk"]


def test_label_rules(spark):
    rows = spark.createDataFrame(
        [(151, 99, 999), (150, 11, 999), (150, 10, 501), (150, 10, 500)], "r int, f int, v int"
    )
    labels = [r[0] for r in rows.select(profiles.rule_label(F.col("r"), F.col("f"), F.col("v"))).collect()]
    assert labels == [
        "Inactive Customers", "Frequent Buyers", "Occasional High Value Buyers", "Medium Customers",
    ]


def test_unmapped_cluster_is_unknown(spark):
    rows = spark.createDataFrame([(1,), (999,)], "cluster int")
    assert [r.label for r in profiles.label_predictions(rows).orderBy("cluster").collect()] == [
        "Medium Customers", "Unknown",
    ]


@pytest.mark.parametrize("stratify", [None, "churn"])
def test_exact_split(spark, stratify):
    rows = spark.range(1003).select(
        F.col("id").cast("string").alias("customer_id"), (F.col("id") % 3 == 0).cast("int").alias("churn")
    )
    train, test = splits.train_test(splits.exact_split(rows, stratify=stratify))
    assert train.join(test, "customer_id").count() == 0
    assert train.count() + test.count() == 1003
    if stratify:
        assert {r.churn: r["count"] for r in test.groupBy("churn").count().collect()} == {0: 134, 1: 67}
    else:
        assert test.count() == 201
    again = splits.train_test(splits.exact_split(rows.repartition(3), stratify=stratify))[1]
    assert test.exceptAll(again).count() == 0


def test_threshold_split_is_near_the_fraction(spark):
    rows = spark.range(20000).select(F.col("id").cast("string").alias("customer_id"))
    share = splits.threshold_split(rows).agg(F.avg(F.col("is_test").cast("int"))).first()[0]
    assert abs(share - 0.2) < 0.02
