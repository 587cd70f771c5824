import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketlens import constants as C
from basketlens.functions.vectors import cosine
from basketlens.operators import campaign, similarity
from checks import campaigns, fixtures as fx

CATALOGUE = "stock_code string, description string, unit_price double, embedding array<double>"


@pytest.fixture(scope="module")
def catalogue(spark):
    return spark.createDataFrame(
        [
            ("1", "Lamp", 2.0, [1.0, 0.0]),
            ("2", "LAMP shade", 3.5, [0.9, 0.1]),
            ("3", "Rug", 9.25, [0.0, 1.0]),
            ("4", "Nothing", 1.0, [0.0, 0.0]),
        ],
        CATALOGUE,
    )


def test_top_k_excludes_the_same_text_and_puts_zero_vectors_last(spark, catalogue):
    asked = spark.createDataFrame([(7, "LAMP", [2.0, 0.0])], "query_id long, query_text string, embedding array<double>")
    rows = similarity.similar_products(asked, catalogue, 3).orderBy("rank").collect()
    assert [r.description for r in rows] == ["LAMP shade", "Rug", "Nothing"]
    assert rows[2].similarity is None and abs(rows[0].similarity - 0.9 / np.hypot(0.9, 0.1)) < 1e-12


def test_null_text_matches_no_description(spark, catalogue):
    asked = spark.createDataFrame([(7, None, [1.0, 0.0])], "query_id long, query_text string, embedding array<double>")
    assert similarity.similar_products(asked, catalogue, 1).first().description == "Lamp"


def test_cosine_expression(spark):
    rows = spark.createDataFrame([([1.0, 2.0], [2.0, 4.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    found = [r[0] for r in rows.select(cosine(F.col("a"), F.col("b"))).collect()]
    assert abs(found[0] - 1) < 1e-12 and found[1] is None


@pytest.mark.parametrize("product_rows", [1000, 16])
def test_similarity_against_brute_force(spark, product_rows, monkeypatch):
    """One block of products, and several."""
    monkeypatch.setattr(similarity, "PRODUCT_ROWS", product_rows)
    rng = np.random.default_rng(5)
    products, queries = rng.normal(size=(70, 8)), rng.normal(size=(45, 8))
    products[10] = products[3]  # a tie
    names = [f"product {i:02d}" for i in range(70)]
    offered = spark.createDataFrame(
        [(str(i), names[i], float(i), products[i].tolist()) for i in range(70)], CATALOGUE
    )
    texts = [names[i].upper() if i % 2 else None for i in range(45)]
    asked = spark.createDataFrame(
        [(f"q{i}", texts[i], queries[i].tolist()) for i in range(45)],
        "query_id string, query_text string, embedding array<double>",
    )
    found = similarity.similar_products(asked, offered, 4).toPandas()
    for i in range(45):
        scores = products @ queries[i] / np.linalg.norm(products, axis=1) / np.linalg.norm(queries[i])
        order = sorted(
            (j for j in range(70) if texts[i] is None or names[j].upper() != texts[i]),
            key=lambda j: (-round(scores[j], 12), names[j]),
        )[:4]
        mine = found[found.query_id == f"q{i}"].sort_values("rank")
        assert mine.description.tolist() == [names[j] for j in order]
        assert np.allclose(mine.similarity, scores[order])


def test_embedding_in_batches(spark):
    sizes = spark.range(250, numPartitions=1).select(F.col("id").cast("string").alias("description"))

    def embed(texts):
        return [[float(len(texts))] for _ in texts]

    counts = similarity.embed_with(sizes, embed, batch=100).groupBy(F.col("embedding")[0].alias("n")).count()
    assert {r.n: r["count"] for r in counts.collect()} == {100.0: 200, 50.0: 50}


def profile(**changes):
    return C.DEFAULT_PROFILE | changes


def profiles_frame(spark, rows):
    frame = pd.DataFrame([{"customer_id": key, **value} for key, value in rows.items()])
    return spark.createDataFrame(frame[["customer_id", *C.DEFAULT_PROFILE]])


def test_offer_rules(spark):
    rows = profiles_frame(
        spark,
        {
            "churned": profile(is_churn=1),
            "slowing": profile(spending_velocity=0.79),
            "edge": profile(spending_velocity=0.8, cancellation_rate=0.15),
            "cancelling": profile(cancellation_rate=0.16),
        },
    )
    found = {r.customer_id: r for r in campaign.with_offers(rows).collect()}
    assert found["churned"].offer_codes == ["WINBACK20"] and found["slowing"].offer_codes == ["WINBACK20"]
    assert found["edge"].offer_codes == ["LOYALTYVIP"] and found["edge"].apology == ""
    assert found["cancelling"].offer_codes == ["LOYALTYVIP", "SHIPSAFE"]
    assert found["cancelling"].apology.startswith("We noticed")


def test_recommendations_and_text(spark, catalogue):
    rows = profiles_frame(
        spark, {"1": profile(last_purchased="Lamp", preferred_shopping_hour=9), "2": profile()}
    )
    two_left = catalogue.where("stock_code in ('1', '2', '3')")
    recommended = campaign.recommend(rows, two_left, catalogue)
    found = {r.customer_id: r for r in recommended.transform(campaign.with_offers).transform(campaign.with_campaign_text).collect()}
    assert [i.description for i in found["1"]["items"]] == ["LAMP shade", "Rug"]  # fewer than three
    assert [i.stock_code for i in found["2"]["items"]] == ["85123A", "22423", "47566"]
    text = found["1"].campaign_draft
    assert "Dear Customer 1," in text and "\n1.  **LAMP shade** — $3.50\n2.  **Rug** — $9.25\n\n" in text
    assert text.endswith("[Schedule Delivery for 9:00]\n") and "{" not in text


def test_profile_fallbacks(spark):
    features = spark.createDataFrame(
        [("1", 91, 1, 10.0, 1.0, 0.0, 9), ("2", 90, 1, 10.0, 1.0, 0.0, 9), ("3", 5, 20, 10.0, 1.0, 0.0, 9)],
        "customer_id string, recency int, frequency int, avg_order_value double, spending_velocity double, "
        "cancellation_rate double, preferred_shopping_hour int",
    )
    sales = spark.createDataFrame(
        [
            ("1", "a", "x", "Old", dt.datetime(2024, 1, 1)),
            ("2", "a", "y", "New", dt.datetime(2024, 1, 2)),
            ("3", "a", "z", None, dt.datetime(2024, 1, 3)),
        ],
        "invoice_no string, stock_code string, customer_id string, description string, invoice_date timestamp_ntz",
    ).withColumn("customer_id", F.lit("1"))
    log = spark.createDataFrame(
        [("3", 0.9, 1, dt.datetime(2024, 1, 1), "r1"), ("3", 0.2, 0, dt.datetime(2024, 1, 2), "r2")],
        "customer_id string, churn_probability double, is_churn int, created_at timestamp_ntz, request_id string",
    )
    found = {r.customer_id: r for r in campaign.customer_profiles(features, sales, log).collect()}
    assert (found["1"].last_purchased, found["2"].last_purchased) == ("New", "Unknown Product")
    assert (found["1"].churn_probability, found["1"].is_churn) == (0.5, 1)
    assert (found["2"].churn_probability, found["2"].is_churn) == (0.1, 0)
    assert (found["3"].churn_probability, found["3"].is_churn) == (0.2, 0)
    assert found["3"].segment == C.FREQUENT
    ids = spark.createDataFrame([("1",), ("nobody",)], "customer_id string")
    asked = {r.customer_id: r for r in campaign.profiles_or_default(ids, campaign.customer_profiles(features, sales, log)).collect()}
    assert asked["nobody"].last_purchased == "RED RETROSPOT WRAP" and asked["nobody"].churn_probability == 0.15


def test_last_products_outside_the_catalogue_are_compared(spark, catalogue):
    rows = profiles_frame(spark, {"1": profile(last_purchased="Lamp"), "2": profile(last_purchased="never seen")})
    offered = catalogue.where("stock_code in ('2', '3')")
    found = {r.customer_id: r["items"] for r in campaign.recommend(rows, offered, catalogue).collect()}
    assert [i.description for i in found["1"]] == ["LAMP shade", "Rug"]
    assert [i.stock_code for i in found["2"]] == ["85123A", "22423", "47566"]


def test_campaigns_join_the_order_tables_once(spark, folder, monkeypatch):
    made, view = [], fx.retail_transactions
    monkeypatch.setattr(fx, "retail_transactions", lambda *where: made.append(where) or view(*where))
    drafts = campaigns._campaigns(spark, folder)
    assert len(made) == 1
    assert "lineitem" not in "".join(drafts.inputFiles())
