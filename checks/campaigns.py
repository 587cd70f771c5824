"""Catalogue, similarity, customer profiles and campaigns."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from basketlens.constants import LOG_SCALED_FEATURES, SEGMENTATION_FEATURES
from basketlens.operators import campaign, profiles, similarity
from basketlens.sources import star
from basketlens.plans import jobs, registry, segmentation
from basketlens.plans.lloyd import NearestCentre
from basketlens.plans.scaling import fit_scaling, scale
from basketlens.session import working_path
import checks.models  # noqa: F401  defines scaled and centres
import checks.reporting  # noqa: F401  defines last_product and last_score
from checks import fixtures as fx
from checks.registry import query
from checks.sql import define, even, label, sql

_DEFAULT_ROWS = """(1, '85123A', 'WHITE HANGING HEART T-LIGHT HOLDER', 2.55::DOUBLE, 0.85::DOUBLE),
  (2, '22423', 'REGENCY CAKESTAND 3 TIER', 12.75::DOUBLE, 0.72::DOUBLE), (3, '47566', 'PARTY BUNTING', 4.95::DOUBLE, 0.68::DOUBLE)"""
_STANDARD = {
    "recency": "30",
    "frequency": "5",
    "avg_order_value": "100.0::DOUBLE",
    "spending_velocity": "1.0::DOUBLE",
    "cancellation_rate": "0.0::DOUBLE",
    "preferred_shopping_hour": "12",
    "segment": "'Medium Customers'",
    "last_purchased": "'RED RETROSPOT WRAP'",
    "churn_probability": "0.15::DOUBLE",
    "is_churn": "0",
}
PROFILE = "customer_id, " + ", ".join(_STANDARD)


define(
    "profiles",
    f"""SELECT customer_id, recency, frequency, avg_order_value, spending_velocity, cancellation_rate,
  preferred_shopping_hour, {label()} AS segment, coalesce(last_purchased, 'Unknown Product') AS last_purchased,
  coalesce(churn_probability, CASE WHEN recency > 90 THEN 0.5 ELSE 0.1 END::DOUBLE) AS churn_probability,
  coalesce(is_churn, CASE WHEN recency > 90 THEN 1 ELSE 0 END) AS is_churn
FROM rfm LEFT JOIN last_product USING (customer_id) LEFT JOIN last_score USING (customer_id)""",
    "rfm",
    "last_product",
    "last_score",
)
define(
    "asked",
    "SELECT CAST(c_custkey AS VARCHAR) AS customer_id FROM customer UNION ALL SELECT 'visitor-' || n_name FROM nation",
)
define(
    "asked_profiles",
    "SELECT asked.customer_id, "
    + ", ".join(
        f"CASE WHEN p.customer_id IS NULL THEN {value} ELSE p.{name} END AS {name}"
        for name, value in _STANDARD.items()
    )
    + " FROM asked LEFT JOIN profiles p ON asked.customer_id = p.customer_id",
    "asked",
    "profiles",
)
define(
    "product_matches",
    """SELECT * FROM (SELECT q.description AS query_id, c.*, row_number() OVER (PARTITION BY q.description
    ORDER BY c.score DESC, c.description) AS place
  FROM vectors q,
  LATERAL (SELECT stock_code, description, unit_price, list_cosine_similarity(embedding, q.embedding) AS score
    FROM catalogue WHERE lower(description) <> lower(q.description)) c) WHERE place <= 3""",
    "catalogue",
    "vectors",
)
define(
    "recommended",
    f"""SELECT p.customer_id, coalesce(m.place, d.place) AS place,
  CASE WHEN m.query_id IS NULL THEN d.stock_code ELSE m.stock_code END AS stock_code,
  CASE WHEN m.query_id IS NULL THEN d.name ELSE m.description END AS description,
  CASE WHEN m.query_id IS NULL THEN d.price ELSE m.unit_price END AS unit_price,
  CASE WHEN m.query_id IS NULL THEN d.score ELSE m.score END AS similarity
FROM asked_profiles p CROSS JOIN (VALUES {_DEFAULT_ROWS}) AS d(place, stock_code, name, price, score)
LEFT JOIN product_matches m ON m.query_id = p.last_purchased AND m.place = d.place""",
    "asked_profiles",
    "product_matches",
)


def _asked(spark, folder):
    known = star.table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("customer_id"))
    visitors = star.table(spark, folder, "nation").select(
        F.concat(F.lit("visitor-"), "n_name").alias("customer_id")
    )
    return known.unionByName(visitors)


def _profiles(spark, folder):
    features, log = fx.features_and_churn_log(spark, folder)
    return campaign.customer_profiles(features, fx.transactions(spark, folder), log)


def _asked_profiles(spark, folder):
    return campaign.profiles_or_default(_asked(spark, folder), _profiles(spark, folder))


@query("c8_customer_profile", sql(f"SELECT {PROFILE} FROM profiles", "profiles"))
def c8(spark, folder):
    return _profiles(spark, folder)


@query(
    "c9_vector_scores",
    sql(
        """SELECT vec_id AS query_id, count(*) AS compared, round(max(score), 6) AS best, round(min(score), 6) AS worst
FROM (SELECT e.vec_id, list_cosine_similarity(c.embedding, CAST(e.embedding AS DOUBLE[])) AS score
  FROM embeddings e, catalogue c) GROUP BY vec_id""",
        "catalogue",
    ),
)
def c9(spark, folder):
    """Every vector against every product of the bounded catalogue."""
    scored = similarity.similarity_range(_vectors(spark, folder), fx.catalogue_rows(spark, folder))
    return scored.select(
        "query_id", "compared", F.round("best", 6).alias("best"), F.round("worst", 6).alias("worst")
    )


def _vectors(spark, folder):
    return star.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.lit(None).cast("string").alias("query_text"), "embedding"
    )


@query("j1_product_catalogue", sql("SELECT * FROM top_products", "top_products"))
def j1(spark, folder):
    return similarity.product_catalogue(fx.transactions(spark, folder))


@query(
    "j2_embed_by_terms",
    sql("SELECT description, 64 AS dimensions, 1.0::DOUBLE AS length FROM top_products", "top_products"),
)
def j2(spark, folder):
    products = similarity.product_catalogue(fx.transactions(spark, folder))
    return similarity.embed_by_terms(products).select(
        "description",
        F.size("embedding").alias("dimensions"),
        F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x), 6).alias("length"),
    )


@query(
    "j2_embed_with_function",
    sql(
        """SELECT description, CAST(length(description) AS DOUBLE) AS letters,
  CAST(length(description) - length(replace(description, 'e', '')) AS DOUBLE) AS letter_e FROM top_products""",
        "top_products",
    ),
)
def j2_function(spark, folder):
    products = similarity.product_catalogue(fx.transactions(spark, folder))

    def letters(texts):
        return [[float(len(text)), float(text.count("e"))] for text in texts]

    return similarity.embed_with(products, letters).select(
        "description", F.col("embedding")[0].alias("letters"), F.col("embedding")[1].alias("letter_e")
    )


@query(
    "j3_similar_topk",
    sql(
        """SELECT query_id, CAST(place AS INTEGER) AS rank, stock_code, description, unit_price, round(score, 6) AS similarity
FROM (SELECT e.vec_id AS query_id, c.*, row_number() OVER (PARTITION BY e.vec_id ORDER BY score DESC, description) AS place
  FROM embeddings e, LATERAL (SELECT stock_code, description, unit_price,
    list_cosine_similarity(embedding, CAST(e.embedding AS DOUBLE[])) AS score FROM catalogue) c) WHERE place <= 3""",
        "catalogue",
    ),
)
def j3(spark, folder):
    matches = similarity.similar_products(_vectors(spark, folder), fx.catalogue_rows(spark, folder))
    return matches.withColumn("similarity", F.round("similarity", 6))


@query(
    "j3_similar_to_product",
    sql(
        """SELECT query_id, CAST(place AS INTEGER) AS rank, stock_code, description, unit_price, round(score, 6) AS similarity
FROM product_matches""",
        "product_matches",
    ),
)
def j3_products(spark, folder):
    vectors = fx.product_vectors(spark, folder)
    catalogue = fx.catalogue(spark, folder, vectors)
    asked = vectors.select(
        F.col("description").alias("query_id"), F.col("description").alias("query_text"), "embedding"
    )
    return similarity.similar_products(asked, catalogue).withColumn("similarity", F.round("similarity", 6))


@query("j4_customer_profile", sql(f"SELECT {PROFILE} FROM profiles", "profiles"))
def j4(spark, folder):
    """Profiles whose segment comes with the features, here by the same rules the SQL has."""
    features, log = fx.features_and_churn_log(spark, folder)
    labelled = features.withColumn(
        "segment", profiles.rule_label(F.col("recency"), F.col("frequency"), F.col("avg_order_value"))
    )
    return campaign.customer_profiles(labelled, fx.transactions(spark, folder), log)


define(
    "model_clusters",
    f"""SELECT customer_id, cluster FROM (SELECT s.customer_id, c.cluster, row_number() OVER (PARTITION BY s.customer_id
  ORDER BY {' + '.join(f'(s.{c} - c.{c}) * (s.{c} - c.{c})' for c in SEGMENTATION_FEATURES)}, c.cluster) AS place
FROM scaled s, centres c) WHERE place = 1""",
    "scaled",
    "centres",
)
define(
    "model_profile",
    f"""SELECT cluster, {even('avg(recency)', 2)} AS recency, {even('avg(frequency)', 2)} AS frequency,
  {even('avg(avg_order_value)', 2)} AS avg_order_value FROM rfm JOIN model_clusters USING (customer_id) GROUP BY cluster""",
    "rfm",
    "model_clusters",
)


@query(
    "j4_profile_by_model",
    sql(
        f"""SELECT {PROFILE.replace('segment', 'model_segment AS segment')} FROM profiles JOIN (
  SELECT customer_id, {label()} AS model_segment FROM model_clusters JOIN model_profile USING (cluster)) USING (customer_id)""",
        "profiles",
        "model_clusters",
        "model_profile",
    ),
)
def j4_by_model(spark, folder):
    """Profiles with the segment of stored models: centres at the rule clusters' means, named by their profile."""
    features, log = fx.features_and_churn_log(spark, folder)
    stages = fit_scaling(features, SEGMENTATION_FEATURES, LOG_SCALED_FEATURES)
    names = [f"_scaled_{name}" for name in SEGMENTATION_FEATURES]
    means = scale(profiles.rule_cluster(features), stages).groupBy("cluster").agg(*[F.avg(n).alias(n) for n in names])
    centres = [row[1:] for row in means.orderBy("cluster").collect()]
    model = PipelineModel(stages=[*stages, NearestCentre(centres)])
    _, profile = profiles.segment_customers(segmentation.assign_clusters(features, model))
    output = working_path(spark, "models")
    parts = {jobs.SEGMENTATION: registry.saved(model), jobs.PROFILE: registry.stored(profile)}
    registry.publish(spark, output, 1, parts, 0.0)
    named = jobs.with_model_segment(spark, features, output)
    return campaign.customer_profiles(named, fx.transactions(spark, folder), log)


@query("j5_profile_or_default", sql(f"SELECT {PROFILE} FROM asked_profiles", "asked_profiles"))
def j5(spark, folder):
    return _asked_profiles(spark, folder)


@query(
    "j6_recommendations",
    sql(
        """SELECT customer_id, CAST(place AS INTEGER) AS rank, stock_code, description, unit_price,
  round(similarity, 6) AS similarity FROM recommended""",
        "recommended",
    ),
)
def j6(spark, folder):
    vectors = fx.product_vectors(spark, folder)
    recommended = campaign.recommend(_asked_profiles(spark, folder), fx.catalogue(spark, folder, vectors), vectors)
    return campaign.recommendation_rows(recommended).withColumn("similarity", F.round("similarity", 6))


_APOLOGY = (
    "We noticed some of your recent orders were cancelled. We'd love to make things right "
    "and guarantee a smooth checkout next time!"
)
_CAMPAIGN = """# Subject: Special Offer: Inspired by your recent purchase!

Dear Customer {customer_id},

We hope you are having a wonderful day! {apology} We noticed you recently purchased the **"{last_purchased}"** and loved it. 

Based on your taste, we thought you might enjoy these top recommendations from our collection:
{recommendations}

Because you are a valued customer, we'd like to offer you a special benefit: **{offer}**!

Enter the code at checkout. We hope to see you again soon!

Best regards,  
*Your E-Commerce Marketing Team*

**Delivery Meta:** [Schedule Delivery for {hour}:00]
"""
_WINBACK = "(is_churn = 1 OR spending_velocity < 0.8)"
define(
    "offers",
    f"""SELECT *, CASE WHEN {_WINBACK} THEN '20% off with code WINBACK20' ELSE 'early access with code LOYALTYVIP' END AS offer,
  CASE WHEN cancellation_rate > 0.15 THEN $${_APOLOGY}$$ ELSE '' END AS apology,
  CASE WHEN {_WINBACK} THEN 'WINBACK20' ELSE 'LOYALTYVIP' END
    || CASE WHEN cancellation_rate > 0.15 THEN ',SHIPSAFE' ELSE '' END AS offer_codes,
  preferred_shopping_hour AS send_hour FROM asked_profiles""",
    "asked_profiles",
)


@query("j7_offers", sql("SELECT customer_id, offer, apology, offer_codes, send_hour FROM offers", "offers"))
def j7(spark, folder):
    return campaign.with_offers(_asked_profiles(spark, folder)).select(
        "customer_id", "offer", "apology", F.array_join("offer_codes", ",").alias("offer_codes"), "send_hour"
    )


def _draft() -> str:
    text = _CAMPAIGN
    fields = {
        "customer_id": "o.customer_id",
        "apology": "apology",
        "last_purchased": "last_purchased",
        "recommendations": "listing",
        "offer": "offer",
        "hour": "CAST(send_hour AS VARCHAR)",
    }
    for name, field in fields.items():
        text = text.replace("{" + name + "}", f"$$ || {field} || $$")
    return f"$${text}$$"


define(
    "drafts",
    f"""SELECT o.customer_id, segment, last_purchased, offer_codes, send_hour, {_draft()} AS campaign_draft
FROM offers o JOIN (SELECT customer_id, string_agg(place || '.  **' || description || '** — $'
  || printf('%.2f', unit_price), chr(10) ORDER BY place) AS listing FROM recommended GROUP BY customer_id) r
ON o.customer_id = r.customer_id""",
    "offers",
    "recommended",
)


def _campaigns(spark, folder):
    bought = fx.stored_transactions(spark, folder)
    features, log = fx.features_and_churn_log(spark, folder, bought)
    vectors = fx.product_vectors(spark, folder, bought)
    catalogue = fx.catalogue(spark, folder, vectors, bought)
    return campaign.campaigns(_asked(spark, folder), features, bought, log, catalogue, vectors)


@query("j8_campaign_text", sql("SELECT customer_id, campaign_draft FROM drafts", "drafts"))
def j8(spark, folder):
    return _campaigns(spark, folder).select("customer_id", "campaign_draft")


@query(
    "j9_campaigns",
    sql(
        """SELECT customer_id, segment, last_purchased, offer_codes, send_hour, listing,
  CAST(length(campaign_draft) AS INTEGER) AS letters FROM drafts JOIN (
    SELECT customer_id, string_agg(stock_code, ',' ORDER BY place) AS listing FROM recommended GROUP BY customer_id)
  USING (customer_id)""",
        "drafts",
        "recommended",
    ),
)
def j9(spark, folder):
    return _campaigns(spark, folder).select(
        "customer_id",
        "segment",
        "last_purchased",
        F.array_join("offer_codes", ",").alias("offer_codes"),
        "send_hour",
        F.array_join("items.stock_code", ",").alias("listing"),
        F.length("campaign_draft").alias("letters"),
    )
