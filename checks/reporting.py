"""Features, profiles, reports, scores and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketlens import constants as C
from basketlens.operators import campaign, churn, profiles, ranking, reports, rfm, scoring
from basketlens.operators.similarity import product_catalogue
from basketlens.sources import star
from checks import fixtures as fx
from checks.registry import query
from checks.sql import FEATURES, define, even, sql
from checks.transactions import CHURN_LOG_COLUMNS, LOG_COLUMNS

# --- D: aggregations -------------------------------------------------------------


@query("d1_recency", sql("SELECT customer_id, recency FROM wide", "wide"))
def d1(spark, folder):
    return rfm.recency(fx.transactions(spark, folder))


@query(
    "d2_d3_sales_metrics",
    sql(
        "SELECT customer_id, CAST(frequency AS BIGINT) AS frequency, monetary FROM wide WHERE frequency > 0",
        "wide",
    ),
)
def d2(spark, folder):
    return rfm.sales_metrics(fx.enriched(spark, folder))


_WIDE_PARTS = {
    "d4_avg_order_value": ["avg_order_value"],
    "d5_trailing_sums": ["monetary_30", "monetary_90"],
    "d6_spending_velocity": ["spending_velocity"],
    "d7_cancelled_orders": ["cancelled_orders"],
    "d8_total_orders": ["total_orders"],
    "d9_cancellation_rate": ["cancellation_rate"],
    "d10_preferred_hour": ["preferred_shopping_hour"],
}


def _wide_part(columns):
    return lambda spark, folder: fx.features_wide(spark, folder).select("customer_id", *columns)


for _name, _columns in _WIDE_PARTS.items():
    query(_name, sql(f"SELECT customer_id, {', '.join(_columns)} FROM wide", "wide"))(_wide_part(_columns))


@query("d11_rfm_features", sql(f"SELECT customer_id, {FEATURES} FROM rfm", "rfm"))
def d11(spark, folder):
    return fx.features(spark, folder)


@query(
    "d11_rfm_wide",
    sql(
        f"""SELECT customer_id, {FEATURES}, monetary, monetary_30, monetary_90, cancelled_orders, total_orders
FROM wide""",
        "wide",
    ),
)
def d11_wide(spark, folder):
    return fx.features_wide(spark, folder)


@query("d12_churn_target", sql("SELECT customer_id, churn FROM targets WHERE cutoff_days = 90", "targets"))
def d12(spark, folder):
    return churn.churn_target_at(fx.transactions(spark, folder))


@query(
    "d13_churn_shares",
    sql(
        """SELECT churn, count(*) AS customers, count(*) / sum(count(*)) OVER () AS share
FROM targets WHERE cutoff_days = 90 GROUP BY churn""",
        "targets",
    ),
)
def d13(spark, folder):
    return reports.churn_shares(churn.churn_target_at(fx.transactions(spark, folder)))


@query("d14_cluster_profile", sql("SELECT * FROM profile", "profile"))
def d14(spark, folder):
    return profiles.cluster_profile(profiles.rule_cluster(fx.features(spark, folder)))


@query("d15_cluster_sizes", sql("SELECT cluster, count(*) AS customers FROM clustered GROUP BY cluster", "clustered"))
def d15(spark, folder):
    return profiles.cluster_sizes(profiles.rule_cluster(fx.features(spark, folder)))


@query("d16_labelled_profile", sql("SELECT * FROM labelled", "labelled"))
def d16(spark, folder):
    return profiles.label_profile(profiles.cluster_profile(profiles.rule_cluster(fx.features(spark, folder))))


@query(
    "d17_customers_with_segment",
    sql(
        f"SELECT customer_id, {FEATURES}, cluster, segment FROM clustered JOIN labelled USING (cluster)",
        "clustered",
        "labelled",
    )
    .replace("FROM clustered JOIN labelled USING (cluster)", "FROM clustered JOIN (SELECT cluster, segment FROM labelled) USING (cluster)"),
)
def d17(spark, folder):
    return profiles.segment_customers(profiles.rule_cluster(fx.features(spark, folder)))[0]


@query("d18_product_rollup", sql("SELECT * FROM products", "products"))
def d18(spark, folder):
    return reports.product_rollup(fx.transactions(spark, folder))


@query(
    "d19_total_predictions",
    sql(
        """SELECT (SELECT count(*) FROM predictions) AS predictions,
  (SELECT count(*) FROM churn_predictions) AS churn_predictions""",
        "predictions",
        "churn_predictions",
    ),
)
def d19(spark, folder):
    total = reports.total_rows(fx.churn_log(spark, folder), "churn_predictions").scalar()
    return reports.total_rows(fx.prediction_log(spark, folder), "predictions").withColumn(
        "churn_predictions", total
    )


@query(
    "d20_average_response_time",
    sql(
        "SELECT coalesce(CAST(trunc(avg(response_time_ms)) AS INTEGER), 0) AS avg_response_time FROM predictions",
        "predictions",
    ),
)
def d20(spark, folder):
    return reports.average_response_time(fx.prediction_log(spark, folder))


@query(
    "d21_average_churn_probability",
    sql(
        f"SELECT {even('coalesce(avg(churn_probability), 0.0)', 9)} AS avg_churn_probability FROM churn_predictions",
        "churn_predictions",
    ),
)
def d21(spark, folder):
    return reports.rounded(
        reports.average_churn_probability(fx.churn_log(spark, folder)), 9, "avg_churn_probability"
    )


@query(
    "d22_predictions_by_version",
    sql("SELECT model_version, count(*) AS predictions FROM predictions GROUP BY model_version", "predictions"),
)
def d22(spark, folder):
    return reports.predictions_by_version(fx.prediction_log(spark, folder))


@query(
    "d23_segment_distribution",
    sql(
        """SELECT label, count(*) AS "count", count(*) / sum(count(*)) OVER () AS share
FROM predictions GROUP BY label""",
        "predictions",
    ),
)
def d23(spark, folder):
    return reports.segment_distribution(fx.prediction_log(spark, folder))


@query(
    "d24_revenue_by_country",
    sql(
        """SELECT country, sum(order_value) AS revenue FROM lines WHERE customer_id IS NOT NULL AND quantity > 0
GROUP BY country ORDER BY revenue DESC, country LIMIT 10""",
        "lines",
    ),
)
def d24(spark, folder):
    return reports.revenue_by_country(_sales(spark, folder))


def _sales(spark, folder):
    return fx.enriched(spark, folder).where("customer_id is not null and quantity > 0")


@query(
    "d25_revenue_by_month",
    sql(
        """SELECT invoice_month, sum(order_value) AS revenue FROM lines
WHERE customer_id IS NOT NULL AND quantity > 0 GROUP BY invoice_month""",
        "lines",
    ),
)
def d25(spark, folder):
    return reports.revenue_by_month(_sales(spark, folder))


@query(
    "d26_feature_means",
    sql(
        "SELECT churn, "
        + ", ".join(f"{even(f'avg({c})', 6)} AS mean_{c}" for c in C.CHURN_FEATURES)
        + " FROM training GROUP BY churn",
        "training",
    ),
)
def d26(spark, folder):
    means = reports.feature_means(fx.churn_training_frame(spark, folder), C.CHURN_FEATURES)
    return reports.rounded(means, 6, *[f"mean_{c}" for c in C.CHURN_FEATURES])


_DESCRIBED = [*C.CHURN_FEATURES, "monetary"]


@query(
    "d27_describe",
    sql(
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS feature, count({c}) AS "count", {even(f'avg({c})', 6)} AS mean,
  {even(f'stddev_samp({c})', 6)} AS std, min({c})::DOUBLE AS "min", {even(f'quantile_cont({c}::DOUBLE, 0.25)', 6)} AS q25,
  {even(f'quantile_cont({c}::DOUBLE, 0.5)', 6)} AS q50, {even(f'quantile_cont({c}::DOUBLE, 0.75)', 6)} AS q75,
  max({c})::DOUBLE AS "max" FROM wide"""
            for c in _DESCRIBED
        ),
        "wide",
    ),
)
def d27(spark, folder):
    described = reports.describe_features(fx.stored_features(spark, folder), _DESCRIBED)
    return reports.rounded(described, 6, "mean", "std", "q25", "q50", "q75")


@query(
    "d28_spend_histogram",
    sql(
        f"""SELECT CAST(bin AS INTEGER) AS bin, {even('low + bin * width', 6)} AS lower,
  {even('low + (bin + 1) * width', 6)} AS upper, coalesce(n, 0) AS "count"
FROM (SELECT min(monetary) AS low, (max(monetary) - min(monetary)) / 50 AS width FROM wide)
CROSS JOIN range(50) AS r(bin)
LEFT JOIN (SELECT least(49, floor((monetary - low) / width)) AS bin, count(*) AS n FROM wide,
  (SELECT min(monetary) AS low, (max(monetary) - min(monetary)) / 50 AS width FROM wide) GROUP BY 1) USING (bin)""",
        "wide",
    ),
)
def d28(spark, folder):
    return reports.rounded(reports.histogram(fx.stored_features(spark, folder), "monetary"), 6, "lower", "upper")


@query(
    "d29_box_stats",
    sql(
        "\nUNION ALL ".join(
            f"""SELECT churn, '{c}' AS feature, {even('q1', 6)} AS q1, {even('q2', 6)} AS median, {even('q3', 6)} AS q3,
  min(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_low,
  max(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_high,
  count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
FROM (SELECT churn, {c}::DOUBLE AS v FROM training) JOIN (SELECT churn, quantile_cont({c}::DOUBLE, 0.25) AS q1,
  quantile_cont({c}::DOUBLE, 0.5) AS q2, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM training GROUP BY churn) USING (churn)
GROUP BY churn, q1, q2, q3"""
            for c in C.SEGMENTATION_FEATURES
        ),
        "training",
    ),
)
def d29(spark, folder):
    stats = reports.box_stats(fx.stored_training_frame(spark, folder), "churn", C.SEGMENTATION_FEATURES)
    return reports.rounded(stats, 6, "q1", "median", "q3")


@query(
    "d30_cleaning_counts",
    sql(
        """SELECT count(*) AS loaded, count(customer_id) AS with_customer,
  count(*) FILTER (customer_id IS NOT NULL AND quantity > 0) AS clean FROM tx""",
        "tx",
    ),
)
def d30(spark, folder):
    return reports.cleaning_counts(fx.transactions(spark, folder))


@query(
    "d31_top_customers",
    sql(
        """SELECT customer_id, monetary AS total_spend FROM wide WHERE frequency > 0
ORDER BY total_spend DESC, customer_id LIMIT 10""",
        "wide",
    ),
)
def d31(spark, folder):
    return reports.top_customers(fx.enriched(spark, folder))


# --- E: ranking, F: top-k -----------------------------------------------------------

define(
    "ranked",
    "SELECT *, row_number() OVER (ORDER BY frequency, customer_id) AS frequency_rank FROM wide",
    "wide",
)
define(
    "edges",
    """SELECT quantile_cont(recency::DOUBLE, [0.25, 0.5, 0.75]) AS r, quantile_cont(monetary, [0.25, 0.5, 0.75]) AS m,
  count(*) AS n FROM wide""",
    "wide",
)


def _bin(value: str, edges: list[str]) -> str:
    return "1" + "".join(f" + CAST({value} > {edge} AS INTEGER)" for edge in edges)


define(
    "scores",
    f"""SELECT customer_id, recency, frequency, monetary, frequency_rank,
  5 - ({_bin('recency', ['r[1]', 'r[2]', 'r[3]'])}) AS r_score,
  {_bin('frequency_rank', [f'1 + (n - 1) * {p}::DOUBLE' for p in (0.25, 0.5, 0.75)])} AS f_score,
  {_bin('monetary', ['m[1]', 'm[2]', 'm[3]'])} AS m_score FROM ranked, edges""",
    "ranked",
    "edges",
)
_SCORES = "customer_id, recency, frequency, monetary, frequency_rank, r_score, f_score, m_score"
_TEXT = "CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR)"


@query("e1_frequency_rank", sql("SELECT customer_id, frequency, frequency_rank FROM ranked", "ranked"))
def e1(spark, folder):
    return scoring.frequency_rank(fx.stored_features(spark, folder)).select(
        "customer_id", "frequency", "frequency_rank"
    )


@query("e2_rfm_quartiles", sql(f"SELECT {_SCORES} FROM scores", "scores"))
def e2(spark, folder):
    return scoring.quartile_scores(fx.stored_features(spark, folder))


@query("e3_rfm_score", sql(f"SELECT {_SCORES}, {_TEXT} AS rfm_score FROM scores", "scores"))
def e3(spark, folder):
    return scoring.with_rfm_score(scoring.quartile_scores(fx.stored_features(spark, folder)))


@query(
    "e4_score_segments",
    sql(
        f"""SELECT customer_id, {_TEXT} AS rfm_score, CASE WHEN f_score >= 3 THEN 'loyal' ELSE 'at_risk' END AS segment,
  CASE WHEN {_TEXT} = '444' THEN 'champions' WHEN f_score >= 3 THEN 'loyal' ELSE 'at_risk' END AS segment_champions_last
FROM scores""",
        "scores",
    ),
)
def e4(spark, folder):
    scored = scoring.with_rfm_score(scoring.quartile_scores(fx.stored_features(spark, folder)))
    both = scoring.with_score_segment(scored, champions_last=True).withColumnRenamed(
        "segment", "segment_champions_last"
    )
    return scoring.with_score_segment(both).select(
        "customer_id", "rfm_score", "segment", "segment_champions_last"
    )


define(
    "last_product",
    """SELECT customer_id, description AS last_purchased FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
  ORDER BY invoice_date DESC, invoice_no DESC, stock_code DESC) AS place FROM tx
  WHERE description IS NOT NULL AND customer_id IS NOT NULL) WHERE place = 1""",
    "tx",
)
define(
    "last_score",
    """SELECT customer_id, churn_probability, is_churn FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
  ORDER BY created_at DESC, request_id DESC) AS place FROM churn_predictions) WHERE place = 1""",
    "churn_predictions",
)


@query("e5_latest_product", sql("SELECT * FROM last_product", "last_product"))
def e5(spark, folder):
    return campaign.latest_product(fx.transactions(spark, folder))


@query("e6_latest_churn_score", sql("SELECT * FROM last_score", "last_score"))
def e6(spark, folder):
    return campaign.latest_churn_score(fx.churn_log(spark, folder))


@query(
    "f1_latest_predictions",
    sql(f"SELECT {LOG_COLUMNS} FROM predictions ORDER BY created_at DESC, request_id LIMIT 10", "predictions"),
)
def f1(spark, folder):
    return reports.latest_rows(fx.prediction_log(spark, folder))


@query(
    "f2_latest_churn_predictions",
    sql(
        f"SELECT {CHURN_LOG_COLUMNS} FROM churn_predictions ORDER BY created_at DESC, request_id LIMIT 10",
        "churn_predictions",
    ),
)
def f2(spark, folder):
    return reports.latest_rows(fx.churn_log(spark, folder))


@query("f3_top_products", sql("SELECT * FROM top_products", "top_products"))
def f3(spark, folder):
    return product_catalogue(fx.transactions(spark, folder))


@query(
    "f5_top_buyers",
    sql(
        """SELECT customer_id, CAST(round(sum(quantity * CAST(unit_price AS DECIMAL(18,6))), 2) AS DOUBLE) AS spend,
  count(DISTINCT invoice_no) AS invoices FROM tx WHERE quantity > 0 AND customer_id IS NOT NULL
GROUP BY customer_id ORDER BY spend DESC, customer_id LIMIT 10""",
        "tx",
    ),
)
def f5(spark, folder):
    return reports.top_buyers(fx.transactions(spark, folder))


@query("f6_distinct_labels", sql("SELECT DISTINCT label FROM predictions", "predictions"))
def f6(spark, folder):
    return reports.distinct_labels(fx.prediction_log(spark, folder))
