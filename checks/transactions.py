"""Scans, sinks, projections, filters, splits, joins and set operations."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from basketlens import constants as C
from basketlens.functions import numeric, temporal, text, vectors
from basketlens.operators import campaign, churn, cleaning, enrich, matrix, profiles, reports, rfm, splits
from basketlens.schemas import TRANSACTIONS
from basketlens.session import materialize, working_path
from basketlens.sources import files, logs, star, warehouse
from checks import fixtures as fx
from checks.registry import query
from checks.sql import FEATURES, even, label, sql

TX_COLUMNS = "invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country"
LINE_COLUMNS = f"{TX_COLUMNS}, order_value, invoice_year, invoice_month, invoice_hour"
LOG_COLUMNS = (
    "request_id, customer_id, recency, frequency, avg_order_value, cluster, label, "
    "model_version, feature_version, response_time_ms, created_at"
)
CHURN_LOG_COLUMNS = (
    "request_id, customer_id, recency, frequency, avg_order_value, spending_velocity, cancellation_rate, "
    "preferred_shopping_hour, churn_probability, is_churn, model_version, feature_version, "
    "response_time_ms, created_at"
)

# --- A: scans, sources, sinks -------------------------------------------------


@query(
    "a1_csv_scan",
    sql(
        """SELECT country, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS quantity, sum(unit_price) AS price,
  count(customer_id) AS known, count(description) AS described, max(invoice_date) AS last_date,
  CAST(sum(length('sign "' || description || '", blue')) AS BIGINT) AS letters
FROM tx GROUP BY country""",
        "tx",
    ),
)
def a1(spark, folder):
    """Descriptions with quotes and commas, written as other tools write them: quotes doubled."""
    path = working_path(spark, "csv")
    quoted = F.concat(F.lit('sign "'), "description", F.lit('", blue'))
    files.write_csv(fx.transactions(spark, folder).withColumn("description", quoted), path)
    return (
        files.read_csv(spark, path, TRANSACTIONS)
        .groupBy("country")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("quantity").alias("quantity"),
            F.sum("unit_price").alias("price"),
            F.count("customer_id").alias("known"),
            F.count("description").alias("described"),
            F.max("invoice_date").alias("last_date"),
            F.sum(F.length("description")).alias("letters"),
        )
    )


@query(
    "a2_partitioned_sink",
    sql(
        """SELECT invoice_year, invoice_month, count(*) AS n, sum(order_value) AS revenue
FROM lines GROUP BY ALL""",
        "lines",
    ),
)
def a2(spark, folder):
    path = working_path(spark, "transactions")
    files.write_transactions(fx.enriched(spark, folder), path)
    return (
        files.read_transactions(spark, path)
        .groupBy("invoice_year", "invoice_month")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("order_value").alias("revenue"))
    )


@query(
    "a3_warehouse_projection",
    sql(f"SELECT {TX_COLUMNS.replace('quantity', 'CAST(quantity AS BIGINT) AS quantity')} FROM tx", "tx"),
)
def a3(spark, folder):
    star.raw_retail_transactions(spark, folder).createOrReplaceTempView("raw_transactions")
    return warehouse.read_table(spark, "raw_transactions")


@query("a4_feature_view", sql(f"SELECT customer_id, {FEATURES} FROM rfm", "rfm"))
def a4(spark, folder):
    files.write_features(fx.features(spark, folder), working_path(spark, "features"), "rfm_features")
    return spark.table("rfm_features")


@query("a5_log_scan", sql(f"SELECT {CHURN_LOG_COLUMNS} FROM churn_predictions", "churn_predictions"))
def a5(spark, folder):
    path = working_path(spark, "churn-log")
    logs.append_churn_predictions(fx.churn_log(spark, folder), path, "all")
    return logs.read_churn_predictions(spark, path)


@query("a6_append_predictions", sql(f"SELECT {LOG_COLUMNS} FROM predictions", "predictions"))
def a6(spark, folder):
    path = working_path(spark, "log")
    scored = fx.prediction_log(spark, folder)
    for version in [*fx.VERSIONS, 1]:  # a job that is run again replaces what it wrote
        logs.append_predictions(scored.where(F.col("model_version") == str(version)), path, f"job-{version}")
    return logs.read_predictions(spark, path)


@query("a7_append_churn_predictions", sql(f"SELECT {CHURN_LOG_COLUMNS} FROM churn_predictions", "churn_predictions"))
def a7(spark, folder):
    path = working_path(spark, "churn-log")
    scored = fx.churn_log(spark, folder)
    for version in [*fx.VERSIONS, 1]:  # a job that is run again replaces what it wrote
        logs.append_churn_predictions(scored.where(F.col("model_version") == str(version)), path, f"job-{version}")
    return logs.read_churn_predictions(spark, path)


@query(
    "a8_catalogue_load",
    sql(
        """SELECT stock_code, description, unit_price, CAST(len(embedding) AS INTEGER) AS dimensions,
  round(list_sum(embedding), 9) AS total FROM catalogue""",
        "catalogue",
    ),
)
def a8(spark, folder):
    path = working_path(spark, "catalogue")
    for _ in range(2):  # the second load replaces the first
        logs.replace_catalogue(fx.catalogue_rows(spark, folder), path)
    return logs.read_catalogue(spark, path).select(
        "stock_code",
        "description",
        "unit_price",
        F.size("embedding").alias("dimensions"),
        F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 9).alias("total"),
    )


@query(
    "a9_stage_hand_off",
    sql(
        f"""SELECT 'segments' AS stage, {label()} AS name, count(*) AS customers FROM rfm GROUP BY ALL
UNION ALL SELECT 'hours', CAST(preferred_shopping_hour AS VARCHAR), count(*) FROM rfm GROUP BY ALL""",
        "rfm",
    ),
)
def a9(spark, folder):
    """One stored feature table feeds two consumers."""
    stored = materialize(fx.features(spark, folder), "features")
    name = profiles.rule_label(F.col("recency"), F.col("frequency"), F.col("avg_order_value"))

    def counted(stage, col):
        return stored.groupBy(F.lit(stage).alias("stage"), col.alias("name")).agg(
            F.count(F.lit(1)).alias("customers")
        )

    return counted("segments", name).unionByName(
        counted("hours", F.col("preferred_shopping_hour").cast("string"))
    )


# --- B: projections, filters, predicates, sampling ----------------------------


@query("b1_snake_case_columns", sql(f"SELECT {TX_COLUMNS} FROM tx", "tx"))
def b1(spark, folder):
    return cleaning.snake_case_columns(star.raw_retail_transactions(spark, folder))


@query("b2_with_customer", sql(f"SELECT {TX_COLUMNS} FROM tx WHERE customer_id IS NOT NULL", "tx"))
def b2(spark, folder):
    return cleaning.with_customer(fx.transactions(spark, folder))


@query("b3_positive_quantity", sql(f"SELECT {TX_COLUMNS} FROM tx WHERE quantity > 0", "tx"))
def b3(spark, folder):
    return cleaning.positive_quantity(fx.transactions(spark, folder))


@query(
    "b4_clean_sales",
    sql(f"SELECT {TX_COLUMNS} FROM tx WHERE customer_id IS NOT NULL AND quantity > 0", "tx"),
)
def b4(spark, folder):
    return cleaning.clean_sales(star.raw_retail_transactions(spark, folder))


@query("b4_clean_keep_returns", sql(f"SELECT {TX_COLUMNS} FROM tx WHERE customer_id IS NOT NULL", "tx"))
def b4_returns(spark, folder):
    return cleaning.clean_keep_returns(star.raw_retail_transactions(spark, folder))


@query("b5_order_value", sql("SELECT invoice_no, stock_code, order_value FROM lines", "lines"))
def b5(spark, folder):
    return enrich.with_order_value(fx.transactions(spark, folder)).select(
        "invoice_no", "stock_code", "order_value"
    )


@query(
    "b6_parse_invoice_date",
    "SELECT o_orderkey AS invoice_no, CASE WHEN o_custkey % 25 <> 0 THEN o_orderdate END AS invoice_date FROM orders",
)
def b6(spark, folder):
    written = F.when(
        F.col("o_custkey") % 25 != 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    ).otherwise(F.lit("not a date"))
    raw = star.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("invoice_no"), written.alias("invoice_date")
    )
    return enrich.parse_invoice_date(raw)


@query(
    "b7_time_parts",
    sql("SELECT invoice_no, stock_code, invoice_year, invoice_month, invoice_hour FROM lines", "lines"),
)
def b7(spark, folder):
    return enrich.with_time_parts(fx.transactions(spark, folder)).select(
        "invoice_no", "stock_code", "invoice_year", "invoice_month", "invoice_hour"
    )


@query("b8_enrich", sql(f"SELECT {LINE_COLUMNS} FROM lines", "lines"))
def b8(spark, folder):
    return enrich.enrich(fx.transactions(spark, folder))


@query(
    "b9_number_or_zero",
    sql(
        """SELECT customer_id, coalesce(TRY_CAST(frequency AS DOUBLE), 0.0) AS frequency,
  coalesce(TRY_CAST(avg_order_value AS DOUBLE), 0.0) AS avg_order_value FROM requests""",
        "requests",
    ),
)
def b9(spark, folder):
    requests = fx.scoring_requests(spark, folder).select("customer_id", "frequency", "avg_order_value")
    return requests.transform(enrich.with_numeric, "frequency").transform(
        enrich.with_numeric, "avg_order_value"
    )


@query("b10_select_columns", sql("SELECT recency, frequency, avg_order_value FROM rfm", "rfm"))
def b10(spark, folder):
    return matrix.select_columns(fx.features(spark, folder), C.SEGMENTATION_FEATURES)


@query(
    "b11_log_scaled",
    sql(
        """SELECT customer_id, recency, round(ln(1 + frequency), 9) AS frequency,
  round(ln(1 + avg_order_value), 9) AS avg_order_value FROM rfm""",
        "rfm",
    ),
)
def b11(spark, folder):
    scaled = matrix.log_scaled(fx.features(spark, folder), [*C.LOG_SCALED_FEATURES, "absent"])
    return scaled.select(
        "customer_id",
        "recency",
        F.round("frequency", 9).alias("frequency"),
        F.round("avg_order_value", 9).alias("avg_order_value"),
    )


@query(
    "b12_feature_vectors",
    sql(
        """SELECT customer_id, recency::DOUBLE AS x0, frequency::DOUBLE AS x1, avg_order_value AS x2 FROM rfm""",
        "rfm",
    ),
)
def b12(spark, folder):
    vectors = matrix.to_vectors(fx.features(spark, folder), C.SEGMENTATION_FEATURES)
    item = vector_to_array("features")
    return vectors.select("customer_id", *[item[i].alias(f"x{i}") for i in range(3)])


@query(
    "b13_cutoff_split",
    sql(
        """SELECT CASE WHEN invoice_date < cutoff THEN 'past' ELSE 'future' END AS side, count(*) AS n,
  sum(order_value) AS revenue, min(invoice_date) AS first_date, max(invoice_date) AS last_date
FROM lines, cut WHERE cutoff_days = 90 GROUP BY ALL""",
        "lines",
        "cut",
    ),
)
def b13(spark, folder):
    past, future = churn.split_at_cutoff(fx.enriched(spark, folder))

    def summed(df, side):
        return df.agg(
            F.lit(side).alias("side"),
            F.count(F.lit(1)).alias("n"),
            F.sum("order_value").alias("revenue"),
            F.min("invoice_date").alias("first_date"),
            F.max("invoice_date").alias("last_date"),
        )

    return summed(past, "past").unionByName(summed(future, "future"))


@query(
    "b14_requested_customers",
    sql(
        f"""SELECT customer_id, {FEATURES} FROM rfm WHERE customer_id IN
(SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')""",
        "rfm",
    ),
)
def b14(spark, folder):
    ids = star.table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'")
    return campaign.for_customers(
        fx.features(spark, folder), ids.select(F.col("c_custkey").alias("customer_id"))
    )


@query(
    "b15_described",
    sql(f"SELECT {TX_COLUMNS} FROM tx WHERE description IS NOT NULL", "tx"),
)
def b15(spark, folder):
    return fx.transactions(spark, folder).where(F.col("description").isNotNull())


@query(
    "b16_segment_filter",
    sql(
        f"""SELECT 'Frequent Buyers' AS chosen, {LOG_COLUMNS} FROM predictions WHERE label = 'Frequent Buyers'
UNION ALL SELECT 'All', {LOG_COLUMNS} FROM predictions""",
        "predictions",
    ),
)
def b16(spark, folder):
    log = fx.prediction_log(spark, folder)
    parts = [reports.in_segment(log, name).withColumn("chosen", F.lit(name)) for name in (C.FREQUENT, "All")]
    return parts[0].unionByName(parts[1])


@query(
    "b17_differs_ignoring_case",
    sql(
        """SELECT country, count(*) AS n FROM tx
WHERE lower(description) IS DISTINCT FROM lower('Red WIDGET') GROUP BY country""",
        "tx",
    ),
)
def b17(spark, folder):
    other = text.differs_ignoring_case(F.col("description"), F.lit("Red WIDGET"))
    return fx.transactions(spark, folder).where(other).groupBy("country").agg(F.count(F.lit(1)).alias("n"))


_REASON = """CASE WHEN {c} IS NULL THEN '{c}: missing' WHEN TRY_CAST({c} AS DOUBLE) IS NULL THEN '{c}: not a number'
  WHEN NOT isfinite(TRY_CAST({c} AS DOUBLE)) THEN '{c}: not finite' WHEN TRY_CAST({c} AS DOUBLE) < 0 THEN '{c}: negative' END"""
_REASONS = "concat_ws('; ', " + ", ".join(_REASON.format(c=c) for c in C.CHURN_FEATURES) + ")"


@query(
    "b18_valid_requests",
    sql(
        f"""SELECT customer_id, CAST(recency AS DOUBLE) AS recency, CAST(frequency AS DOUBLE) AS frequency,
  CAST(avg_order_value AS DOUBLE) AS avg_order_value, CAST(spending_velocity AS DOUBLE) AS spending_velocity,
  CAST(cancellation_rate AS DOUBLE) AS cancellation_rate,
  CAST(preferred_shopping_hour AS INTEGER) AS preferred_shopping_hour
FROM requests WHERE {_REASONS} = ''""",
        "requests",
    ),
)
def b18(spark, folder):
    return cleaning.split_requests(fx.scoring_requests(spark, folder), cleaning.CHURN_REQUEST)[0]


@query(
    "b18_quarantined_requests",
    sql(f"SELECT requests.*, {_REASONS} AS reasons FROM requests WHERE {_REASONS} <> ''", "requests"),
)
def b18_bad(spark, folder):
    bad = cleaning.split_requests(fx.scoring_requests(spark, folder), cleaning.CHURN_REQUEST)[1]
    return bad.withColumn("reasons", F.array_join("reasons", "; "))


@query(
    "b19_random_split",
    sql(
        """SELECT customer_id, row_number() OVER (ORDER BY md5(customer_id || '|42'), customer_id)
  <= ceil(count(*) OVER () * 0.2::DOUBLE) AS is_test FROM rfm""",
        "rfm",
    ),
)
def b19(spark, folder):
    return splits.exact_split(fx.stored_features(spark, folder)).select("customer_id", "is_test")


@query(
    "b19_threshold_split",
    sql(
        "SELECT customer_id, substr(md5(customer_id || '|42'), 1, 8) < '33333333' AS is_test FROM rfm", "rfm"
    ),
)
def b19_threshold(spark, folder):
    return splits.threshold_split(fx.features(spark, folder)).select("customer_id", "is_test")


@query(
    "b20_stratified_split",
    sql(
        """SELECT customer_id, churn, row_number() OVER (PARTITION BY churn ORDER BY md5(customer_id || '|42'), customer_id)
  <= ceil(count(*) OVER (PARTITION BY churn) * 0.2::DOUBLE) AS is_test FROM training""",
        "training",
    ),
)
def b20(spark, folder):
    frame = fx.churn_training_frame(spark, folder)
    return splits.exact_split(frame, stratify="churn").select("customer_id", "churn", "is_test")


@query("b21_first_rows", sql(f"SELECT customer_id, {FEATURES} FROM rfm ORDER BY customer_id LIMIT 5", "rfm"))
def b21(spark, folder):
    return splits.first_rows(fx.features(spark, folder), "customer_id")


# --- C: joins ------------------------------------------------------------------


@query(
    "c1_recency_with_sales",
    sql("SELECT customer_id, recency, CAST(frequency AS BIGINT) AS frequency, monetary FROM wide", "wide"),
)
def c1(spark, folder):
    return rfm.recency_with_sales(fx.enriched(spark, folder))


@query(
    "c2_customer_series",
    sql(
        """SELECT customer_id, monetary_30, monetary_90, cancelled_orders, total_orders, preferred_shopping_hour
FROM wide""",
        "wide",
    ),
)
def c2(spark, folder):
    return fx.features_wide(spark, folder).select(
        "customer_id",
        "monetary_30",
        "monetary_90",
        "cancelled_orders",
        "total_orders",
        "preferred_shopping_hour",
    )


@query("c3_features_with_target", sql(f"SELECT customer_id, {FEATURES}, churn FROM training", "training"))
def c3(spark, folder):
    lines = fx.enriched(spark, folder)
    past, future = churn.split_at_cutoff(lines)
    return churn.features_with_target(rfm.rfm_features(past), churn.churn_target(past, future))


@query("c4_churn_target", sql("SELECT customer_id, churn FROM targets WHERE cutoff_days = 90", "targets"))
def c4(spark, folder):
    return churn.churn_target(*churn.split_at_cutoff(fx.transactions(spark, folder)))


@query(
    "c4_retained_and_churned",
    sql(
        """SELECT customer_id, CASE churn WHEN 1 THEN 'churned' ELSE 'retained' END AS kind
FROM targets WHERE cutoff_days = 90""",
        "targets",
    ),
)
def c4_lists(spark, folder):
    past, future = churn.split_at_cutoff(fx.transactions(spark, folder))
    retained = churn.retained_customers(past, future).withColumn("kind", F.lit("retained"))
    return retained.unionByName(churn.churned_customers(past, future).withColumn("kind", F.lit("churned")))


@query(
    "c5_segment_lookup",
    sql("SELECT customer_id, cluster, segment FROM clustered JOIN labelled USING (cluster)", "clustered", "labelled"),
)
def c5(spark, folder):
    clustered = profiles.rule_cluster(fx.features(spark, folder))
    labelled = profiles.label_profile(profiles.cluster_profile(clustered))
    return profiles.with_segment(clustered, labelled).select("customer_id", "cluster", "segment")


@query(
    "c6_label_with_default",
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_nationkey AS cluster,
  CASE c_nationkey WHEN 0 THEN 'Inactive Customers' WHEN 1 THEN 'Medium Customers' WHEN 2 THEN 'Frequent Buyers'
    WHEN 3 THEN 'Occasional High Value Buyers' ELSE 'Unknown' END AS label FROM customer""",
)
def c6(spark, folder):
    predictions = star.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_nationkey").alias("cluster")
    )
    return profiles.label_predictions(predictions)


@query(
    "c7_days_from_latest",
    sql(
        """SELECT country, CAST(sum(days) AS BIGINT) AS days, min(days) AS least, max(days) AS most FROM (
  SELECT country, CAST(floor((epoch_us(latest) - epoch_us(invoice_date)) / 86400000000) AS INTEGER) AS days
  FROM tx, latest) GROUP BY country""",
        "tx",
        "latest",
    ),
)
def c7(spark, folder):
    lines = fx.transactions(spark, folder)
    days = temporal.whole_days_between(F.col("invoice_date"), rfm.latest_date(lines))
    return (
        lines.select("country", days.alias("days"))
        .groupBy("country")
        .agg(F.sum("days").alias("days"), F.min("days").alias("least"), F.max("days").alias("most"))
    )


# --- G: set operations, H: scalar functions -------------------------------------


@query("g1_distinct_customers", sql("SELECT DISTINCT customer_id FROM tx WHERE customer_id IS NOT NULL", "tx"))
def g1(spark, folder):
    return churn.customers(fx.transactions(spark, folder))


@query(
    "g2_customer_difference",
    sql(
        """SELECT customer_id FROM tx, cut WHERE cutoff_days = 90 AND customer_id IS NOT NULL AND invoice_date < cutoff
EXCEPT SELECT customer_id FROM tx, cut WHERE cutoff_days = 90 AND invoice_date >= cutoff""",
        "tx",
        "cut",
    ),
)
def g2(spark, folder):
    return churn.churned_customers(*churn.split_at_cutoff(fx.transactions(spark, folder)))


@query(
    "h_scalar_functions",
    sql(
        f"""SELECT invoice_no, stock_code, starts_with(invoice_no, 'C') AS cancelled,
  lower(regexp_replace(country || 'InvoiceNo', '([a-z])([A-Z])', '\\1_\\2', 'g')) AS snake,
  coalesce(lower(description), 'nan') AS lowered, coalesce(TRY_CAST(invoice_no AS DOUBLE), 0.0) AS number,
  invoice_year, invoice_month, invoice_hour, invoice_date - INTERVAL 30 DAY AS month_before,
  {even("unit_price / 3", 2)} AS third, round(ln(1 + unit_price), 9) AS logged,
  unit_price / nullif(quantity - 10, 0) AS divided, printf('%.2f', unit_price) AS money,
  printf('%.1f%%', unit_price / 3 * 100) AS share, md5(invoice_no || '_' || stock_code) AS request_id FROM lines""",
        "lines",
    ),
)
def h(spark, folder):
    price = F.col("unit_price")
    return fx.enriched(spark, folder).select(
        "invoice_no",
        "stock_code",
        text.is_cancellation(F.col("invoice_no")).alias("cancelled"),
        text.snake_text(F.concat("country", F.lit("InvoiceNo"))).alias("snake"),
        F.lower(text.invoice_text(F.col("description"))).alias("lowered"),
        numeric.number_or_zero(F.col("invoice_no")).alias("number"),
        "invoice_year",
        "invoice_month",
        "invoice_hour",
        temporal.days_before(F.col("invoice_date"), 30).alias("month_before"),
        numeric.round_half_even(price / 3, 2).alias("third"),
        F.round(F.log1p(price), 9).alias("logged"),
        numeric.ratio(price, F.col("quantity") - 10).alias("divided"),
        text.money_text(price).alias("money"),
        text.percent_text(price / 3).alias("share"),
        logs.request_id(F.col("invoice_no"), F.col("stock_code")).alias("request_id"),
    )


@query(
    "h_vector_functions",
    """SELECT vec_id, round(list_dot_product(v, w), 6) AS dot, round(sqrt(list_dot_product(v, v)), 6) AS norm,
  round(list_cosine_similarity(v, w), 6) AS cosine
FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, list_reverse(CAST(embedding AS DOUBLE[])) AS w FROM embeddings)""",
)
def h_vectors(spark, folder):
    """Every vector with itself read backwards."""
    here, there = F.col("embedding"), F.reverse("embedding")
    return star.table(spark, folder, "embeddings").select(
        "vec_id",
        F.round(vectors.dot(here, there), 6).alias("dot"),
        F.round(vectors.norm(here), 6).alias("norm"),
        F.round(vectors.cosine(here, there), 6).alias("cosine"),
    )
