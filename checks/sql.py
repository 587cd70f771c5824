"""Common table expressions for the DuckDB side, written independently of the Spark code."""

from __future__ import annotations

_SHARED: dict[str, tuple[tuple[str, ...], str]] = {}


def define(name: str, text: str, *needs: str) -> None:
    _SHARED[name] = (needs, text)


def sql(body: str, *needs: str) -> str:
    """``body`` with the named expressions, and whatever those need, before it."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in _SHARED[name][0]:
                visit(other)
            ordered.append(name)

    for name in needs:
        visit(name)
    parts = ",\n".join(f"{name} AS MATERIALIZED ({_SHARED[name][1]})" for name in ordered)
    return f"WITH {parts}\n{body}" if parts else body


def even(expression: str, digits: int) -> str:
    scale = f"{10**digits}.0::DOUBLE"
    return f"(round_even(({expression}) * {scale}, 0) / {scale})"


LABEL = """CASE WHEN {r} > 150 THEN 'Inactive Customers'
  WHEN {f} > 10 THEN 'Frequent Buyers'
  WHEN {v} > 500 THEN 'Occasional High Value Buyers'
  ELSE 'Medium Customers' END"""


def label(r: str = "recency", f: str = "frequency", v: str = "avg_order_value") -> str:
    return LABEL.format(r=r, f=f, v=v)


define(
    "tx",
    """SELECT
  CASE WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN 'C' || CAST(l_orderkey AS VARCHAR)
       ELSE CAST(l_orderkey AS VARCHAR) END AS invoice_no,
  CAST(l_partkey AS VARCHAR) AS stock_code,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE p_name END AS description,
  CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN -l_quantity ELSE l_quantity END AS INTEGER) AS quantity,
  o_orderdate + INTERVAL 1 HOUR * CAST((o_orderkey % 12) + 8 AS INTEGER) AS invoice_date,
  p_size * CAST(0.25 AS DOUBLE) AS unit_price,
  CASE WHEN o_custkey % 25 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
  n_name AS country
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
define(
    "lines",
    """SELECT *, quantity * unit_price AS order_value,
  CAST(year(invoice_date) AS INTEGER) AS invoice_year,
  CAST(month(invoice_date) AS INTEGER) AS invoice_month,
  CAST(hour(invoice_date) AS INTEGER) AS invoice_hour FROM tx""",
    "tx",
)
define("latest", "SELECT max(invoice_date) AS latest FROM tx", "tx")


def define_features(name: str, source: str, keys: str, anchor: str, *needs: str) -> None:
    """Feature table over ``source`` rows that carry ``anchor``, one row per ``keys``."""
    define(
        f"{name}_hours",
        f"""SELECT * FROM (SELECT {keys}, invoice_hour, row_number() OVER (
  PARTITION BY {keys} ORDER BY count(*) DESC, invoice_hour) AS place
  FROM {source} WHERE customer_id IS NOT NULL GROUP BY {keys}, invoice_hour) WHERE place = 1""",
        *needs,
    )
    define(
        f"{name}_sums",
        f"""SELECT {keys}, max(invoice_date) AS last_seen, max({anchor}) AS anchor,
  count(DISTINCT CASE WHEN quantity > 0 THEN invoice_no END) AS frequency,
  coalesce(sum(CASE WHEN quantity > 0 THEN order_value END), 0.0) AS monetary,
  coalesce(sum(CASE WHEN quantity > 0 AND invoice_date >= {anchor} - INTERVAL 30 DAY THEN order_value END), 0.0) AS monetary_30,
  coalesce(sum(CASE WHEN quantity > 0 AND invoice_date >= {anchor} - INTERVAL 90 DAY THEN order_value END), 0.0) AS monetary_90,
  count(DISTINCT CASE WHEN starts_with(invoice_no, 'C') THEN invoice_no END) AS cancelled_orders,
  count(DISTINCT invoice_no) AS total_orders
FROM {source} WHERE customer_id IS NOT NULL GROUP BY {keys}""",
        *needs,
    )
    define(
        name,
        f"""SELECT {keys},
  CAST(floor((epoch_us(anchor) - epoch_us(last_seen)) / 86400000000) AS INTEGER) AS recency,
  CAST(frequency AS INTEGER) AS frequency,
  {even("monetary / greatest(frequency, 1)", 2)} AS avg_order_value,
  {even("CASE WHEN monetary_90 = 0 THEN 1.0 ELSE monetary_30 / (monetary_90 / 3.0::DOUBLE) END", 2)} AS spending_velocity,
  {even("cancelled_orders::DOUBLE / total_orders", 4)} AS cancellation_rate,
  coalesce(invoice_hour, 12) AS preferred_shopping_hour,
  monetary, monetary_30, monetary_90, cancelled_orders, total_orders
FROM {name}_sums JOIN {name}_hours USING ({keys})""",
        f"{name}_sums",
        f"{name}_hours",
    )


define("dated", "SELECT *, (SELECT latest FROM latest) AS anchor_date FROM lines", "lines", "latest")
define_features("wide", "dated", "customer_id", "anchor_date", "dated")

FEATURES = (
    "recency, frequency, avg_order_value, spending_velocity, cancellation_rate, preferred_shopping_hour"
)
define("rfm", f"SELECT customer_id, {FEATURES} FROM wide", "wide")

define(
    "cut",
    """SELECT days AS cutoff_days, latest - INTERVAL 1 DAY * days AS cutoff,
  (SELECT max(invoice_date) FROM tx WHERE invoice_date < latest - INTERVAL 1 DAY * days) AS anchor_date
FROM latest, (VALUES (90), (120), (180)) AS v(days)""",
    "latest",
    "tx",
)
define("past", "SELECT * FROM lines JOIN cut ON invoice_date < cutoff", "lines", "cut")
define_features("past_wide", "past", "cutoff_days, customer_id", "anchor_date", "past")
define(
    "targets",
    """SELECT cutoff_days, p.customer_id, CAST(f.customer_id IS NULL AS INTEGER) AS churn
FROM (SELECT DISTINCT cutoff_days, customer_id FROM past WHERE customer_id IS NOT NULL) p
LEFT JOIN (SELECT DISTINCT c.cutoff_days, customer_id FROM tx JOIN cut c ON invoice_date >= cutoff) f
USING (cutoff_days, customer_id)""",
    "past",
    "cut",
)
define(
    "frames",
    f"SELECT cutoff_days, customer_id, {FEATURES}, churn FROM past_wide JOIN targets USING (cutoff_days, customer_id)",
    "past_wide",
    "targets",
)
define("training", f"SELECT customer_id, {FEATURES}, churn FROM frames WHERE cutoff_days = 90", "frames")

define(
    "clustered",
    """SELECT *, CAST(CASE WHEN recency > 150 THEN 0 WHEN frequency > 10 THEN 1
  WHEN avg_order_value > 500 THEN 2 ELSE 3 END AS INTEGER) AS cluster FROM rfm""",
    "rfm",
)
define(
    "profile",
    f"""SELECT cluster, count(customer_id) AS customers, {even("avg(recency)", 2)} AS avg_recency,
  {even("avg(frequency)", 2)} AS avg_frequency,
  {even("CAST(sum(CAST(avg_order_value AS DECIMAL(18,2))) AS DOUBLE) / count(avg_order_value)", 2)} AS avg_order_value
FROM clustered GROUP BY cluster""",
    "clustered",
)
define(
    "labelled",
    f"SELECT *, {label('avg_recency', 'avg_frequency', 'avg_order_value')} AS segment FROM profile",
    "profile",
)
define(
    "predictions",
    f"""SELECT md5(customer_id || '_' || v) AS request_id, customer_id, CAST(recency AS DOUBLE) AS recency,
  frequency, avg_order_value, cluster, {label()} AS label, CAST(v AS VARCHAR) AS model_version,
  'rfm_v1' AS feature_version, (CAST(customer_id AS BIGINT) * v) % 97 + 0.5::DOUBLE AS response_time_ms,
  latest - INTERVAL 1 MINUTE * ((CAST(customer_id AS BIGINT) % 1000) * v) AS created_at
FROM clustered, latest, (VALUES (1), (2), (3)) AS versions(v)""",
    "clustered",
    "latest",
)
define(
    "churn_predictions",
    """SELECT md5('churn_' || customer_id || '_' || v) AS request_id, customer_id, CAST(recency AS DOUBLE) AS recency,
  frequency, avg_order_value, spending_velocity, cancellation_rate, preferred_shopping_hour,
  least(1.0::DOUBLE, recency / 365.0::DOUBLE) / v AS churn_probability,
  CAST(least(1.0::DOUBLE, recency / 365.0::DOUBLE) / v >= 0.5 AS INTEGER) AS is_churn,
  CAST(v AS VARCHAR) AS model_version, 'rfm_v1' AS feature_version,
  (CAST(customer_id AS BIGINT) * v) % 97 + 0.5::DOUBLE AS response_time_ms,
  latest - INTERVAL 1 MINUTE * ((CAST(customer_id AS BIGINT) % 1000) * v) AS created_at
FROM rfm, latest, (VALUES (1), (2), (3)) AS versions(v) WHERE CAST(customer_id AS BIGINT) % 10 <> 0""",
    "rfm",
    "latest",
)
define(
    "products",
    """SELECT description, max(stock_code) AS stock_code, max(unit_price) AS unit_price, count(*) AS sales_volume
FROM tx WHERE description IS NOT NULL GROUP BY description""",
    "tx",
)
define("top_products", "SELECT * FROM products ORDER BY sales_volume DESC, description LIMIT 1000", "products")
define(
    "vectors",
    """SELECT description, CAST(embedding AS DOUBLE[]) AS embedding
FROM (SELECT description, row_number() OVER (ORDER BY description) - 1 AS vec_id FROM (SELECT DISTINCT description FROM products))
JOIN embeddings USING (vec_id)""",
    "products",
)
define(
    "catalogue",
    """SELECT stock_code, description, unit_price, embedding
FROM top_products JOIN vectors USING (description)""",
    "top_products",
    "vectors",
)
define(
    "requests",
    """SELECT CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS customer_id,
  CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS recency,
  CASE WHEN c_custkey % 7 = 0 THEN c_mktsegment WHEN c_custkey % 13 = 1 THEN 'NaN' WHEN c_custkey % 13 = 2 THEN 'Infinity'
    WHEN c_custkey % 13 = 3 THEN '-Infinity' ELSE CAST(c_nationkey AS VARCHAR) END AS frequency,
  CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS avg_order_value,
  '1.0' AS spending_velocity, '0.25' AS cancellation_rate,
  CAST(c_custkey % 24 AS VARCHAR) AS preferred_shopping_hour FROM customer""",
)
define(
    "feed",
    """SELECT CASE WHEN event_type = 'error' THEN 'C' || event_id ELSE CAST(event_id AS VARCHAR) END AS invoice_no,
  event_type AS stock_code, event_type AS description,
  CAST(CASE WHEN event_type = 'error' THEN -1 ELSE 1 END AS INTEGER) AS quantity, ts AS invoice_date,
  value AS unit_price, CAST(user_id AS VARCHAR) AS customer_id, 'online' AS country
FROM events WHERE event_type IN ('purchase', 'error')""",
)
