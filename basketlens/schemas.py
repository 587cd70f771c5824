"""Fixed schemas, so that no scan has to infer one."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_text, _int, _long = T.StringType(), T.IntegerType(), T.LongType()
_double, _moment = T.DoubleType(), T.TimestampNTZType()

RAW_TRANSACTIONS = _schema(
    ("InvoiceNo", _text),
    ("StockCode", _text),
    ("Description", _text),
    ("Quantity", _int),
    ("InvoiceDate", _moment),
    ("UnitPrice", _double),
    ("CustomerID", _text),
    ("Country", _text),
)

TRANSACTIONS = _schema(
    ("invoice_no", _text),
    ("stock_code", _text),
    ("description", _text),
    ("quantity", _int),
    ("invoice_date", _moment),
    ("unit_price", _double),
    ("customer_id", _text),
    ("country", _text),
)

RFM = _schema(
    ("customer_id", _text),
    ("recency", _int),
    ("frequency", _int),
    ("avg_order_value", _double),
    ("spending_velocity", _double),
    ("cancellation_rate", _double),
    ("preferred_shopping_hour", _int),
)

PREDICTION_LOG = _schema(
    ("request_id", _text),
    ("customer_id", _text),
    ("recency", _double),
    ("frequency", _int),
    ("avg_order_value", _double),
    ("cluster", _int),
    ("label", _text),
    ("model_version", _text),
    ("feature_version", _text),
    ("response_time_ms", _double),
    ("created_at", _moment),
)

CHURN_LOG = _schema(
    ("request_id", _text),
    ("customer_id", _text),
    ("recency", _double),
    ("frequency", _int),
    ("avg_order_value", _double),
    ("spending_velocity", _double),
    ("cancellation_rate", _double),
    ("preferred_shopping_hour", _int),
    ("churn_probability", _double),
    ("is_churn", _int),
    ("model_version", _text),
    ("feature_version", _text),
    ("response_time_ms", _double),
    ("created_at", _moment),
)

CATALOGUE = _schema(
    ("stock_code", _text),
    ("description", _text),
    ("unit_price", _double),
    ("embedding", T.ArrayType(_double, True)),
)

MODEL_METRICS = _schema(
    ("model", _text),
    ("cutoff_days", _int),
    ("accuracy", _double),
    ("churn_precision", _double),
    ("churn_recall", _double),
    ("churn_f1", _double),
    ("churn_rate", _double),
)
