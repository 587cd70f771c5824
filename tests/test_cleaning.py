import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketlens.functions.numeric import number_or_zero, round_half_even
from basketlens.functions.temporal import whole_days_between
from basketlens.functions.text import differs_ignoring_case, snake_name
from basketlens.operators import cleaning, enrich, matrix
from basketlens.schemas import TRANSACTIONS
from basketlens.session import working_path
from basketlens.sources import files


def test_snake_names():
    names = ["InvoiceNo", "StockCode", "CustomerID", "Country", "already_snake"]
    assert [snake_name(n) for n in names] == [
        "invoice_no", "stock_code", "customer_id", "country", "already_snake",
    ]


def test_clean_sales_and_returns(spark):
    raw = spark.createDataFrame(
        [("1", 2, "a"), ("C2", -1, "a"), ("3", 5, None), ("4", None, "b")],
        "InvoiceNo string, Quantity int, CustomerID string",
    )
    assert [r.invoice_no for r in cleaning.clean_sales(raw).collect()] == ["1"]
    kept = [r.invoice_no for r in cleaning.clean_keep_returns(raw).collect()]
    assert sorted(kept) == ["1", "4", "C2"]


def test_rounding_is_half_even_on_the_scaled_value(spark):
    rows = spark.createDataFrame([(1.005,), (8.345,), (0.125,), (2.5,)], "x double")
    rounded = [r[0] for r in rows.select(round_half_even(F.col("x"), 2)).collect()]
    assert rounded == [1.0, 8.35, 0.12, 2.5]


def test_whole_days(spark):
    night = (dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1))
    day = (dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 23))
    rows = spark.createDataFrame([night, day], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in rows.select(whole_days_between(F.col("a"), F.col("b"))).collect()] == [0, 1]


def test_number_or_zero(spark):
    rows = spark.createDataFrame([("1.5",), ("banana",), (None,)], "x string")
    assert [r[0] for r in rows.select(number_or_zero(F.col("x"))).collect()] == [1.5, 0.0, 0.0]


def test_null_text_differs(spark):
    rows = spark.createDataFrame([("Red",), ("blue",), (None,)], "x string")
    kept = rows.where(differs_ignoring_case(F.col("x"), F.lit("RED"))).collect()
    assert [r.x for r in kept] == ["blue", None]


def test_bad_dates_become_null_and_are_counted(spark):
    rows = spark.createDataFrame(
        [("2024-01-02 03:04:05", 2, 1.5), ("soon", 1, 1.0), (None, 1, 1.0)],
        "invoice_date string, quantity int, unit_price double",
    )
    assert enrich.unparsed_dates(rows).first().asDict() == {"unparsed": 1, "total": 3}
    first = enrich.enrich(rows).first()
    assert (first.order_value, first.invoice_year, first.invoice_month, first.invoice_hour) == (3.0, 2024, 1, 3)


def test_requests(spark):
    rows = spark.createDataFrame(
        [("1", "30", "40", "100"), ("2", "banana", "1", "1"), (None, "1", "-2", None), (None, "0", "0", "0")],
        "customer_id string, recency string, frequency string, avg_order_value string",
    )
    valid, bad = cleaning.split_requests(rows, cleaning.SEGMENTATION_REQUEST)
    assert {r.customer_id for r in valid.collect()} == {"1", None}
    assert dict(valid.dtypes)["recency"] == "double"
    assert sorted(tuple(r.reasons) for r in bad.collect()) == [
        ("frequency: negative", "avg_order_value: missing"),
        ("recency: not a number",),
    ]
    valid, bad = cleaning.split_requests(rows, cleaning.CHURN_REQUEST)  # three fields are no columns at all
    assert valid.count() == 0 and bad.count() == 4


def test_selection_log_and_vectors(spark):
    rows = spark.createDataFrame([(10, 9, 99), (20, 3, 50)], "recency int, frequency int, avg_order_value int")
    assert matrix.select_columns(rows, ["recency", "frequency"]).columns == ["recency", "frequency"]
    logged = matrix.log_scaled(rows, ["frequency", "absent"]).first()
    assert abs(logged.frequency - 2.302585092994046) < 1e-12 and logged.avg_order_value == 99
    vectors = [r.features.toArray().tolist() for r in matrix.to_vectors(rows, rows.columns).collect()]
    assert vectors == [[10, 9, 99], [20, 3, 50]]


def test_constant_column_scales_to_zero(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaled = [tuple(r) for r in matrix.standard_scaled(rows, ["a", "b"]).collect()]
    assert scaled == [(-1.0, 0.0), (1.0, 0.0)]


def test_csv_keeps_malformed_rows(spark):
    path = working_path(spark, "bad-csv")
    lines = spark.createDataFrame(
        [("h",), ("1,a,x,2,2024-01-01 08:00:00,1.5,7,UK",), ("2,b,y,two,2024-01-01 09:00:00,1.5,7,UK",)], "value string"
    )
    lines.coalesce(1).write.text(path)
    rows = files.read_csv(spark, path, TRANSACTIONS, keep_corrupt=True).collect()
    assert [r.quantity for r in rows] == [2, None]
    assert [r["_corrupt_record"] is None for r in rows] == [True, False]


def test_csv_with_quotes_commas_and_malformed_rows(spark):
    path = working_path(spark, "csv")
    lines = ["a,b", '1,"SIGN ""HOME"", BLUE"', "2,plain", "x,bad"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    schema = spark.createDataFrame([], "a int, b string").schema
    good, bad = files.split_corrupt(files.read_csv(spark, path, schema, keep_corrupt=True).cache())
    assert sorted(map(tuple, good.collect())) == [(1, 'SIGN "HOME", BLUE'), (2, "plain")]
    assert [r[0] for r in bad.collect()] == ["x,bad"]
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, path, schema).collect()


@pytest.mark.parametrize("value", ["NaN", "Infinity", "-Infinity"])
def test_numbers_that_are_not_finite_are_quarantined(spark, value):
    rows = spark.createDataFrame([("1", value, "2", "3")], "customer_id string, recency string, frequency string, avg_order_value string")
    valid, bad = cleaning.split_requests(rows, cleaning.SEGMENTATION_REQUEST)
    assert valid.count() == 0 and bad.first().reasons == ["recency: not finite"]
