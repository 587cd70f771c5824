import datetime as dt

from basketlens.operators.rfm import rfm_features
from basketlens.schemas import CHURN_LOG, PREDICTION_LOG
from basketlens.session import working_path
from basketlens.sources import logs
from basketlens.streaming import changelog, feed, monitors, refresh, state
from checks import fixtures as fx
from __spark_entry__ import QUERIES

SCHEMA = (
    "invoice_no string, stock_code string, description string, quantity int, invoice_date timestamp, "
    "unit_price double, customer_id string, country string"
)


def at(day, hour=10):
    return dt.datetime(2024, 1, day, hour)


def line(number, day, customer="a", quantity=1, price=2.0):
    return (number, "s", "d", quantity, at(day), price, customer, "x")


class Folder:
    """A folder that files arrive in."""

    def __init__(self, spark):
        self.spark, self.path, self.base = spark, working_path(spark, "in"), working_path(spark, "out")

    def arrive(self, *rows):
        self.spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        return feed.read_stream(self.spark, self.path, schema, files_per_batch=1)


def test_ingest_takes_up_new_files_only(spark):
    folder = Folder(spark)
    folder.arrive(line("1", 1), line("2", 1, customer=None))
    path = changelog.run(feed.ingest(folder.stream()), folder.base)
    assert changelog.read_rows(spark, path).count() == 1
    folder.arrive(line("C3", 2, quantity=-1))
    changelog.run(feed.ingest(folder.stream()), folder.base)
    rows = changelog.read_rows(spark, path).collect()
    assert sorted(r.invoice_no for r in rows) == ["1", "C3"]


def test_a_repeated_batch_replaces_itself(spark):
    path = working_path(spark, "batches")
    changelog.write_batch(spark.range(3), 0, path)
    changelog.write_batch(spark.range(5), 1, path)
    changelog.write_batch(spark.range(3), 0, path)
    assert changelog.read_rows(spark, path).count() == 8


def test_replays_are_dropped_however_late(spark):
    folder = Folder(spark)
    folder.arrive(line("1", 2), line("1", 2), line("2", 28), line("4", 3, customer=None))
    folder.arrive(line("1", 2), line("3", 1), line("4", 3, customer=None))
    undated = ("5", "s", "d", 1, None, 2.0, "a", "x")
    folder.arrive(line("2", 28), undated)
    for _ in range(2):  # nothing new the second time
        changelog.start(folder.stream(), f"{folder.base}/checkpoint", feed.without_replays(folder.base)).awaitTermination()
    assert sorted(r.invoice_no for r in feed.stored_lines(spark, folder.base).collect()) == ["1", "2", "3", "4"]
    counts = [tuple(r) for r in changelog.read_rows(spark, f"{folder.base}/counts").collect()]
    assert sorted(counts) == [(2, 0, 1, 1), (3, 1, 2, 0), (4, 3, 1, 0)]
    assert all(rows == kept + repeated + aside for rows, kept, repeated, aside in counts)
    assert spark.read.parquet(f"{folder.base}/quarantine").count() == 1


def test_a_replay_is_compared_with_the_stored_lines_once(spark, monkeypatch):
    """Lines and index are written from the result of the comparison, not each from a join of its own."""
    base, written, write = working_path(spark, "once"), {}, feed.write_batch

    def watched(rows, batch, path):
        written[path.rsplit("/", 1)[1], batch] = rows._jdf.queryExecution().optimizedPlan().toString()
        write(rows, batch, path)

    monkeypatch.setattr(feed, "write_batch", watched)
    for batch, some in enumerate(([line("1", 2), line("2", 2)], [line("2", 2), line("3", 2), line("3", 2)])):
        feed.without_replays(base)(spark.createDataFrame(some, SCHEMA), batch)
    assert sorted(r.invoice_no for r in feed.stored_lines(spark, base).collect()) == ["1", "2", "3"]
    assert not any("Join" in written[table, batch] for table in ("lines", "index") for batch in (0, 1))


def test_a_repeated_batch_keeps_the_same_lines(spark):
    base, rows = working_path(spark, "again"), spark.createDataFrame([line("1", 2), line("2", 2)], SCHEMA)
    for batch in (0, 0, 1):
        feed.without_replays(base)(rows, batch)
    assert feed.stored_lines(spark, base).count() == 2


def test_cancellation_alert(spark):
    folder = Folder(spark)
    folder.arrive(*[line(f"{i}", 2) for i in range(6)], *[line(f"C{i}", 2) for i in range(4)])
    folder.arrive(*[line(f"{i}", 28) for i in range(3)])
    folder.arrive(*[line(f"{i}", 1) for i in range(19)], line("C1", 1), line("6", 28))  # weeks late
    path = changelog.collect(folder.stream(), folder.base, monitors.cancellation_counts)
    rows = monitors.cancellation_rate(changelog.read_partials(spark, path)).orderBy("window_start").collect()
    assert [(r.rows, r.cancellation_rate, r.alert) for r in rows] == [(20, 0.05, False), (10, 0.4, True), (4, 0.0, False)]


def test_sliding_windows_cover_each_sale_seven_times(spark):
    folder = Folder(spark)
    folder.arrive(line("1", 10, quantity=4, price=1.5), line("2", 11, quantity=2, price=2.5), line("C3", 11, quantity=-1))
    path = changelog.collect(folder.stream(), folder.base, monitors.sales_sums)
    rows = monitors.volume_drift(changelog.read_partials(spark, path)).collect()
    assert len(rows) == 8 and sum(r.sales for r in rows) == 14
    both = [r for r in rows if r.sales == 2]
    assert {(r.mean_quantity, r.max_quantity, r.mean_price, r.max_price) for r in both} == {(3.0, 4, 2.0, 2.5)}


def test_state_over_batches_and_compaction(spark):
    folder = Folder(spark)
    folder.arrive(line("1", 1, price=2.0), line("1", 1, price=3.0), line("2", 1, customer="b"))
    folder.arrive(line("1", 1, price=4.0), line("C5", 3, quantity=-1))
    for _ in range(2):
        totals = changelog.collect(folder.stream(), f"{folder.base}/t", state.customer_sums)
        changelog.compact(spark, totals, state.combined_sums)
    folder.arrive(line("9", 2, price=0.5, customer="b"))
    changelog.collect(folder.stream(), f"{folder.base}/t", state.customer_sums)
    found = {r.customer_id: r for r in state.customer_totals(changelog.read_partials(spark, totals)).collect()}
    assert (found["a"].rows, found["a"].cancelled, found["a"].monetary) == (4, 1, 9.0)
    assert found["a"].last_seen == at(3) and (found["b"].rows, found["b"].monetary) == (2, 2.5)
    counts = changelog.collect(folder.stream(), f"{folder.base}/f", state.sale_invoices)
    frequency = state.customer_frequency(changelog.read_partials(spark, counts))
    assert {r.customer_id: r.frequency for r in frequency.collect()} == {"a": 1, "b": 2}


def test_refresh_equals_batch_after_every_arrival(spark):
    folder = Folder(spark)
    arrivals = [
        [line("1", 1), line("2", 1, customer="b"), line("9", 28, customer=None)],
        [line("1", 1), line("3", 20, price=8.0), line("C4", 21, quantity=-1)],  # invoice 1 goes on
        [line("5", 31, customer="c")],
    ]
    for place in range(len(arrivals)):
        folder.arrive(*arrivals[place])
        refresh.run_refresh(folder.stream(), folder.base)
        seen = spark.read.schema(SCHEMA).parquet(folder.path)
        wanted = rfm_features(seen)
        if place == 1:
            refresh.compact(spark, folder.base)
        found = refresh.current_features(spark, folder.base)
        assert sorted(found.collect()) == sorted(wanted.collect())


def test_scored_stream_goes_to_log_and_quarantine(spark, folder):
    rows = QUERIES["k7_stream_segments"](spark, folder)
    assert rows.count() > 0 and rows.where("not as_in_batch").count() == 0


def test_log_rows_have_the_log_schema(spark):
    scored = spark.createDataFrame(
        [(None, 1.0, 2.0, 3.0, 1, "x", "1", "rfm_v1", 0.5, "r")],
        "customer_id long, recency double, frequency double, avg_order_value double, cluster int, label string, "
        "model_version string, feature_version string, response_time_ms double, request_id string",
    )
    rows = logs.log_rows(scored, PREDICTION_LOG)
    assert rows.dtypes == [(f.name, f.dataType.simpleString()) for f in PREDICTION_LOG.fields]
    first = rows.first()
    assert first.customer_id == "" and first.frequency == 2 and first.created_at is not None


def test_appends_add_up(spark, folder):
    path = working_path(spark, "append")
    log = fx.churn_log(spark, folder)
    for job in ("first", "second", "second"):  # the last one is repeated
        logs.append_churn_predictions(log, path, job)
    stored = logs.read_churn_predictions(spark, path)
    assert stored.count() == 2 * log.count() and stored.columns == CHURN_LOG.names


def test_lines_without_a_date_are_counted_apart(spark):
    folder = Folder(spark)
    undated = [("C8", "s", "d", 2, None, 4.0, "a", "x"), ("9", "s", "d", 2, None, 4.0, "a", "x")]
    folder.arrive(line("1", 2), *undated)
    folder.arrive(line("2", 2), undated[1])
    rates = changelog.collect(folder.stream(), f"{folder.base}/r", monitors.cancellation_counts)
    found = {r.window_start: (r.rows, r.cancelled) for r in monitors.cancellation_rate(changelog.read_partials(spark, rates)).collect()}
    assert found[None] == (3, 1) and sum(n for n, _ in found.values()) == 5
    drift = changelog.collect(folder.stream(), f"{folder.base}/d", monitors.sales_sums)
    found = {r.window_start: r.sales for r in monitors.volume_drift(changelog.read_partials(spark, drift)).collect()}
    assert found[None] == 3 and len(found) == 8
