"""Logs of versions: runs of a table of batches, the index of a feed, models in use."""

import datetime as dt

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from basketlens import manifest
from basketlens.plans import lloyd, registry
from basketlens.session import subfolders, working_path
from basketlens.streaming import changelog, feed
from tests.test_streaming import SCHEMA, line

NOW = dt.timedelta(0)


def state(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], "n int")


def test_versions_follow_each_other(spark):
    path = working_path(spark, "test-log")
    assert manifest.current(spark, path) == (0, [])
    assert manifest.commit(state(spark, 5), path, 0) == 1
    assert manifest.commit(state(spark, 6, 7), path, 1) == 2
    with pytest.raises(manifest.Conflict):
        manifest.commit(state(spark, 8), path, 1)  # began before version 2
    number, rows = manifest.current(spark, path)
    assert number == 2 and sorted(r.n for r in rows) == [6, 7]
    manifest.forget(spark, path, 2)
    assert subfolders(spark, path) == ["version=2"]


def test_a_writer_that_died_does_not_stop_the_others(spark):
    path = working_path(spark, "test-log")
    manifest.commit(state(spark, 5), path, 0)
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=2/_temporary/0")
    files.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(files)
    assert manifest.current(spark, path)[0] == 1
    assert manifest.commit(state(spark, 6), path, 1) == 3 and manifest.current(spark, path)[0] == 3


def summed(rows):
    return rows.groupBy("key").agg(F.sum("n").alias("n"))


def totals(frame):
    return {r.key: r.n for r in summed(frame).collect()}


def test_runs_stay_few_and_no_reader_loses_a_row(spark, monkeypatch):
    monkeypatch.setattr(changelog, "FANOUT", 2)
    path = working_path(spark, "test-table")
    wanted, readers = {}, []
    for batch in range(11):
        rows = [(f"k{batch % 3}", 1), ("all", 10)]
        for key, n in rows:
            wanted[key] = wanted.get(key, 0) + n
        changelog.write_batch(spark.createDataFrame(rows, "key string, n int"), batch, path)
        readers.append((changelog.read_partials(spark, path), dict(wanted)))  # its files are fixed now
        if batch % 2:
            changelog.compact(spark, path, summed)
        assert totals(changelog.read_partials(spark, path)) == wanted
    for reader, seen in readers:  # runs that were combined meanwhile are still there
        assert totals(reader) == seen
    _, runs = manifest.current(spark, f"{path}-log")
    runs = sorted(runs, key=lambda run: run["low"])
    assert [(r["low"], r["high"], r["level"]) for r in runs] == [(0, 7, 2), (8, 9, 0)]
    assert changelog.combined_upto(spark, path) == 9
    before = len(subfolders(spark, f"{path}-runs"))
    changelog.clean(spark, path)  # nothing is old enough
    assert len(subfolders(spark, f"{path}-runs")) == before and len(subfolders(spark, path)) == 11
    changelog.clean(spark, path, NOW)
    assert len(subfolders(spark, f"{path}-runs")) == 2 and subfolders(spark, path) == ["batch_id=10"]
    assert len(subfolders(spark, f"{path}-log")) == 1
    assert totals(changelog.read_partials(spark, path)) == wanted
    changelog.compact(spark, path, summed)
    changelog.clean(spark, path, NOW)
    assert subfolders(spark, path) == [] and totals(changelog.read_partials(spark, path)) == wanted
    changelog.compact(spark, path, summed)  # nothing new
    assert totals(changelog.read_partials(spark, path)) == wanted


def test_a_batch_that_runs_again_after_it_was_combined_counts_once(spark):
    path = working_path(spark, "test-table")
    rows = spark.createDataFrame([("a", 1)], "key string, n int")
    for batch in (0, 1):
        changelog.write_batch(rows, batch, path)
    changelog.compact(spark, path, summed)
    changelog.write_batch(rows, 1, path)
    assert totals(changelog.read_partials(spark, path)) == {"a": 2}


def test_a_feed_opens_few_files_however_many_batches(spark, monkeypatch):
    monkeypatch.setattr(changelog, "FANOUT", 2)
    base = working_path(spark, "test-feed")
    write = feed.without_replays(base, compact_every=2, grace=NOW)
    opened = []
    for batch in range(10):
        rows = [line(f"{batch}", 1 + batch), line(f"{batch}", 1 + batch), line(f"{max(batch - 5, 0)}", max(batch - 4, 1))]
        write(spark.createDataFrame(rows, SCHEMA), batch)
        opened.append(len(changelog.read_partials(spark, f"{base}/index").inputFiles()))
    assert sorted(int(r.invoice_no) for r in feed.stored_lines(spark, base).collect()) == list(range(10))
    counts = changelog.read_rows(spark, f"{base}/counts").agg(*[F.sum(c).alias(c) for c in ("rows", "kept", "repeated", "aside")]).first()
    assert tuple(counts) == (30, 10, 20, 0)
    assert max(opened) <= 3, opened  # two runs and the batch after them
    before = feed.stored_lines(spark, base).count()
    write(spark.createDataFrame([line("7", 8)], SCHEMA), 7)  # the batch is final and is not taken again
    assert feed.stored_lines(spark, base).count() == before


def test_equal_lines_with_nulls_are_replays(spark):
    base = working_path(spark, "test-feed")
    write = feed.without_replays(base)
    rows = [("1", None, "d", 1, line("1", 3)[4], None, "a", "x"), ("1", "a", "d", 1, line("1", 3)[4], None, None, "x")]
    for batch in range(2):
        write(spark.createDataFrame(rows, SCHEMA), batch)
    assert feed.stored_lines(spark, base).count() == 2


def model(number):
    return PipelineModel(stages=[lloyd.NearestCentre([[float(number)]])])


def parts(number, **more):
    return {"one": registry.saved(model(number)), "two": registry.saved(model(number)), **more}


def numbers(spark, root):
    return [registry.load(spark, root, name).stages[0].clusterCenters()[0][0] for name in ("one", "two")]


def test_models_move_together_or_not_at_all(spark):
    root = working_path(spark, "test-models")
    assert registry.in_use(spark, root) is None
    with pytest.raises(LookupError):
        registry.load(spark, root, "one")
    assert registry.publish(spark, root, 1, parts(1), 0.5) and numbers(spark, root) == [1, 1]

    def fails(path):
        raise RuntimeError("disk full")

    with pytest.raises(RuntimeError):
        registry.publish(spark, root, 2, parts(2, three=fails), 0.9)
    assert numbers(spark, root) == [1, 1] and registry.in_use(spark, root).model_version == 1
    assert not registry.publish(spark, root, 3, parts(3), 0.49) and numbers(spark, root) == [1, 1]
    assert registry.publish(spark, root, 4, parts(4), 0.5) and numbers(spark, root) == [4, 4]


def test_a_switch_meanwhile_leads_to_the_gate_again(spark, monkeypatch):
    root = working_path(spark, "test-models")
    commit = manifest.commit

    def overtaken(rows, path, after):
        monkeypatch.setattr(manifest, "commit", commit)
        assert registry.publish(spark, root, 7, parts(7), 0.8)  # another job is faster, and better
        return commit(rows, path, after)

    monkeypatch.setattr(manifest, "commit", overtaken)
    assert not registry.publish(spark, root, 6, parts(6), 0.7)
    assert registry.in_use(spark, root).model_version == 7
