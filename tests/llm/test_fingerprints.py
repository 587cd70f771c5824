import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import sketches
from basketlens.llm.frames import documents
from tests.llm.helpers import frame, words


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_pairs_against_brute_force(spark, folder):
    docs = documents(spark, folder)
    rows = sorted(docs.select("doc_id", "text").collect())
    found = {r.doc_id: r for r in sketches.edited_pairs(docs).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("sha"), sketches.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near"),
        sketches.resemblance(F.col("sketch"), F.col("next_sketch")).alias("following"), sketches.distinct_count(F.col("sketch")).alias("n")).collect()}
    errors = []
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = found[doc]
        assert row.n_chars == len(text) and row.sha == hashlib.sha256(edited.encode()).hexdigest()
        one, two, three = shingles(text), shingles(edited), shingles(after)
        errors += [row.near - likeness(one, two), row.following - likeness(one, three)]
        if len(one) < sketches.K:
            assert row.n == len(one)
    assert np.abs(errors).max() < 0.2 and np.abs(errors).mean() < 0.03


def test_merge_is_the_fingerprint_of_the_whole(spark):
    one, two = words(1, 400), words(2, 300)
    row = spark.createDataFrame([(" ".join(one), " ".join(two))], "a string, b string").select(
        F.array(F.lit(0)).alias("k"), sketches.shingle_hashes(F.col("a")).alias("x"), sketches.shingle_hashes(F.col("b")).alias("y"))
    both = row.select(sketches.merge(sketches.smallest(F.col("x")), sketches.smallest(F.col("y"))).alias("merged"), sketches.smallest(F.concat("x", "y")).alias("whole"))
    assert both.first().merged == both.first().whole
    parts = row.select(F.lit(1).alias("doc"), sketches.smallest(F.col("x")).alias("s")).unionByName(row.select(F.lit(1).alias("doc"), sketches.smallest(F.col("y")).alias("s")))
    assert sketches.merged(parts, ["doc"], "s").first().s == both.first().whole


def test_containment_and_counts(spark):
    long = words(5, 4000, 100_000)
    rows = spark.createDataFrame([(" ".join(long), " ".join(long[:2000]))], "a string, b string").select(
        sketches.fingerprint(F.col("a"), 512).alias("a"), sketches.fingerprint(F.col("b"), 512).alias("b"))
    found = rows.select(sketches.containment(F.col("b"), F.col("a"), 512).alias("inside"), sketches.containment(F.col("a"), F.col("b"), 512).alias("half"),
                        sketches.distinct_count(F.col("a"), 512).alias("n")).first()
    assert found.inside > 0.85 and abs(found.half - 0.5) < 0.1 and abs(found.n / 3996 - 1) < 0.15


@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_next_rows(spark, buckets):
    ids = [5, 1, 9, 12, -3, 40, None, 41, 7]
    docs = spark.createDataFrame([(i, f"t{i}", 0) for i in ids], "doc_id long, text string, _mark long").repartition(4)
    order = sorted((i for i in ids if i is not None)) + [None]
    found = {r.doc_id: r.next_text for r in sketches.with_next(docs, "doc_id", ["text"], buckets).collect()}
    assert found == {i: f"t{j}" for i, j in zip(order, order[1:] + order[:1])}


def test_edges(edge, nothing, spark):
    found = sketches.edited_pairs(edge)
    rows = found.select("doc_id", sketches.as_text(F.col("sketch")).alias("f"), sketches.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near")).collect()
    assert len(rows) == edge.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].f == by_id[2].f == by_id[3].f == "" and by_id[1].near == 1.0
    assert by_id[5].f == by_id[6].f and by_id[9].f == by_id[10].f
    assert sketches.edited_pairs(nothing).count() == 0
    assert sketches.edited_pairs(frame(spark, [(1, "only one", "en", "s")])).count() == 1
