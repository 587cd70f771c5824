import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from basketlens.llm import importance
from basketlens.llm.frames import documents
from tests.llm.helpers import frame, words

UPPER = {i: i + 32 for i in range(65, 91)}


def features(text, longest=1, buckets=10_000):
    found = [w for w in re.split("[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", (text or "").translate(UPPER)) if w]
    runs = [" ".join(found[i : i + n]) for n in range(1, longest + 1) for i in range(len(found) - n + 1)]
    return len(found), [zlib.crc32(run.encode()) % buckets for run in runs]


def brute(docs, target, percent=10, least=20, longest=1, buckets=10_000):
    """(doc_id, n_features, weight, score) of every row, and the drawn ones in order."""
    own = [(d, *features(t, longest, buckets)) for d, t in docs]
    s = Counter(b for *_, found in own for b in found)
    t = Counter(b for text in target for b in features(text, longest, buckets)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gains = [
        math.floor(1000.0 * math.log(((t[b] + 1.0) * (all_s + float(buckets))) / ((s[b] + 1.0) * (all_t + float(buckets)))))
        for b in range(buckets)
    ]
    rows = []
    for d, n_words, found in own:
        weight = sum(gains[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(found), weight, weight + math.floor(-1000.0 * math.log(-math.log((h + 0.5) / 4294967296.0))), n_words))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return [r[:4] for r in rows], [r[:4] for r in able[: len(able) * percent // 100]]


def check(docs, target, **options):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    every, drawn = brute(rows, [r.text for r in target.select("text").collect()], **options)
    renamed = {"min_words" if k == "least" else k: v for k, v in options.items()}
    found = importance.resampled(docs, target, **renamed).collect()
    assert sorted((tuple(r)[:4] for r in found), key=repr) == sorted(every, key=repr)
    ranked = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    # of rows equal in score and id any may be drawn
    assert [(r.doc_id, r.score) for r in ranked] == [(r[0], r[3]) for r in drawn]


def benchmark(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def test_given_tables(spark, folder):
    check(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def test_longer_features_and_fewer_buckets(spark):
    docs = frame(spark, [(i, " ".join(words(i, 5 + i % 40)), "en", "a") for i in range(120)])
    target = benchmark(spark, [" ".join(words(i, 30)) for i in range(10)])
    check(docs, target, longest=3, buckets=97, percent=35, least=12)


def test_ties_of_score_and_id(spark):
    """Equal texts with one id tie in everything; a cut-off inside such ties still draws the exact number."""
    same = " ".join(words(1, 25))
    rows = [(7, same, "en", "a")] * 30 + [(None, same, "en", "a")] * 30 + [(i, same, "en", "a") for i in range(100, 140)]
    for percent in (0, 1, 13, 30, 47, 99, 100):
        check(frame(spark, rows), benchmark(spark, [same]), percent=percent)


def test_ties_of_score_are_cut_by_id(spark):
    scores = spark.createDataFrame([(1 << 40, 5), (3, 5), (-9, 5), (4, 9), (None, 5), (8, -2)], "doc_id long, score long")
    order = [4, -9, 3, 1 << 40, None, 8]
    for wanted in range(1, 7):
        got = [r.doc_id for r in scores.where(importance.cutoff(scores, wanted)).collect()]
        assert sorted(got, key=str) == sorted(order[:wanted], key=str)


def test_draw_favours_the_target(spark):
    """Held against the use of it: documents in the target's words are drawn far more often."""
    rows = [(i, " ".join(f"{'near' if i % 4 == 0 else 'far'}{w}" for w in words(i, 60, 50)), "en", "a") for i in range(800)]
    target = benchmark(spark, [" ".join(f"near{w}" for w in words(9000 + i, 60, 50)) for i in range(40)])
    drawn = importance.resampled(frame(spark, rows), target).where(F.col("rank").isNotNull())
    assert drawn.where("doc_id % 4 = 0").count() > 0.9 * drawn.count() > 0


def test_edges(spark, edge, nothing):
    target = benchmark(spark, ["one two three", None, ""])
    check(edge, target)
    check(edge, target, least=1, percent=60)
    check(edge, target.where("item_id > 5"), least=1, percent=60)
    assert importance.resampled(nothing, target).count() == 0
