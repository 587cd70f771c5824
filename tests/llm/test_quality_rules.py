import re
from collections import Counter

from basketlens.llm import quality
from basketlens.llm.frames import documents


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {r for r, n in Counter(runs).items() if n > 1}
    covered = {i + j for i, r in enumerate(runs) if r in twice for j in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_against_brute_force(spark, folder):
    docs = documents(spark, folder)
    texts = dict(docs.select("doc_id", "text").collect())
    for row in quality.document_features(docs).collect():
        assert tuple(row)[2:] == brute(texts[row.doc_id])


def test_edges(edge, nothing):
    rows = quality.judge(quality.document_features(edge)).collect()
    assert len(rows) == edge.count()
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3, 5, 6, 7))
    assert quality.judge(quality.document_features(nothing)).count() == 0


def test_a_bad_host_takes_its_documents_with_it(spark):
    good = " ".join(f"word{i}" for i in range(20))
    rows = [(i, "x", "en", "bad") for i in range(40)] + [(100, good, "en", "bad")]
    rows += [(200 + i, good, "en", f"good{i % 9}") for i in range(90)] + [(300, good, "en", None), (301, "short", "en", "small")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: (r.kept, r.host_failed) for r in quality.judge(quality.document_features(docs)).collect()}
    assert kept[100] == (False, True) and kept[200] == (True, False) and kept[300] == (True, False)
    assert kept[301] == (False, False)  # one document is not enough against the prior
