from collections import Counter

import pytest

from basketlens.llm import lines
from basketlens.llm.frames import documents
from tests.llm.helpers import frame, words

UPPER = {i: i + 32 for i in range(65, 91)}


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def brute(texts, least=10, chars=1):
    cut = [(t or "").split("\n") for t in texts]
    counts = Counter(k for rows in cut for k in {key(x) for x in rows} if len(k) >= chars)
    out = []
    for rows in cut:
        kept = [x for x in rows if counts[key(x)] < least]
        out.append((len(rows), len(rows) - len(kept), "\n".join(kept)))
    return out


def check(docs, **options):
    rows = docs.select("doc_id", "text").collect()
    wanted = sorted(((r.doc_id, *b) for r, b in zip(rows, brute([r.text for r in rows], *options.values()))), key=repr)
    found = sorted(map(tuple, lines.without_common_lines(docs, **options).collect()), key=repr)
    assert found == wanted


def corpus(spark, n=400):
    """A third of the documents are one text; lines with other cases and margins, many copies within a document."""
    rows = []
    for i in range(n):
        own = [" ".join(words(i * 7 + j, 4)) for j in range(i % 6)]
        shared = [f"Shared {i % 37}", f"  SHARED {i % 41}\t", "", "É" if i % 2 else "é", f"pair {i // 2}"]
        text = "licence\nall rights\n\nlicence" if i % 3 == 0 else "\n".join(own + shared + shared[:2] * (i % 3))
        rows.append((i, text, "en", "hot" if i % 3 == 0 else "b"))
    return frame(spark, rows)


def test_against_brute_force(spark):
    check(corpus(spark))
    check(corpus(spark), min_documents=3, min_chars=9)


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_any_number_of_batches(spark, batches):
    docs = corpus(spark, 200)
    one = sorted(map(tuple, lines.without_common_lines(docs).collect()))
    assert sorted(map(tuple, lines.without_common_lines(docs, batches=batches).collect())) == one


def test_keys_beyond_ascii(spark):
    """Upper case counts only within A-Z; also where a lower case is shorter, longer or within ASCII."""
    forms = ["Kelvin \u212a k", "kelvin k \u212a", "KELVIN \u212a K", "\u0130stanbul", "i\u0307stanbul", "STRASSE \u00df", "strasse \u1e9e", "\u03a3\u03c3\u03c2 A", "\u03c3\u03a3\u03c2 a", "\u00c9T\u00c9", "\u00e9T\u00e9", "\u00c9t\u00c9 ", "plain", "PLAIN"]
    rows = [(i, "\n".join(form for at, form in enumerate(forms) if (i >> (at % 4)) & 1), "en", "a") for i in range(64)]
    rows += [(100 + i, form, "en", "a") for i, form in enumerate(forms * 2)]
    for least in (2, 5, 33, 40):
        check(frame(spark, rows), min_documents=least)


def test_few_hot_keys_and_many_met_in_the_join(spark, monkeypatch):
    monkeypatch.setattr(lines, "HOT_KEYS", 2)
    check(corpus(spark), min_documents=4)


def test_runs_grow_by_batches(spark):
    """A corpus that arrives in parts: common keys are known as soon as the runs hold them, and leave later runs."""
    runs = lines.LineRuns(spark, min_documents=4)
    docs = frame(spark, [(i, f"common\nline {i // 5}\nown {i}", "en", "a") for i in range(60)])
    for part in range(6):
        batch = docs.where(f"doc_id % 6 = {part}")
        runs.add(runs.counted(batch, lines.F.lit(part)).drop("batch"))
        levels = [level for level, _ in runs.levels]
        assert levels == sorted(set(levels), reverse=True)  # one run a level, as in a binary counter
    assert runs.levels[-1][1].where("n >= 4").count() == 0 or len(runs.levels) == 1
    keys = docs.selectExpr("explode(array('common', concat('line ', doc_id div 5))) AS key").distinct()
    found = runs.common().join(keys.select("key", *lines._hashes(lines.F.col("key"))), ["h", "g"])
    assert {r.key for r in found.collect()} == {"common", *(f"line {i}" for i in range(12))}
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_merges_need_no_exchange(spark):
    runs = lines.LineRuns(spark)
    counts = runs.counted(frame(spark, [(i, f"a\nb {i}", "en", "a") for i in range(30)]), lines.F.col("doc_id") % 2)
    first, second = (counts.where(f"batch = {b}").drop("batch") for b in (0, 1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = second.join(runs._common(first).hint("merge"), ["h", "g"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    runs.close()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_given_table_and_edges(spark, folder, edge, nothing):
    check(documents(spark, folder))
    check(edge)
    check(edge.unionByName(edge).unionByName(edge), min_documents=3)
    assert lines.without_common_lines(nothing).count() == 0
