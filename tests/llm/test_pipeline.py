import numpy as np

import corpus_pipeline as pipeline
from basketlens.llm import secrets
from basketlens.llm.frames import documents
from tests.llm.test_near_duplicates import brute


def test_stages_take_effect(spark, folder):
    docs = documents(spark, folder)
    one = pipeline.language(spark, docs, folder)
    assert one.columns == docs.columns and one.count() == docs.where("text rlike '[A-Za-z]'").count()
    two = pipeline.near_duplicates(spark, docs, folder)
    groups = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert {r.doc_id for r in two.select("doc_id").collect()} == {d for d, (_, c) in groups.items() if c == d}
    assert two.columns == docs.columns
    three = pipeline.secret_scan(spark, docs, folder)
    texts = dict(docs.select("doc_id", "text").collect())
    for r in three.collect():
        assert r.text == secrets.redacted(texts[r.doc_id], secrets.secret_spans(texts[r.doc_id])) and r.n_chars == len(r.text)
    assert three.columns == docs.columns and three.count() == docs.count()
    four = pipeline.mix(spark, docs, folder)
    assert four.columns == docs.columns and four.exceptAll(four.join(docs.select("doc_id"), "doc_id", "left_semi").select(*docs.columns)).count() == 0


def test_run_ends_in_tokens(spark, folder):
    rows = pipeline.run(spark, folder).collect()
    assert rows and all(len(np.frombuffer(r.ids, "<u4")) == r.n_tokens for r in rows)
    assert [name for name, _ in pipeline.STAGES] == ["language", "near_duplicates", "secrets", "mixing", "bpe"]


def test_edges(spark, edge, nothing, folder):
    for name, stage in pipeline.STAGES:
        out = stage(spark, edge, folder)
        assert name == "bpe" or out.columns == edge.columns
        assert out.count() > 0
        assert stage(spark, nothing, folder).count() == 0
