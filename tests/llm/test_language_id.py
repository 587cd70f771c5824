from pyspark.sql import functions as F

from basketlens.llm import langid
from basketlens.llm.frames import documents


def test_held_out_accuracy(spark, folder):
    docs = documents(spark, folder).withColumn("held", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2)
    model = langid.fit(docs.where("not held"))
    found = langid.identify(docs.where("held"), model, keep=("doc_id", "lang")).collect()
    right = sum(r.lang == r.lang_pred for r in found)
    assert right >= 0.95 * len(found) > 0 and all(0 <= r.score <= 1 for r in found)


def test_back_off_from_words_to_characters(spark):
    rows = [("the cat sat on the mat with the hat", "en"), ("die katze saß auf der matte mit dem hut", "de"), (None, "en"), ("kein etikett", None)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["de", "en"]
    assert model.word_scores[model.word_at["the"]].argmin() == 1
    assert model.predict("the the cats")[0] == "en" and model.predict("katzen matten")[0] == "de"
    unseen = model.unknown("thezz")
    assert unseen.argmin() == 1 and (model.unknown("中") == langid.PENALTY).all()
    assert model.predict("123 !")[0] == "und" and model.predict(None) == ("und", 0.0)
    assert model.predict("中")[0] == "de"  # a tie goes to the first language


def test_edges(edge, nothing):
    model = langid.fit(edge)
    found = {r.doc_id: r for r in langid.identify(edge, model).collect()}
    assert {i for i, r in found.items() if r.lang_pred == "und"} == {1, 2, 3, 7}
    kept = langid.accepted(edge, model, 0.0)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 5
    none = langid.fit(nothing)
    assert {r.lang_pred for r in langid.identify(edge, none).collect()} == {"und"}
    assert langid.identify(nothing, model).count() == 0
