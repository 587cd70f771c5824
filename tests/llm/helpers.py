"""Small corpora for the tests."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["kept", "size", "spans", "mark", "component_id", "n_words", "score", "lang_pred", "node", "ids", "redacted", "copies", "shard", "doc"]


def words(seed, n, vocabulary=400):
    pick = random.Random(seed)
    return [f"w{pick.randrange(vocabulary)}{'aeiou'[pick.randrange(5)]}" for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, len(t or "")) for i, t, lang, source in rows], DOCUMENTS).repartition(3)
