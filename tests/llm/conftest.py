import pytest

from tests.llm.helpers import CLASHING, DOCUMENTS, frame, words


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and blank texts, a long one, ties, repeated rows, clashing column names."""
    long = " ".join(words(1, 40_000)) + "x" * 70_000
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", None),
        (3, " \n\t ", None, "a"),
        (4, long, "en", "b"),
        (5, "one two three", "de", "b"),
        (6, "one two three", None, None),
        (7, "7 + 8 = 15 !!!", "en", "a"),
        (7, "7 + 8 = 15 !!!", "en", "a"),
        (8, "naïve ünïcode 😀 text, mail a.b@c.de 10.0.0.1", "de", "b"),
        (None, "a text without an id", "en", "a"),
        (9, " ".join(words(2, 60)), "de", "a"),
        (10, " ".join(words(2, 60)), "de", "a"),
    ]
    base = frame(spark, rows)
    for name in CLASHING:
        base = base.withColumn(name, base.doc_id)
    return base.cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
