import pytest


@pytest.fixture
def texts(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names clash with the operators' own."""

    def make(rows):
        kind = "doc_id long, text string, lang string, source string, row string, key int, fp string, size double, pattern string"
        return spark.createDataFrame([(i, t, "en", "s", "x", 1, "f", 0.5, "p") for i, t in rows], kind)

    return make


NASTY = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (4, "one"),
    (None, "no key at all"),
    (None, "no key at all"),
    (5, "é ü 漢字 \U0001f600 ### end."),
    (6, "word " * 60_000),
]


@pytest.fixture
def nasty(texts):
    return texts(NASTY)
