import pytest


@pytest.fixture
def documents(spark):
    """A frame of documents with an extra column, from ``(doc_id, text)`` rows."""

    def make(data):
        frame = spark.createDataFrame([(i, t, "x") for i, t in data], "doc_id long, text string, node string")
        return frame.repartition(3) if data else frame

    return make


EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one"),
    (4, "one"),
    (None, "no id here"),
    (5, "Größe 漢字 😀 \x00 <|endoftext|> <s>"),
    (6, "word " * 3000),
    (7, "a\x1cb\x85c d"),
]


@pytest.fixture
def edges(documents):
    return documents(EDGES)
