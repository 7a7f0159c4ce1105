import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text) pairs, with columns whose names clash."""

    def make(rows, extra=True):
        full = [
            (doc_id, text, "en", "src", len(text) if text is not None else None)
            for doc_id, text in rows
        ]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            df = df.selectExpr("*", "'x' AS spans", "1 AS score", "2 AS key", "3 AS node", "4 AS at")
        return df.repartition(3)

    return make


EDGES = [(None, None), (1, None), (2, ""), (3, " \n\t"), (4, "word"), (4, "word"), (None, "a b"),
         (5, "long " * 60_000), (6, "ß€😀 \x00 x")]


@pytest.fixture
def edge_rows():
    return list(EDGES)


@pytest.fixture
def edges(documents):
    """Nulls, empty, white and very long texts, repeated rows, odd characters."""
    return documents(EDGES)


@pytest.fixture
def nothing(documents):
    return documents([]).limit(0)
