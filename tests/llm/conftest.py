import pytest

from packhouse.llm import work

DOCS = "doc_id long, text string"


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    return work.ship(spark)


@pytest.fixture
def frame(spark):
    """Documents from {id: text} or rows, with columns that clash with names the operators use."""

    def make(rows):
        rows = list(rows.items()) if isinstance(rows, dict) else list(rows)
        full = [(k, t, "en", "x", 7, "extra", 1) for k, t in rows]
        return spark.createDataFrame(full, DOCS + ", lang string, spans string, n_words int, anchor string, score int")

    return make
