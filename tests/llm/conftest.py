import pytest


@pytest.fixture
def docs(spark):
    """Documents from texts, ids counting from 0; rows may also be given whole."""

    def make(texts, lang="en"):
        rows = [(i, text, lang, "s", len(text or "")) for i, text in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")

    return make
