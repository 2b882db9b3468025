import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text[, lang, source]) rows."""

    def make(rows, extra=""):
        full = []
        for row in rows:
            doc_id, text, lang, source, *more = (*row, *[None] * (4 - len(row)))
            full.append((doc_id, text, lang, source, len(text or ""), *more))
        return spark.createDataFrame(full, DOCUMENT + extra)

    return make
