import pytest


@pytest.fixture()
def docs_of(spark):
    """Documents of (id, text) pairs with the other columns filled in."""

    def make(rows):
        full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make


@pytest.fixture()
def by_id():
    """Rows as a dict by their first column."""
    return lambda df: {r[0]: r for r in df.collect()}
