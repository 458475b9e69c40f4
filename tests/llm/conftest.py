import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents table of (doc_id, text[, lang]) tuples."""
    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1]) if r[1] else None) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return build
