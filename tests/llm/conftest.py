import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Builds a documents table; rows may be (id, text) or whole."""
    def build(rows, schema=DOCS):
        return spark.createDataFrame([tuple(r) + (None,) * (5 - len(r)) if schema == DOCS else r for r in rows], schema)

    return build
