import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Makes a documents table of (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows, schema=SCHEMA):
        full = [
            (row[0], row[1], row[2] if len(row) > 2 else "en", "src", len(row[1] or ""))
            for row in rows
        ]
        return spark.createDataFrame(full, schema)

    return make
