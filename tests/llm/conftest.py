import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs or whole rows, in two partitions."""

    def make(rows):
        full = [(r + ("en", "src0", len(r[1] or "")))[:5] if len(r) < 5 else r for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(full, schema).repartition(2)

    return make
