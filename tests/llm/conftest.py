import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A DataFrame of documents from (doc_id, text) or longer tuples."""
    def make(rows, schema="doc_id bigint, text string"):
        return spark.createDataFrame(rows, schema)
    return make
