import pytest


@pytest.fixture(scope="session")
def texts(spark):
    """Rows (doc_id, text) as a table with columns that clash with the operators' own names."""
    def make(rows):
        return spark.createDataFrame(
            [(k, t, "left alone", 7) for k, t in rows], "doc_id long, text string, note string, n_tokens int"
        )
    return make
