"""The documents fixture of the text operators' tests."""

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """DataFrame of (doc_id, text) rows with extra columns of clashing names."""
    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for name in ("n_tokens", "score", "n_words", "word", "run", "keys", "copy", "bucket", "path", "rule"):
            df = df.selectExpr("*", f"'x' AS {name}")
        return df
    return make
