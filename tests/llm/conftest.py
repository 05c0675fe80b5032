import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture(scope="session")
def docs(spark):
    """doc_id, text rows to a table of documents."""

    def make(rows, extra=""):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        full = [(d, t, "en", "s", None if t is None else len(t)) for d, t in rows]
        df = spark.createDataFrame(full, schema)
        return df.selectExpr("*", *extra) if extra else df

    return make
