"""The documents fixture of this folder's tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture
def docs(spark):
    """Make a documents table from (doc_id, text, source) rows, with a column of a clashing name."""

    def make(rows, extra=True):
        full = [(k, t, "en", s, None if t is None else len(t), 7) for k, t, s in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, component_id int"
        df = spark.createDataFrame(full, schema)
        return df if extra else df.drop("component_id")

    return make
