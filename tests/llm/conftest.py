import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text) pairs."""
    def make(rows, partitions=3):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, SCHEMA)
        return df.repartition(partitions) if full else df
    return make
