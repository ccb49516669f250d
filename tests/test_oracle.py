"""Every query with SQL runs against DuckDB on sf0.001 (the driver uses sf0.01)."""
import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

# the llm queries have tests of their own
OWN = set(entry.queries()) - set(entry.LLM_QUERIES)
SQL_QUERIES = sorted(OWN & set(entry.oracle_sql()))
ROWS_ONLY = sorted(OWN - set(SQL_QUERIES))

@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_query_matches_sql(spark, sf_small, con, name):
    r = compare(spark, name, sf_small, con)
    assert r["status"] == "match", r


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, sf_small, name):
    df = entry.queries()[name](spark, sf_small)
    assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and df.columns == ["r2", "rmse", "n"]
