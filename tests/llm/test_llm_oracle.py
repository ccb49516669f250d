"""Every llm query with SQL runs against DuckDB on sf0.001."""
import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

from pricewise.llm.registry import ORACLE_SQL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, sf_small, name):
    r = compare(spark, name, sf_small, duck(sf_small))
    assert r["status"] == "match", r


def test_every_query_is_registered():
    found = entry.queries()
    assert all(any(q.startswith(f"op{n}_") for q in found) for n in range(1, 14)) and "pipeline" in found
