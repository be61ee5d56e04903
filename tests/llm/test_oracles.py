"""Queries that SQL can express, against DuckDB on the same tables."""

import pytest

from fareflow.llm.queries import ORACLE, QUERIES
from oracle_compare import compare, duck

from conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert r["status"] == "OK", r
