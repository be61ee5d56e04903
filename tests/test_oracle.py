"""Every registered query against its DuckDB oracle (rows, names, values)."""

import pytest

import __spark_entry__ as E
from fareflow.registry import QUERIES
from oracle.sql import QUERIES as ORACLE
from oracle_compare import compare, duck

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert r["status"] == "OK", r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["date_key", "date", "total_trips"]
