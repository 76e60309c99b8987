"""Every registered query equals its DuckDB oracle (multiset of rows, exact values)."""

import pytest

import __spark_entry__ as E
from metroflux.plans import registry
from tests.conftest import SMOKE
from tests.oracle_check import compare, duck

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


def test_every_query_has_an_oracle():
    assert sorted(set(QUERIES) - set(ORACLE)) == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SMOKE)
    assert r["ok"], r.get("why")


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert "total_positions" in df.columns
    assert df.count() > 0
