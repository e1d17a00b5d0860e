"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare, duckdb_for

import __spark_entry__ as entry_point
from chargeline.plans.oracle import ORACLE
from chargeline.plans.queries import REGISTRY as QUERIES


@pytest.fixture(scope="module")
def con():
    return duckdb_for(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry_point.entry(spark)
    rows = df.collect()
    assert df.columns == ["region", "total_revenue", "customer_count", "avg_revenue_per_customer"]
    assert len(rows) >= 1
