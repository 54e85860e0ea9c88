"""Every registered query against its SQL form on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import difference, duck
from seatledger.plans.oracles import oracles
from seatledger.plans.registry import all_queries

QUERIES = all_queries()
SQL = oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_entry_is_stable(spark):
    df = contract.entry(spark)
    assert df.columns == ["restaurant_name", "completion_ratio"]
    assert df.count() == 3
