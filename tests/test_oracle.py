"""Every registered query with a SQL twin gives the same rows as the twin."""

import pytest
from compare import connect, difference
from settings import SF

import __spark_entry__ as entry_point
from flowlens.plans.catalog import REGISTRY

QUERIES, SQL = REGISTRY.queries, REGISTRY.sql


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() == 4
