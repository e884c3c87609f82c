"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from workload import catalog, oracle

QUERIES, SQL = catalog.QUERIES, oracle.ORACLE


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, QUERIES[name], SQL[name]) is None
