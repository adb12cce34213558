"""Every registered query against its reference SQL on the smallest supplied tables."""

import pytest

import __spark_entry__ as contract
from checks import oracle
from checks.compare import connect, difference
from merchlake import catalog

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.QUERIES, oracle.all_sql()


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    assert difference(spark, tables, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
