"""Every catalog query against its SQL form."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from voxloom.plans import catalog, catalog_sql

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert {query.__name__ for query in catalog.QUERIES} == set(catalog_sql.SQL)


@pytest.mark.parametrize("name", sorted(catalog_sql.SQL))
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
