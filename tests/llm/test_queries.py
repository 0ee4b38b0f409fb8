"""The queries with a SQL form against it, and what is registered."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from tests.llm.helpers import SF
from voxloom.llm import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(SF), entry.queries()[name], entry.oracle_sql()[name], SF) is None


def test_all_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert "pipeline" in entry.queries()
