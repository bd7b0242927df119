import pytest
from lakeshore import oracles, queries

from tests.oracle import compare


def test_each_query_has_sql():
    assert set(queries.QUERIES) == set(oracles.ORACLES)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, name):
    """At a size at which every query has rows."""
    assert compare(spark, "/root/testdata/sf0.01", queries.QUERIES[name], oracles.ORACLES[name])
