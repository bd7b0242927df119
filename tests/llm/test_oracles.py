import pytest
from lakeshore.llm import queries

from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    assert compare(spark, sf, queries.QUERIES[name], queries.ORACLES[name])
