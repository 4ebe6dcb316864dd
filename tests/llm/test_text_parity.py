"""Every text query that has SQL against it; the larger scale is checked by `python tests/oracle.py`."""

import pytest

from oracle import compare, connect
from relstream.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(name for name, query in QUERIES.items() if query.sql))
def test_query(spark, con, sf, name):
    assert compare(spark, con, sf, QUERIES[name].build, QUERIES[name].sql) is None
