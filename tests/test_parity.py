"""Every named query against its SQL; the larger scale is checked by `python tests/oracle.py`."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from relstream.catalog.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES.keys() & entry.oracle_sql().keys()))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_every_core_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"event_type", "window_start", "window_end", "count"}
