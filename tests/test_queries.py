"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from tests import oracle
from workloads.registry import ORACLES, QUERIES

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with oracle.connect(TABLES) as connected:
        yield connected


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, connection, name):
    query, sql = QUERIES[name], ORACLES[name]
    assert oracle.compare(spark, connection, query, sql, TABLES) == []


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_module.queries().keys()
