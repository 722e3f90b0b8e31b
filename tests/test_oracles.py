"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare, connect
from conftest import SF
from tidemark.plans.catalogue import QUERIES
from tidemark.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    message = compare(spark, con, SF, name, QUERIES[name], ORACLES[name])
    assert message.startswith("ok"), message


def test_entry(spark):
    assert entry.entry(spark).columns == ["seq", "symbol", "field", "value", "type", "threshold", "actual"]
