"""Every registered query against its SQL at a small scale."""

import os

import pytest
from compare import duck, same

import __spark_entry__ as entry
from bindings.oracles import ORACLES
from bindings.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert same(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [r.hour for r in rows] == list(range(24))
