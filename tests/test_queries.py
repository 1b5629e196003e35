"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from strataload.plans import oracle
from strataload.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert SQL.keys() == QUERIES.keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF_DIR, QUERIES[name], SQL[name]) is None


def test_entry_has_rows(spark):
    assert not contract.entry(spark).isEmpty()
