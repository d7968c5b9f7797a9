"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import QUERIES
from conftest import SMALL


@pytest.fixture(scope="module")
def database():
    return connect(SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_contract_has_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    assert contract.entry(spark).count() == 5334


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, database, name):
    assert compare(QUERIES[name](spark, SMALL), database, ORACLES[name]) == ""
