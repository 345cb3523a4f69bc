"""Every query against its SQL on the smallest tables, and the driver's entry points."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from tests.compare import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_as_sql(spark, connection, name):
    found = compare(spark, connection, SF_DIR, contract.queries()[name], contract.oracle_sql()[name])
    assert found is None, found


def test_entry_gives_rows(spark):
    assert not contract.entry(spark).isEmpty()


def test_every_sql_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
