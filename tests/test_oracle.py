"""Every registered query against its SQL twin, and the driver's contract."""

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry
from gridloom.catalog.oracle import ORACLE
from gridloom.catalog.queries import REGISTERED


@pytest.fixture(scope="module")
def database(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(REGISTERED) == set(ORACLE)
    assert set(REGISTERED) <= set(entry.queries())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query_equals_sql(spark, database, sf_dir, name):
    assert compare(spark, database, sf_dir, name) is None
