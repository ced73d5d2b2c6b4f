"""Every registered query against its SQL twin, whole results."""

from __future__ import annotations

import pytest
from oracle_check import compare, oracle_connection

from rillstone.plans import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir) == ""


def test_entry_is_the_hourly_table(spark):
    import __spark_entry__ as contract

    frame = contract.entry(spark)
    assert "bikes_occupied_hour" in frame.columns
    assert frame.count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
