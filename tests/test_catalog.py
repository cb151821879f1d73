"""Every registered query against its SQL counterpart, over whole tables."""

import os

import compare
import pytest

import __spark_entry__ as driver
from lapwise import catalog
from lapwise.catalog import race

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = catalog.ORACLES


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(ORACLES)
    assert set(catalog.QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, connection, name):
    columns, rows = compare.spark_rows(driver.queries()[name](spark, SF_DIR))
    expected_columns, expected_rows = compare.sql_rows(connection, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected_rows


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_race_states_are_read_from_written_messages(spark):
    """A filter over the events would work out the text of the message for each of its conditions."""
    plan = race.derive_race_status(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "event_type" not in plan and "round" not in plan
    assert "race_control-" in plan
