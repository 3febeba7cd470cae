"""Every registered query against its SQL, run by another engine over the same tables."""

import pytest

import __spark_entry__ as registry
from pageflow.plans import checks, oracle
from tests.compare import TABLES, assert_same, connection

SF = str(TABLES / "sf0.001")


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_same_as_sql(spark, con, name):
    assert_same(checks.registered()[name](spark, SF), con, oracle.statements()[name])


@pytest.mark.parametrize("name", ["domain_activity", "domain_activity_sketch", "domain_activity_from_sketches"])
def test_sketches_are_close_on_more_rows_too(spark, name):
    larger = str(TABLES / "sf0.01")
    assert_same(checks.registered()[name](spark, larger), connection(larger), oracle.statements()[name])


def test_every_query_has_sql_and_is_registered():
    assert set(checks.registered()) == set(oracle.statements())
    assert set(checks.registered()) <= set(registry.queries())
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry_runs(spark):
    assert registry.entry(spark).limit(1).count() == 1
