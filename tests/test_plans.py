"""What the plans of the registered queries must and must not contain."""

import time
from datetime import datetime

import pytest

from pageflow.operators.reports import hourly_report
from pageflow.plans import checks
from tests.conftest import plan_of

SF = "/root/testdata/sf0.001"
WRITTEN = ("stream_", "archive_", "stored_", "editor_patterns_incremental")
BATCH = [name for name in checks.registered() if not name.startswith(WRITTEN)]


@pytest.fixture
def plan(spark, monkeypatch):
    """A function giving a query's plan as for tables too large to broadcast."""
    from pageflow import session

    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    monkeypatch.setattr(session, "CONF", {**session.CONF, **settings})
    yield lambda name: plan_of(checks.registered()[name](spark, SF))
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_products_no_single_partition_and_no_unused_columns(plan, name):
    text = plan(name)
    for unwanted in ("Python", "CartesianProduct", "NestedLoop", "SinglePartition", "props:string", "value:double"):
        assert unwanted not in text


@pytest.mark.parametrize("name, scans", [
    ("bot_activity", 1), ("hourly_report_history", 1), ("domain_trend", 1), ("editor_patterns", 1),
    ("bot_spam", 1), ("activity_spikes", 2), ("spam_alert_messages", 2)])
def test_number_of_scans(plan, name, scans):
    text = plan(name)
    assert text.count("FileScan") == scans
    assert ("ReusedExchange" in text) == (name in (
        "bot_activity", "hourly_report_history", "spam_alert_messages", "activity_spikes"))


def test_ranks_are_cut_before_their_shuffle(plan):
    for name in ("bot_activity", "hourly_report_history", "hourly_top_authors", "activity_spikes"):
        assert "Partial" in plan(name) and "WindowGroupLimit" in plan(name)


def test_a_stored_key_is_read_from_its_bucket(plan, spark):
    text = plan("stored_user_pages")
    assert "bucket" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_titles_are_sorted_only_where_there_are_spikes(plan):
    """Under the partial limit of the ranking there is a join with the spikes' last slides."""
    text = plan("activity_spikes")
    assert "Join" in text.split("WindowGroupLimit")[-1]


def test_times_without_a_zone_are_in_the_session_zone(events, monkeypatch):
    rows = events(("09:30:00", "a", False, "d"), ("10:30:00", "a", False, "d"))
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        found = hourly_report(rows, datetime(2024, 3, 1, 10, 40), hours=1)
        assert [r.hour for r in found.selectExpr("hour(time_start) as hour").collect()] == [9]
    finally:
        monkeypatch.undo()
        time.tzset()
