import json

import pytest
from pyspark.sql import functions as F

from pageflow.functions import sliding
from pageflow.functions.sliding import sliding_counts
from pageflow.operators import bots
from pageflow.operators.alerts import to_alert_json
from pageflow.sources.samples import page_creates
from tests.conftest import at, plan_of


def test_counts_percentage_and_top_users(events):
    rows = events(
        ("10:00:01", "bot", True, "d"), ("10:00:02", "bot", True, "d"), ("10:00:59", "ann", False, "d"),
        ("10:01:00", "bob", False, "d"), ("10:00:30", None, True, "d"), ("10:00:30", "eve", False, None))
    first, second = bots.bot_activity(rows).orderBy("window_start").collect()
    assert (first.human_count, first.bot_count, first.bot_percentage) == (1, 2, 66.67)
    assert (first.top_humans, first.top_bots) == (["ann"], ["bot"])
    assert (first.window_start, first.window_end) == (at("10:00:00"), at("10:01:00"))
    assert (second.bot_percentage, second.top_bots, second.top_humans) == (0.0, None, ["bob"])


def test_unknown_flags_count_for_neither(events):
    row, = bots.bot_activity(events(("10:00:01", "a", None, "d"), ("10:00:02", "b", None, "d"))).collect()
    assert (row.human_count, row.bot_count, row.bot_percentage) == (0, 0, None)
    assert row.top_bots is None and row.top_humans is None
    shares, = bots.bot_shares(events(("10:00:01", "a", None, "d"))).collect()
    assert (shares.human_count, shares.bot_count, shares.bot_percentage) == (0, 0, None)


def test_ties_at_the_cut_go_by_name(events):
    rows = events(*[("10:00:01", name, False, "d") for name in "fbdaec"], ("10:00:02", "f", False, "d"))
    row, = bots.bot_activity(rows).collect()
    assert row.top_humans == ["f", "a", "b", "c", "d"]
    row, = bots.bot_activity(rows, k=2).collect()
    assert row.top_humans == ["f", "a"]


def test_high_bot_alerts(events):
    rows = events(*[(f"10:00:0{n}", "bot", True, "d") for n in range(9)], ("10:00:30", "ann", False, "d"),
                  ("10:00:01", "x", True, "small"), *[("10:00:01", n, True, "even") for n in "abcd"],
                  ("10:00:01", "h", False, "even"))
    metrics = bots.bot_activity(rows)
    assert sorted(map(tuple, bots.bot_shares(rows).collect())) == sorted(
        map(tuple, metrics.drop("top_humans", "top_bots").collect()))
    assert {r.domain for r in bots.high_bot_alerts(metrics).collect()} == {"d", "small"}
    assert {r.domain for r in bots.high_bot_alerts(metrics, min_pages=5).collect()} == {"d"}
    assert {r.domain for r in bots.high_bot_alerts(metrics, 79.9).collect()} == {"d", "small", "even"}
    message = json.loads(to_alert_json(bots.high_bot_alerts(metrics, min_pages=5)).first().value)
    assert message == {
        "alert_time": "2024-03-01 10:01:00", "alert_type": "high_bot_activity", "domain": "d",
        "bot_percentage": 90.0, "bot_count": 9, "human_count": 1}


def test_more_than_fifty_pages_in_ten_minutes(events):
    def pages(user, count, bot=True):
        return [(f"10:0{n % 10}:00", user, bot, "d") for n in range(count)]

    rows = events(*pages("busy", 51), *pages("calm", 50), *pages("human", 60, bot=False))
    spam = bots.bot_spam(rows).collect()
    assert [(r.window_start, r.window_end, r.bot_name, r.pages_created) for r in spam] == [
        (at("10:00:00"), at("10:10:00"), "busy", 51)]
    message = json.loads(to_alert_json(bots.bot_spam_alerts(bots.bot_spam(rows))).first().value)
    assert message == {
        "alert_time": "2024-03-01 10:10:00", "alert_type": "bot_spam", "domain": "d",
        "bot_name": "busy", "pages_created": 51}


@pytest.mark.parametrize("window, slide", [
    ("10 minutes", "1 minute"), ("1 hour", "5 minutes"), ("10 days", "1 day"), ("1 hour", "1 hour")])
def test_sliding_counts_equal_the_expansion(spark, window, slide):
    rows = page_creates(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    rows = rows.unionByName(rows.withColumn("event_time", F.expr("timestamp'1969-12-31 23:58:30'")))
    expected = rows.groupBy(F.window("event_time", window, slide), "domain", "user_name").agg(
        F.count("*").alias("pages")).select(
        "domain", "user_name", "window.start", "window.end", "pages").where("pages > 1")
    wanted = sorted(map(tuple, expected.collect()))
    actual = sliding_counts(rows, ["domain", "user_name"], window, slide, above=1)
    assert sorted(map(tuple, actual.collect())) == wanted
    by_panes = sliding_counts(rows, ["domain", "user_name"], window, slide, above=1, method="panes")
    assert sorted(map(tuple, by_panes.collect())) == wanted


@pytest.mark.parametrize("above", [-1, 0, 2])
def test_wide_windows_write_only_what_they_return(spark, above):
    rows = spark.sql("""
        select case when id % 7 = 0 then null else 'd' || id % 3 end as domain, 'u' as user_name,
            timestamp_seconds(pmod(xxhash64(id % 150), 3600 * 800) - 3600 * 300) as event_time from range(200)
        union all select 'd0', 'u', timestamp'1970-01-11 00:00:00' union all select 'd0', 'u', null""")
    expected = rows.groupBy(F.window("event_time", "10 days", "1 hour"), "domain", "user_name").agg(
        F.count("*").alias("pages")).select("domain", "user_name", "window.start", "window.end", "pages").where(F.col("pages") > above)
    actual = sliding_counts(rows, ["domain", "user_name"], "10 days", "1 hour", above, method="panes")
    assert sorted(map(tuple, actual.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    # The windows are spelled out after the last shuffle.
    plan = plan_of(actual)
    assert plan.index("Generate explode(sequence") < plan.index("Exchange")


def test_window_must_be_whole_slides(events):
    with pytest.raises(ValueError):
        bots.bot_spam(events(("10:00:00", "a", True, "d")), "10 minutes", "3 minutes")


def test_ranking_is_cut_before_the_shuffle_and_the_counts_are_shuffled_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(bots.bot_activity(page_creates(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("row_number(), 5, Partial") == 1
    assert "ReusedExchange" in plan and plan.count("FileScan") == 1
