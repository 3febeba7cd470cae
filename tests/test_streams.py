"""Streams fed file by file end up equal to the batch operators."""

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pageflow.operators import bots, domains, spam, spikes, views
from pageflow.operators.clean import parse_events
from pageflow.plans.checks import HUMAN_SPAM, MESSAGES, METRICS, SPAM, SPIKES
from pageflow.schema import EVENTS, LANGUAGE_ACTIVITY, PAGES, SKETCHES, TABLE_KEYS
from pageflow.sources.files import file_source, read_archive
from pageflow.sources.samples import page_creates
from pageflow.streaming import jobs, sinks
from tests.conftest import at

NOW = {"availableNow": True}
STATS = "domain string, pages_count bigint, unique_authors bigint, avg_title_length double, last_updated timestamp"


@pytest.fixture(scope="module")
def batch(spark):
    return page_creates(spark.read.parquet("/root/testdata/sf0.001/events.parquet")).cache()


@pytest.fixture(scope="module")
def feed(spark, batch, tmp_path_factory):
    """A function giving the events as a stream of three files in the order of time."""
    path = str(tmp_path_factory.mktemp("feed"))
    cuts = [at("00:00:00", d) for d in ("2023-01-01", "2024-01-10", "2024-01-20", "2025-01-01")]
    for first, last in zip(cuts, cuts[1:]):
        batch.where(F.col("event_time").between(first, last)).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    return lambda: file_source(spark, path, EVENTS, files_per_trigger=1)


def rows(frame):
    columns = sorted(frame.columns)
    return sorted((tuple(r) for r in frame.select(columns).collect()), key=repr)


def finished(query):
    query.awaitTermination()
    return query


def ignore(frame, batch_id):
    pass


def test_archive_keeps_everything_once_and_goes_on_after_a_restart(spark, batch, feed, folder):
    path, checkpoint = folder(), folder()
    for _ in range(2):
        finished(jobs.start_archive(feed().drop("page_id", "user_id"), path, checkpoint, **NOW))
    assert rows(read_archive(spark, path)) == rows(batch.drop("page_id", "user_id"))
    assert set(spark.read.parquet(path).columns) >= {"year", "month", "day"}


def test_unparsable_messages_are_archived_too(spark, folder):
    source, path = folder(), folder()
    spark.sql("""select * from values ('bad{', timestamp'2024-03-01 10:00:00'),
        ('{"page_title":"T"}', timestamp'2024-03-01 11:00:00') as t(value, timestamp)""").write.parquet(source)
    columns = ("page_title", "domain", "user_name", "user_is_bot")
    finished(jobs.start_archive(parse_events(file_source(spark, source), columns), path, folder(), **NOW))
    stored = read_archive(spark, path).orderBy("event_time").collect()
    assert [tuple(r) for r in stored] == [
        (None, None, None, None, at("10:00:00")), ("T", None, None, None, at("11:00:00"))]


def test_ingest_separates_rejects(spark, folder):
    source, kept, rejects = folder(), folder(), folder()
    spark.sql("""select * from values ('bad{', current_timestamp()), ('{"meta":{"domain":"d"}}', current_timestamp()),
        ('{"meta":{"domain":"canary"}}', current_timestamp()) as t(value, timestamp)""").write.parquet(source)
    finished(jobs.start_ingest(
        file_source(spark, source), sinks.table_sink(kept), sinks.table_sink(rejects), folder(), **NOW))
    row, = spark.read.parquet(kept).collect()
    assert (row.key, row.value) == ("d", '{"meta":{"domain":"d"}}')
    assert [r.value for r in spark.read.parquet(rejects).collect()] == ["bad{"]


def test_archive_gathers_a_backlog_by_day(spark, batch, feed, folder):
    path = folder()
    finished(jobs.start_archive(feed(), path, folder(), files_per_day=1, **NOW))
    files = spark.read.parquet(path).inputFiles()
    assert spark.read.parquet(path).count() == batch.count()
    days = batch.select(F.to_date("event_time")).distinct().count()
    assert days <= len(files) <= days + 2


def test_bot_activity_of_closed_windows(spark, batch, feed, folder):
    metrics, alerts = folder(), []
    finished(jobs.start_bot_activity(
        feed(), sinks.table_sink(metrics, "window_start"),
        lambda frame, _: alerts.extend(frame.collect()), folder(), "1 hour", threshold=20.0, **NOW))
    closed = batch.agg(F.max("event_time")).first()[0]
    expected = bots.bot_activity(batch, "1 hour").where(F.col("window_end") <= closed)
    stored = sinks.read_table(spark, metrics, METRICS, TABLE_KEYS["bot_activity_metrics"], "window_start")
    assert rows(stored) == rows(expected)
    assert sorted(map(tuple, alerts), key=repr) == sorted(
        map(tuple, bots.high_bot_alerts(expected, 20.0).collect()), key=repr)


def test_bot_spam_latest_counts(spark, batch, feed, folder):
    path = folder()
    finished(jobs.start_bot_spam(feed(), sinks.table_sink(path), folder(), "10 days", "1 day", 2, **NOW))
    stored = sinks.read_table(spark, path, SPAM, ["window_start", "domain", "bot_name"])
    assert rows(stored) == rows(bots.bot_spam(batch, "10 days", "1 day", 2))


def test_domain_activity_trend_and_latest(spark, batch, feed, folder):
    activity, stats = folder(), folder()
    finished(jobs.start_domain_activity(feed(), activity, stats, folder(), "1 day", **NOW))
    expected = domains.with_trend(domains.domain_activity(batch, "1 day"), "1 day")
    keys = TABLE_KEYS["language_activity"]
    assert rows(sinks.read_table(spark, activity, LANGUAGE_ACTIVITY, keys, "window_start")) == rows(expected)
    latest = sinks.read_table(spark, stats, STATS, TABLE_KEYS["domain_stats"], order=["last_updated"])
    assert rows(latest) == rows(domains.domain_latest(expected))

    compacted = folder()
    sinks.compact_table(spark, activity, compacted, LANGUAGE_ACTIVITY, keys, "window_start")
    again = sinks.read_table(spark, compacted, LANGUAGE_ACTIVITY, keys, "window_start")
    assert rows(again) == rows(expected)
    assert again.sparkSession.read.parquet(compacted).count() == expected.count()


def test_a_later_change_of_a_window_corrects_the_next_trend(spark, events, folder):
    source, activity, stats, checkpoint = folder(), folder(), folder(), folder()

    def run(*new):
        events(*new).coalesce(1).write.mode("append").parquet(source)
        query = jobs.start_domain_activity(
            file_source(spark, source, EVENTS), activity, stats, checkpoint, delay="1 hour", **NOW)
        finished(query)
        table = sinks.read_table(
            spark, activity, LANGUAGE_ACTIVITY, TABLE_KEYS["language_activity"], "window_start")
        return [r.trend_percent for r in table.orderBy("window_start").collect()]

    assert run(("10:00:00", "a", False, "d"), ("10:01:00", "a", False, "d"), ("10:01:01", "a", False, "d")) == [0.0, 100.0]
    assert run(("10:00:30", "a", False, "d")) == [0.0, 0.0]
    assert run(("10:02:30", "a", False, "d")) == [0.0, 0.0, -50.0]


def closed_by(spark, feed_rows, source):
    """Adds a page a year later to the files of `source`, as a file of its own."""
    last = feed_rows.orderBy(F.col("event_time").desc()).limit(1)
    late = last.select(*[
        F.lit("closing").alias(c) if c in ("domain", "user_name", "page_title") else F.lit(False).alias(c) if c == "user_is_bot"
        else (F.col(c) + F.expr("INTERVAL 366 DAYS")).alias(c) if c == "event_time" else F.col(c) for c in feed_rows.columns])
    late.write.mode("append").parquet(source)


@pytest.fixture(scope="module")
def closed_feed(spark, batch, tmp_path_factory):
    """The feed with a last file that lets the watermark close all windows before."""
    path = str(tmp_path_factory.mktemp("closed"))
    for part in (batch.where("event_time < '2024-01-15'"), batch.where("event_time >= '2024-01-15'")):
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    closed_by(spark, batch, path)
    return lambda: file_source(spark, path, EVENTS, files_per_trigger=1)


def test_spam_alerts_as_windows_fill(spark, batch, feed, folder):
    path = folder()
    finished(jobs.start_spam_alerts(feed(), sinks.table_sink(path), folder(), "1 day", rules={"velocity": 3}, **NOW))
    expected = spam.spam_alerts(batch, "1 day", velocity=3)
    assert rows(sinks.read_table(spark, path, HUMAN_SPAM, ["window_start", "user_name"])) == rows(expected)


def test_spam_messages_have_all_their_titles_once(spark, batch, closed_feed, folder):
    path = folder()
    finished(jobs.start_spam_messages(
        closed_feed(), sinks.table_sink(path), folder(), "1 day", rules={"velocity": 3}, part_size=2, salts=3, **NOW))
    expected = spam.spam_alerts(batch, "1 day", velocity=3)
    whole = spam.spam_messages(expected, spam.spam_titles(batch, expected, "1 day", part_size=2), part_size=2)
    stored = sinks.read_rows(spark, path, MESSAGES).drop(sinks.BATCH)
    assert rows(stored) == rows(whole)
    titled = stored.groupBy("alert_time", "user_name").agg(
        F.sum(F.size("titles")).alias("titles"), F.max("page_count").alias("pages"))
    assert titled.where("titles <> pages").count() == 0


def test_alerts_are_copied_only_to_tasks_with_their_pages(batch, closed_feed, folder):
    query = finished(jobs.start_spam_messages(closed_feed(), sinks.table_sink(folder()), folder(), "1 day", salts=16, **NOW))
    joined = sum(o["numRowsUpdated"] for p in query.recentProgress for o in p["stateOperators"] if o["operatorName"] == "symmetricHashJoin")
    pages = spam.human_pages(batch).count()
    assert pages < joined <= 2 * (pages + 1)


def test_pages_later_than_the_watermark_make_no_spam_and_are_counted(spark, events, folder):
    source, path, messages = folder(), folder(), folder()
    # What is late for a micro-batch was settled by the one before the last.
    parts = [
        [("10:00:00", "a", False, "d", "http://x")], [("10:30:00", "a", False, "d", "www.x")], [("10:30:01", "c", False, "d")],
        [("10:00:01", "a", False, "d", "late 1234567"), ("10:29:59", "b", False, "d", "http://in time")], [("12:00:00", "z", False, "d")]]
    for part in parts:
        events(*part).coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)

    def stream():
        return file_source(spark, source, EVENTS, files_per_trigger=1)

    query = finished(jobs.start_spam_alerts(stream(), sinks.table_sink(path), folder(), **NOW))
    assert jobs.dropped_late_rows(query) == 1
    kept = events(*parts[0], *parts[1], *parts[2], parts[3][1], *parts[4])
    expected = spam.spam_alerts(kept)
    assert rows(sinks.read_table(spark, path, HUMAN_SPAM, ["window_start", "user_name"])) == rows(expected)
    query = finished(jobs.start_spam_messages(stream(), sinks.table_sink(messages), folder(), **NOW))
    assert jobs.dropped_late_rows(query) >= 1
    stored = sinks.read_rows(spark, messages, MESSAGES)
    assert sorted(t for r in stored.collect() for t in r.titles) == ["http://in time", "http://x", "www.x"]


def test_spikes_latest_windows(spark, batch, feed, folder):
    path, titles = folder(), folder()
    finished(jobs.start_first_titles(feed(), titles, folder(), "1 hour", **NOW))
    finished(jobs.start_activity_spikes(
        feed(), sinks.table_sink(path), titles, folder(), "12 hours", "1 hour", None, **NOW))
    stored = sinks.read_table(spark, path, SPIKES, ["domain", "window_start"])
    assert rows(stored) == rows(spikes.activity_spikes(batch, "12 hours", "1 hour", None))


def test_samples_that_come_later_are_there_when_spikes_are_read(spark, batch, feed, folder):
    path, titles = folder(), folder()
    finished(jobs.start_activity_spikes(feed(), sinks.table_sink(path), titles, folder(), "12 hours", "1 hour", **NOW))
    stored = sinks.read_table(spark, path, SPIKES, ["domain", "window_start"])
    assert {tuple(r.sample_pages) for r in stored.collect()} == {()}
    finished(jobs.start_first_titles(feed(), titles, folder(), "1 hour", **NOW))
    expected = spikes.activity_spikes(batch, "12 hours", "1 hour")
    columns = expected.columns
    assert rows(jobs.sampled_spikes(stored, titles, "1 hour").select(columns)) == rows(expected)


def test_closed_spikes_come_once_and_equal_the_batch(spark, batch, closed_feed, folder):
    path, titles = folder(), folder()
    finished(jobs.start_first_titles(closed_feed(), titles, folder(), "1 hour", **NOW))
    finished(jobs.start_closed_spikes(closed_feed(), sinks.table_sink(path), titles, folder(), "12 hours", "1 hour", None, **NOW))
    stored = sinks.read_rows(spark, path, SPIKES).drop(sinks.BATCH).where("domain <> 'closing'")
    assert rows(stored) == rows(spikes.activity_spikes(batch, "12 hours", "1 hour", None))


def test_pages_late_for_some_windows_count_in_the_others(spark, events, folder):
    """The last micro-batch holds a page too late for any window, and one late for some windows only."""
    source, path, titles = folder(), folder(), folder()
    first = [("10:00:00", "a", False, "d", "T1")]
    second = [("12:00:00", "a", False, "d", "T2"), ("12:00:01", "a", False, "d", "T0")]
    other = [("12:00:01", "a", False, "e", "E")]
    third = [("10:30:00", "a", False, "d", "late"), ("11:30:00", "a", False, "d", "T3"), ("12:01:00", "a", False, "d", "T4")]
    for part in (first, second, other, third):
        events(*part).coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)

    def stream():
        return file_source(spark, source, EVENTS, files_per_trigger=1)

    finished(jobs.start_first_titles(stream(), titles, folder(), **NOW))
    query = finished(jobs.start_activity_spikes(stream(), sinks.table_sink(path), titles, folder(), threshold=None, **NOW))
    # The watermark is 11:55:01: late for all twelve windows, and for those five that end before.
    assert jobs.dropped_late_rows(query) == 12 + 5
    kept = spikes.activity_spikes(events(*first, *second, *other, *third[1:]), threshold=None)
    stored = sinks.read_table(spark, path, SPIKES, ["domain", "window_start"])
    open_ = F.col("window_end") > F.lit(at("11:55:01"))
    assert rows(stored.where(open_)) == rows(kept.where(open_))
    newest = stored.where((F.col("window_end") == F.lit(at("12:05:00"))) & (F.col("domain") == "d")).first()
    assert (newest.pages_last_1hour, newest.pages_last_5min, newest.sample_pages) == (4, 3, ["T2", "T0", "T4"])


def test_trend_of_closed_windows_by_a_join_of_streams(spark, batch, closed_feed, events, folder):
    path = folder()
    finished(jobs.start_domain_trend(closed_feed(), sinks.table_sink(path), folder(), "1 day", **NOW))
    expected = domains.with_trend(domains.domain_activity(batch, "1 day"), "1 day")
    stored = sinks.read_rows(spark, path, LANGUAGE_ACTIVITY).drop(sinks.BATCH).where("domain <> 'closing'")
    assert rows(stored) == rows(expected)
    assert stored.where("trend_percent is null").count() == 0


def test_state_has_two_partitions_a_core_at_most(spark, events, folder):
    source, cores, was = folder(), spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    events(("10:00:00", "a", False, "d"), ("10:05:00", "a", False, "d")).coalesce(1).write.parquet(source)
    try:
        for asked, given in ((2 * cores + 1, 2 * cores), (3, 3)):
            spark.conf.set("spark.sql.shuffle.partitions", asked)
            query = finished(jobs.start_domain_trend(file_source(spark, source, EVENTS), ignore, folder(), **NOW))
            assert {o["numShufflePartitions"] for p in query.recentProgress for o in p["stateOperators"]} == {given}
            assert spark.conf.get("spark.sql.shuffle.partitions") == str(asked)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_stored_sketches_make_longer_windows(spark, batch, closed_feed, folder):
    path = folder()
    finished(jobs.start_domain_sketches(closed_feed(), sinks.table_sink(path, "window_start"), folder(), **NOW))
    minutes = sinks.read_rows(spark, path, SKETCHES, "window_start").where("domain <> 'closing'")
    for window in ("1 hour", "1 day", "10 days"):
        assert rows(domains.activity_of_sketches(minutes, window)) == rows(domains.domain_activity(batch, window, exact=True))


def test_file_sink_adds_no_row_twice(spark, batch, feed, folder):
    path, checkpoint = folder(), folder()
    for _ in range(2):
        finished(jobs.start_archive_files(feed().drop("page_id", "user_id"), path, checkpoint, **NOW))
    # A file that no finished micro-batch wrote is not read.
    batch.limit(5).drop("page_id", "user_id").coalesce(1).write.mode("append").parquet(f"{path}/year=2024/month=1/day=1")
    stored = spark.read.parquet(path)
    assert rows(stored.drop("year", "month", "day")) == rows(batch.drop("page_id", "user_id"))
    assert "_spark_metadata" in " ".join(str(p) for p in Path(path).iterdir())
    assert stored.where("day = 3").select("day").distinct().collect()[0].day == 3


def test_views_and_a_repeated_batch(spark, batch, feed, folder):
    paths = {name: folder() for name in views.VIEWS}
    targets = {name: sinks.table_sink(path, "created_at" if "by" in name else None) for name, path in paths.items()}

    def twice(sink):
        def write(frame, batch_id):
            sink(frame, batch_id)
            sink(frame, batch_id)

        return write

    finished(jobs.start_views(feed(), {n: twice(s) for n, s in targets.items()}, folder(), **NOW))
    pages = views.listed_pages(batch)
    for name, view in views.VIEWS.items():
        raw = spark.read.parquet(paths[name])
        assert raw.count() == pages.count()
        table = sinks.read_table(
            spark, paths[name], PAGES[name], TABLE_KEYS[name], "created_at" if "by" in name else None)
        assert rows(table) == rows(view(pages))


def test_rows_later_than_the_watermark_are_dropped_and_counted(spark, events, folder):
    source = folder()
    for time_, user in (("10:00:00", "a"), ("10:30:00", "a"), ("10:31:00", "a"), ("10:00:10", "late"), ("10:40:00", "a")):
        events((time_, user, True, "d")).coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)
    path = folder()
    query = finished(jobs.start_bot_activity(
        file_source(spark, source, EVENTS, files_per_trigger=1), sinks.table_sink(path), ignore, folder(), **NOW))
    assert jobs.dropped_late_rows(query) == 1
    stored = sinks.read_table(spark, path, METRICS, TABLE_KEYS["bot_activity_metrics"])
    assert [r.top_bots for r in stored.orderBy("window_start").collect()] == [["a"]] * 3


def test_alert_messages(spark, events, folder):
    source, sent = folder(), []
    rows_ = [(f"10:00:{n:02}", "bot", True, "d") for n in range(51)]
    events(*rows_).coalesce(1).write.parquet(source)
    sink = sinks.formed(lambda frame, _: sent.extend(frame.toJSON().collect()), bots.bot_spam_alerts)
    finished(jobs.start_bot_spam(file_source(spark, source, EVENTS), sink, folder(), **NOW))
    assert len(sent) == 10
    assert {json.loads(m)["pages_created"] for m in sent} == {51}


def test_a_failing_query_stops_the_others(spark, feed, folder):
    def fail(frame, batch_id):
        raise ValueError("sink")

    spark.streams.resetTerminated()
    steady = jobs.start_views(feed(), {}, folder())
    jobs.start_views(feed(), {"page_details": fail}, folder())
    with pytest.raises(Exception, match="sink"):
        jobs.run_until_any_stops(spark)
    assert not steady.isActive
    spark.streams.resetTerminated()
