from pyspark.sql import functions as F

from pageflow.operators import domains
from pageflow.sources.samples import page_creates


def test_pages_authors_and_title_length(events):
    rows = events(
        ("10:00:01", "a", False, "d", "xx"), ("10:00:02", "a", False, "d", "xxxxx"),
        ("10:00:03", None, False, "d", "xxx"), ("10:00:04", "b", False, None))
    row, = domains.domain_activity(rows).collect()
    assert (row.pages_count, row.unique_authors, row.avg_title_length) == (3, 1, 3.33)


def test_trend_looks_exactly_one_window_back(events):
    def pages(minute, count):
        return [(f"10:{minute}:{n:02}", "u", False, "d") for n in range(count)]

    activity = domains.domain_activity(events(*pages("00", 4), *pages("01", 3), *pages("03", 6)), exact=True)
    expected = [("4", 0.0), ("3", -25.0), ("6", 0.0)]
    for trend in (domains.with_trend(activity), domains.with_trend(activity, previous=activity)):
        rows = trend.orderBy("window_start").collect()
        assert [(str(r.pages_count), r.trend_percent) for r in rows] == expected


def test_an_empty_previous_window_gives_zero(spark):
    schema = "domain string, window_start timestamp, pages_count int"
    times = spark.sql("select timestamp'2024-03-01 10:00:00' a, timestamp'2024-03-01 10:01:00' b").first()
    earlier = spark.createDataFrame([("d", times.a, 0)], schema)
    later = spark.createDataFrame([("d", times.b, 5)], schema)
    assert domains.with_trend(later, previous=earlier).first().trend_percent == 0.0
    assert domains.with_trend(later, previous=earlier.limit(0)).first().trend_percent == 0.0


def test_latest_window_wins(events):
    rows = events(("10:00:01", "a", False, "d"), ("10:00:02", "a", False, "d"), ("10:05:00", "b", False, "d"))
    row, = domains.domain_latest(domains.domain_activity(rows)).collect()
    assert (row.pages_count, row.last_updated.minute) == (1, 6)


def test_sketch_is_close(spark):
    rows = page_creates(spark.read.parquet("/root/testdata/sf0.01/events.parquet"))
    both = domains.domain_activity(rows, "10 days").join(
        domains.domain_activity(rows, "10 days", exact=True).withColumnRenamed("unique_authors", "exact"),
        ["domain", "window_start"])
    worst = both.agg(F.max(F.abs(F.col("unique_authors") / F.col("exact") - 1))).first()[0]
    assert worst < 0.15
