import json

from pyspark.sql import functions as F

from pageflow.operators import spikes
from pageflow.operators.alerts import to_alert_json
from pageflow.sources.samples import page_creates
from tests.conftest import at


def test_four_pages_of_a_cold_domain_are_a_spike_and_three_are_not(events):
    rows = events(*[(f"10:56:0{n}", "u", False, "cold") for n in range(4)],
                  *[(f"10:56:0{n}", "u", False, "cool") for n in range(3)])
    row, = spikes.activity_spikes(rows).collect()
    assert (row.domain, row.pages_last_5min, row.avg_pages_per_5min, row.spike_ratio) == ("cold", 4, 1.0, 4.0)
    assert (row.window_start, row.window_end) == (at("10:00:00"), at("11:00:00"))
    assert row.sample_pages == [f"Title {n}" for n in range(4)]


def test_baseline_is_the_mean_of_the_other_slides(events):
    earlier = [(f"10:{m:02}:00", "u", False, "d") for m in range(0, 55, 5) for _ in range(2)]
    recent = [(f"10:56:{n:02}", "u", False, "d") for n in range(7)]
    found = spikes.activity_spikes(events(*earlier, *recent)).where(F.col("window_end") == at("11:00:00"))
    row, = found.collect()
    assert (row.pages_last_1hour, row.avg_pages_per_5min, row.spike_ratio) == (29, 2.0, 3.5)
    assert len(row.sample_pages) == 5
    assert found.sparkSession is not None
    high = spikes.activity_spikes(events(*earlier, *recent), min_baseline=4)
    assert high.where(F.col("window_end") == at("11:00:00")).count() == 0


def test_message(events):
    rows = events(*[("10:56:00", "u", False, "d", f"T{n}") for n in range(6)])
    message = json.loads(to_alert_json(spikes.spike_alerts(spikes.activity_spikes(rows))).first().value)
    assert message == {
        "alert_time": "2024-03-01 11:00:00", "alert_type": "activity_spike", "domain": "d", "pages_last_5min": 6,
        "avg_pages_per_5min": 1.0, "spike_ratio": 6.0, "sample_pages": ["T0", "T1", "T2", "T3", "T4"]}


def test_namespaces_can_be_left_out(events):
    rows = events(*[("10:56:00", "u", False, "d", f"File:{n}") for n in range(9)])
    assert spikes.activity_spikes(rows).count() == 1
    assert spikes.activity_spikes(rows, exclude_namespaces=("File", "User")).count() == 0


def test_equal_to_the_array_form(spark):
    rows = page_creates(spark.read.parquet("/root/testdata/sf0.01/events.parquet"))
    gathered = rows.groupBy(F.window("event_time", "12 hours", "1 hour"), "domain").agg(
        F.count("page_title").alias("pages"), F.collect_list("event_time").alias("times"))
    recent = F.size(F.filter("times", lambda t: t >= F.col("window.end") - F.expr("interval 1 hour")))
    expected = sorted(map(tuple, gathered.select(
        "domain", "window.start", "window.end", "pages", recent).collect()))
    columns = ["domain", "window_start", "window_end", "pages_last_1hour", "pages_last_5min"]
    batch = spikes.activity_spikes(rows, "12 hours", "1 hour", None)
    assert sorted(map(tuple, batch.select(columns).collect())) == expected


def test_counts_above_the_range_of_int(spark):
    many = spark.sql("""select 'd' as domain, timestamp'2024-03-01 10:00:00' as window_start,
        timestamp'2024-03-01 11:00:00' as window_end, 9000000000 as pages, 3000000000 as recent""")
    row, = spikes.score_spikes(many, 12, None).collect()
    assert (row.pages_last_1hour, row.pages_last_5min) == (9000000000, 3000000000)
