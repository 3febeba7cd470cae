from datetime import timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException

from pageflow.operators.clean import parse_events
from pageflow.plans import checks
from pageflow.plans.batch import editor_patterns_job, hourly_report_job, run_job
from pageflow.session import scratch_dir
from pageflow.sources import topics
from pageflow.sources.files import file_source, read_archive, read_or_empty
from pageflow.sources.samples import page_creates, raw_messages
from pageflow.streaming import sinks
from pageflow.streaming.sinks import dated
from tests.conftest import at, plan_of


def test_topic_options():
    live = {"kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "latest", "failOnDataLoss": "false"}
    assert topics.kafka_source_options("b:1", "t") == live
    assert topics.kafka_source_options("b:1", "t", "earliest") == {**live, "startingOffsets": "earliest"}
    assert topics.kafka_source_options("b:1", "t", None, None) == {"kafka.bootstrap.servers": "b:1", "subscribe": "t"}
    assert topics.kafka_source_options("b:1", "t", max_offsets=5, min_partitions=64) == {
        **live, "maxOffsetsPerTrigger": "5", "minPartitions": "64"}
    assert topics.kafka_sink_options("b:1", "a") == {"kafka.bootstrap.servers": "b:1", "topic": "a"}


def test_topics_need_their_connector(spark, events, folder):
    with pytest.raises(AnalysisException, match="kafka"):
        topics.kafka_source(spark, topics.kafka_source_options("b:1", "t"))
    with pytest.raises(AnalysisException, match="kafka"):
        sinks.topic_sink(topics.kafka_sink_options("b:1", "t"))(events(("10:00:00", "a", True, "d")), 0)
    sinks.topic_sink(topics.kafka_sink_options("b:1", "t"))(events(("10:00:00", "a", True, "d")).limit(0), 0)


def test_messages_from_files(spark, folder):
    path = folder()
    events = page_creates(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    raw_messages(events).write.json(path)
    stream = parse_events(file_source(spark, path, fmt="json"))
    assert stream.isStreaming
    assert stream.columns == ["page_id", "page_title", "domain", "user_name", "user_id", "user_is_bot", "event_time"]


@pytest.fixture
def archive(events, folder):
    path = folder()
    for day in ("2024-02-28", "2024-02-29", "2024-03-01", "2024-03-02"):
        rows = events(("00:00:00", "u", False, "d"), ("23:30:00", "u", False, "d"), ("23:59:59", "v", True, "d"), day=day)
        dated(rows.drop("page_id", "user_id")).write.mode("append").partitionBy("year", "month", "day").parquet(path)
    return path


def test_archive_is_read_by_day(spark, archive):
    rows = read_archive(spark, archive, at("23:30:00", "2024-02-29"), at("00:00:00", "2024-03-02"))
    assert [r.event_time for r in rows.orderBy("event_time").collect()] == [
        at("23:30:00", "2024-02-29"), at("23:59:59", "2024-02-29"),
        at("00:00:00"), at("23:30:00"), at("23:59:59")]
    plan = plan_of(rows)
    assert "make_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len({Path(f).parent for f in rows.inputFiles()}) == 3
    assert "PushedFilters" in plan and "GreaterThanOrEqual(event_time" in plan
    assert read_archive(spark, archive).count() == 12


def test_jobs_read_the_archive(spark, archive, folder):
    report = hourly_report_job(spark, archive, "2024-03-02 00:10:00").collect()
    assert [(r.time_start, r.pages_created, r.bot_percent) for r in report] == [(at("23:00:00"), 2, 50.0)]
    patterns = editor_patterns_job(spark, archive)
    assert [(r.user_name, r.total_pages, r.active_hours) for r in patterns.collect()] == [("u", 8, [0, 23])]
    path = folder()
    assert run_job(patterns, sinks.table_sink(path), 1)
    assert not run_job(patterns.limit(0), sinks.table_sink(folder()), 1)
    assert spark.read.parquet(path).count() == 1


def test_incremental_profiles_cover_all_times(spark, tmp_path):
    rows = pq.read_table("/root/testdata/sf0.001/events.parquet")
    place = rows.schema.get_field_index("ts")
    moved = [rows.set_column(place, "ts", pc.add(rows["ts"], pa.scalar(timedelta(days=days), pa.duration("us")))) for days in (-900, 900)]
    pq.write_table(pa.concat_tables([rows, *moved]), tmp_path / "events.parquet")

    def profiles(query):
        return sorted((r.user_name, r.total_pages, r.avg_gap_seconds) for r in query(spark, str(tmp_path)).collect())

    whole = profiles(checks.archive_editor_patterns)
    assert whole and profiles(checks.editor_patterns_incremental) == whole


def test_nothing_written_yet_is_no_rows_but_other_errors_surface(spark, folder):
    path = folder()
    assert read_archive(spark, path).count() == 0
    assert hourly_report_job(spark, path, "2024-03-02 00:10:00").count() == 0
    Path(path).mkdir()
    Path(path, "x.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="Parquet|parquet"):
        read_or_empty(spark, path, "a int").collect()


def test_store_sink_appends(events, folder):
    path = folder()
    write = sinks.store_sink("parquet", {"path": path})
    rows = events(("10:00:00", "a", True, "d"))
    write(rows, 0)
    write(rows, 1)
    write(rows.limit(0), 2)
    assert rows.sparkSession.read.parquet(path).count() == 2


def test_scratch_is_the_warehouse_where_no_folder_is_named():
    """A core setting cannot be unset in a running session, so the session here is none."""
    class Session:
        conf = {"spark.sql.warehouse.dir": "hdfs://shared/warehouse/"}

    assert scratch_dir(Session, "x").startswith("hdfs://shared/warehouse/scratch/x-")
    Session.conf = {**Session.conf, "spark.checkpoint.dir": "hdfs://shared/checkpoints"}
    assert scratch_dir(Session, "x").startswith("hdfs://shared/checkpoints/x-")


def test_scratch_is_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
