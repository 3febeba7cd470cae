"""The batch jobs: archive in, result table out."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from pageflow.functions.durations import instant
from pageflow.operators.editors import editor_parts, editor_patterns, merge_parts, patterns_of
from pageflow.operators.reports import hour_bounds, hourly_report
from pageflow.sources.files import read_archive
from pageflow.streaming.sinks import read_rows, table_sink


def hourly_report_job(spark: SparkSession, archive: str, as_of: str | datetime, hours: int = 6, k: int = 10) -> DataFrame:
    """The hourly report, reading only the archive days that hold the hours in question."""
    return hourly_report(read_archive(spark, archive, *hour_bounds(as_of, hours)), as_of, hours, k)


def editor_patterns_job(spark: SparkSession, archive: str, min_pages: int = 5) -> DataFrame:
    """Profiles of all editors in the archive."""
    return editor_patterns(read_archive(spark, archive), min_pages)


EDITOR_PARTS = "user_name string, domain string, pages bigint, timed bigint, first bigint, last bigint, hours int"
# The run of a stretch without a start: less than the seconds of any timestamp.
NO_START = -2 ** 53


def editor_parts_job(spark: SparkSession, archive: str, parts: str, since: str | None, until: str | None) -> None:
    """Adds what profiles need of the pages since <= event_time < until (either may be None) to the table `parts`.

    A run reads only the archive days of its stretch. Run again for the same stretch it replaces its own rows; stretches
    of different runs must not overlap.
    """
    number = NO_START if since is None else spark.range(1).select(F.unix_seconds(instant(since))).first()[0]
    table_sink(parts)(editor_parts(read_archive(spark, archive, since, until)), number)


def stored_editor_patterns(spark: SparkSession, parts: str, min_pages: int = 5) -> DataFrame:
    """Profiles of all editors from the stored parts, without the history."""
    return patterns_of(merge_parts(read_rows(spark, parts, EDITOR_PARTS)), min_pages)


def run_job(result: DataFrame, sink, run_id: int) -> bool:
    """Hands a job's result to a sink; False if there is nothing to write."""
    result.persist()
    try:
        if result.isEmpty():
            return False
        sink(result, run_id)
        return True
    finally:
        result.unpersist()
