"""Sinks for streams: the archive, keyed tables, alert topics.

A sink handed to a job is a function (rows, batch_id) called for each micro-batch.
"""

import re
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from pageflow.functions.durations import instant
from pageflow.operators.alerts import to_alert_json
from pageflow.operators.upsert import latest
from pageflow.sources.files import read_or_empty

# Column of a keyed table that holds the micro-batch a row came in.
BATCH = "batch_id"
# The folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
# Buckets of a table that has them. A table keeps the number it was first written with.
BUCKETS = 64


def dated(events: DataFrame) -> DataFrame:
    """Adds the archive's partition columns."""
    return events.select(
        "*", F.year("event_time").alias("year"), F.month("event_time").alias("month"),
        F.dayofmonth("event_time").alias("day"))


def _partitioned(rows: DataFrame, path: str, columns: list, batch_id: int) -> None:
    """Writes a micro-batch's rows into folders of its own; the folders replace those of an earlier try."""
    rows.withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*columns, BATCH).parquet(path)


def archive_sink(path: str, files_per_day: int | None = None):
    """Adds all events to Parquet by year, month, day and micro-batch, each exactly once.

    Every task writes the days it holds, in parallel. When a backlog of many days comes in at
    once, `files_per_day` first gathers each day into that many tasks, to save small files. A folder holds only what a
    finished write put there, so single days can be read without a list of all that was ever written.
    """
    def write(events: DataFrame, batch_id: int) -> None:
        rows = dated(events)
        if files_per_day:
            spread = F.pmod(F.xxhash64("page_title", "user_name", "event_time"), F.lit(files_per_day))
            rows = rows.repartition("year", "month", "day", spread)
        _partitioned(rows, path, ["year", "month", "day"], batch_id)

    return write


def bucket(column, buckets: int = BUCKETS):
    """The bucket of a key's value."""
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def newest_first_sink(path: str, key: str, time: str, buckets: int = BUCKETS):
    """A keyed table for reads of a key's newest rows: by bucket of the key and day of the time, and in each file by key and
    falling time, so that a file's statistics tell whether a key's rows of some time are in it.

    A micro-batch's rows are dealt by bucket and day, large ones over several tasks, small ones together.
    """
    def write(rows: DataFrame, batch_id: int) -> None:
        placed = rows.withColumn("bucket", bucket(key, buckets)).withColumn("day", F.to_date(time))
        clustered = placed.hint("rebalance", "bucket", "day").sortWithinPartitions(
            "bucket", "day", key, F.col(time).desc())
        _partitioned(clustered, path, ["bucket", "day"], batch_id)

    return write


def read_newest(spark: SparkSession, path: str, schema: str, keys: list, of: tuple, time: str, limit: int,
                since=None, until=None, buckets: int = BUCKETS) -> DataFrame:
    """Rows of one key of a `newest_first_sink` table that hold its newest `limit`: of = (column, value).

    The days of the key's bucket are taken from the newest on, twice as many each time, until they have enough rows; older
    days are not read. `since` and `until` bound the column `time`, both inclusive; either may be left open.
    """
    bounds = [None if t is None else instant(t) for t in (since, until)]
    number, first, last = spark.range(1).select(bucket(F.lit(of[1]), buckets), *[
        F.lit(None) if t is None else t.cast("date").cast("string") for t in bounds]).first()
    wanted = F.col(of[0]) == of[1]
    if since is not None:
        wanted &= F.col(time) >= bounds[0]
    if until is not None:
        wanted &= F.col(time) <= bounds[1]
    stored = f"{schema}, bucket int, day date, {BATCH} long"
    names = {re.search(r"/day=([^/]+)/", f)[1] for f in read_or_empty(spark, f"{path}/bucket={number}", stored, base=path).inputFiles()}
    bounded = [d for d in names if (first is None or d >= first) and (last is None or d <= last)]
    days = sorted((d for d in bounded if d != NO_DAY), reverse=True)
    if first is None and last is None and NO_DAY in names:
        days.append(NO_DAY)  # rows without a time come last
    taken = 1
    while True:
        where = f"{path}/bucket={number}/day={{{','.join(days[:taken])}}}"
        rows = read_or_empty(spark, where, stored, base=path).where(wanted)
        found = latest(rows.select(*StructType.fromDDL(schema).names, BATCH), keys, [BATCH]).drop(BATCH)
        if taken >= len(days) or found.limit(limit).count() >= limit:
            return found
        taken *= 2


def table_sink(path: str, day_of: str | None = None, bucket_of: str | None = None, buckets: int = BUCKETS):
    """Appends each micro-batch to the keyed table at `path`; `read_table` keeps the latest rows.

    A micro-batch has folders of its own and replaces them when it is run again, so a repeated
    batch changes nothing and no write touches rows of earlier batches. `bucket_of` names a column of the key by
    whose hash the table is partitioned, for reads of single keys; `day_of` a time column of the key by whose date it is.
    """
    def write(rows: DataFrame, batch_id: int) -> None:
        if day_of is None and bucket_of is None:
            rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
            return
        columns = []
        if bucket_of is not None:
            rows, columns = rows.withColumn("bucket", bucket(bucket_of, buckets)), ["bucket"]
        if day_of is not None:
            rows, columns = rows.withColumn("day", F.to_date(day_of)), [*columns, "day"]
        _partitioned(rows, path, columns, batch_id)

    return write


def read_rows(spark: SparkSession, path: str, schema: str, day_of: str | None = None, between: tuple | None = None,
              of: tuple | None = None, buckets: int = BUCKETS) -> DataFrame:
    """All rows of a keyed table with their `BATCH`.

    `between` = (first, last) reads only the days of these dates; other days are not even listed. `of` = (column, value)
    reads only that value's bucket of a table with buckets, and the value's rows.
    """
    stored = schema + (", bucket int" if of else "") + (", day date" if day_of else "") + f", {BATCH} long"
    where = path
    if between is not None:
        first, last = between
        days = [str(first + timedelta(days=n)) for n in range((last - first).days + 1)]
        where = f"{path}/day={{{','.join(days)}}}"
    rows = read_or_empty(spark, where, stored, base=path)
    if of is not None:
        rows = rows.where((F.col("bucket") == bucket(F.lit(of[1]), buckets)) & (F.col(of[0]) == of[1]))
    return rows.select(*StructType.fromDDL(schema).names, BATCH)


def read_table(spark: SparkSession, path: str, schema: str, keys: list, day_of: str | None = None,
               order: list | None = None, between: tuple | None = None, of: tuple | None = None,
               buckets: int = BUCKETS) -> DataFrame:
    """The latest row of each key: the greatest in `order`, then of the latest micro-batch."""
    rows = read_rows(spark, path, schema, day_of, between, of, buckets)
    return latest(rows, keys, [*(order or []), BATCH]).drop(BATCH)


def compact_table(spark: SparkSession, path: str, target: str, schema: str, keys: list, day_of: str | None = None,
                  order: list | None = None, bucket_of: str | None = None) -> None:
    """Writes a keyed table's latest rows to a new place, as that table's batch -1. Later batches go on there."""
    table_sink(target, day_of, bucket_of)(read_table(spark, path, schema, keys, day_of, order), -1)


def store_sink(fmt: str, options: dict, mode: str = "append"):
    """Writes each micro-batch through a connector, for stores that overwrite by key themselves."""
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            if not rows.isEmpty():
                rows.write.format(fmt).options(**options).mode(mode).save()
        finally:
            rows.unpersist()

    return write


def formed(sink, form):
    """`sink` for rows brought into another form first, such as alerts into messages."""
    return lambda rows, batch_id: sink(form(rows), batch_id)


def topic_sink(options: dict, form=None):
    """Sends each micro-batch's rows, after `form`, to a topic as JSON. Nothing is sent for none."""
    return formed(store_sink("kafka", options), lambda rows: to_alert_json(form(rows) if form else rows))


def topic_writer(alerts: DataFrame, options: dict, checkpoint: str, mode: str = "update",
                 **trigger) -> DataStreamWriter:
    """A stream of alerts straight into a topic."""
    return (
        to_alert_json(alerts).writeStream.format("kafka").options(**options)
        .option("checkpointLocation", checkpoint).outputMode(mode)
        .trigger(**(trigger or {"processingTime": "1 minute"})))
