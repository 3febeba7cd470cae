"""File sources: raw messages, typed streams, the date-partitioned archive, result tables."""

from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pageflow.functions.durations import instant
from pageflow.schema import ARCHIVE, RAW


def file_source(spark: SparkSession, path: str, schema=RAW, fmt: str = "parquet",
                files_per_trigger: int | None = None) -> DataFrame:
    """Files that keep arriving under `path` (a folder or a glob), as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def read_or_empty(spark: SparkSession, path: str, schema, base: str | None = None) -> DataFrame:
    """Parquet under `path`, or no rows if nothing has been written yet. Other errors surface.

    `base` is the table's root where `path` names only some of its partitions.
    """
    reader = spark.read.schema(schema)
    if base is not None:
        reader = reader.option("basePath", base)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# Days whose folders are named one by one; a longer stretch is read through a filter on the folders' names.
MOST_DAYS = 1000


def _days(spark: SparkSession, since, until) -> list | None:
    """The dates from `since` to `until`, or None if they are too many or one is open."""
    if since is None or until is None:
        return None
    first, last = spark.range(1).select(since.cast("date"), until.cast("date")).first()
    count = (last - first).days + 1
    return [first + timedelta(days=n) for n in range(count)] if 0 < count <= MOST_DAYS else None


def read_archive(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Archived events with start <= event_time < end (either bound may be None).

    Between two bounds only the folders of the days in question are named, so no others are listed. An open bound is
    put on the partition columns, so that other days are listed but not read.
    """
    since = None if start is None else instant(start)
    until = None if end is None else instant(end)
    days, where = _days(spark, since, until), path
    if days is not None:
        where = f"{path}/{{{','.join(f'year={d.year}/month={d.month}/day={d.day}' for d in days)}}}"
    rows = read_or_empty(spark, where, ARCHIVE + ", year int, month int, day int, batch_id long", base=path)
    date = F.make_date("year", "month", "day")
    if since is not None:
        rows = rows.where((F.col("event_time") >= since) & (date >= since.cast("date")))
    if until is not None:
        rows = rows.where((F.col("event_time") < until) & (date <= until.cast("date")))
    return rows.drop("year", "month", "day", "batch_id")
