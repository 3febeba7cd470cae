"""Keyed tables of which a write touches only the partitions that its keys fall in.

A table is partitioned by a hash of one of its key's columns, and by day if its key holds a time. Each partition has versions,
the newest of which has all its rows, one per key. An upsert reads the newest versions of the partitions it has keys for,
and writes their next ones; others are neither read nor written. Versions are numbered by micro-batch and a batch
builds on those before its own number, so a repeated batch gives the same again.
"""

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from pageflow.operators.upsert import upsert
from pageflow.sources.files import read_or_empty
from pageflow.streaming.sinks import BUCKETS, bucket

VERSION = "version"
_FOLDER = re.compile(rf"/((?:bucket=[^/]+)(?:/day=[^/]+)?)/{VERSION}=(-?\d+)/[^/]+$")


def _versions(spark: SparkSession, path: str, schema: str, parts: str, day_of: str | None) -> dict[str, list[int]]:
    """Of the partitions that the glob `parts` names, the numbers of their versions. Lists folders and opens no file."""
    stored = schema + ", bucket int" + (", day date" if day_of else "") + f", {VERSION} long"
    out: dict[str, set[int]] = {}
    for file in read_or_empty(spark, f"{path}/{parts}", stored, base=path).inputFiles():
        found = _FOLDER.search(file)
        out.setdefault(found[1], set()).add(int(found[2]))
    return {part: sorted(numbers) for part, numbers in out.items()}


def _read(spark: SparkSession, path: str, schema: str, newest: Iterable[tuple[str, int]]) -> DataFrame:
    """The rows of these versions, which are named to Spark one by one."""
    folders = [f"{path}/{part}/{VERSION}={number}" for part, number in newest]
    reader = spark.read.schema(schema)
    return reader.parquet(*folders) if folders else spark.createDataFrame([], schema)


def _glob(buckets: Iterable[int] | None, days: Iterable[str] | None) -> str:
    def names(name, values):
        return f"{name}=*" if values is None else f"{name}={{{','.join(sorted(set(map(str, values))))}}}"

    return names("bucket", buckets) + ("" if days is None else "/" + names("day", days))


def upsert_sink(path: str, schema: str, keys: list, bucket_of: str, order_col: str | None = None, day_of: str | None = None,
                buckets: int = BUCKETS):
    """Puts each micro-batch's rows into the table at `path` by key: of equal keys the row greatest in `order_col` stays, of
    equally great ones, and without `order_col`, the batch's.

    What goes through the driver is a name for each touched partition: `buckets` at most, times the days of the batch. A
    table keeps the number of buckets it was first written with. Days of NULL are a partition too.
    """
    columns = ["bucket", "day"] if day_of else ["bucket"]

    def write(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        batch = rows.select(*StructType.fromDDL(schema).names).withColumn("bucket", bucket(bucket_of, buckets))
        if day_of:
            batch = batch.withColumn("day", F.to_date(day_of))
        touched = [(r["bucket"], _day(r["day"]) if day_of else None) for r in batch.select(*columns).distinct().collect()]
        if not touched:
            return
        wanted = {f"bucket={b}" + (f"/day={d}" if day_of else "") for b, d in touched}
        parts = _glob({b for b, _ in touched}, {d for _, d in touched} if day_of else None)
        before = {
            part: [n for n in numbers if n < batch_id]
            for part, numbers in _versions(spark, path, schema, parts, day_of).items() if part in wanted}
        old = _read(spark, path, schema, [(part, numbers[-1]) for part, numbers in before.items() if numbers])
        merged = upsert(old, batch.drop(*columns), keys, order_col).withColumn("bucket", bucket(bucket_of, buckets))
        if day_of:
            merged = merged.withColumn("day", F.to_date(day_of))
        merged.withColumn(VERSION, F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(*columns, VERSION).parquet(path)

    return write


def _day(day) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if day is None else str(day)


def read_upserted(spark: SparkSession, path: str, schema: str, day_of: str | None = None, of: tuple | None = None,
                  buckets: int = BUCKETS) -> DataFrame:
    """The rows of a table that `upsert_sink` keeps. `of` = (column, value) reads the value's bucket alone."""
    only = None
    if of is not None:
        only = [spark.range(1).select(bucket(F.lit(of[1]), buckets)).first()[0]]
    found = _versions(spark, path, schema, _glob(only, None), day_of)
    rows = _read(spark, path, schema, [(part, numbers[-1]) for part, numbers in found.items()])
    return rows if of is None else rows.where(F.col(of[0]) == of[1])


def expire_versions(spark: SparkSession, path: str, schema: str, day_of: str | None = None, keep: int = 2) -> int:
    """Removes all but the newest `keep` versions of each partition, to be run from time to time; how many were removed.

    At least two stay: the last micro-batch may have to be repeated from the version before its own.
    """
    context, removed = spark.sparkContext, 0
    for part, numbers in _versions(spark, path, schema, _glob(None, None), day_of).items():
        for number in numbers[:-max(2, keep)]:
            folder = context._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}/{VERSION}={number}")
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
            removed += 1
    return removed
