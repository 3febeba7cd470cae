"""Helpers the operators share: tables, written intermediates, words and their hashes."""

import io
import math
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow.fs
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pageflow.session import scratch_dir

# White space of the contracts: \x20 and \x09-\x0D. Python's bytes.split() splits at exactly these.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Rows that a Python worker holds at a time; texts may be long.
BATCH_ROWS = 500


def opened(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that what a worker has loaded serves all its tasks."""
    context = spark.sparkContext
    if any("/pageflow-llm-" in f for f in context.listFiles):
        return
    top, data = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for file in sorted(top.rglob("*.py")):
            archive.write(file, file.relative_to(top.parent))
    uri = scratch_dir(spark, "code") + f"/pageflow-llm-{uuid.uuid4().hex}.zip"
    files, path = opened(uri)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    with files.open_output_stream(path, compression=None) as out:
        out.write(data.getvalue())
    context.addPyFile(uri)


def prepared(spark: SparkSession) -> SparkSession:
    """UTC, adaptive execution, and small batches to Python workers."""
    ship(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(frame: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: computed once, with no lineage to repeat."""
    path = scratch_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def let(value: Column, body) -> Column:
    """body(value) with `value` computed once a row, also where body's lambdas use it again and again."""
    return F.transform(F.array(value), body)[0]


def word_array(text: Column) -> Column:
    """The words of a text; an empty array for null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """The same words in UTF-8, A-Z lower-cased if asked."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix64)."""
    with np.errstate(over="ignore"):
        z = values + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of n words, by doubling: log n passes over the text."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    result, done, power, width = None, 0, hashes, 1
    with np.errstate(over="ignore"):
        while True:
            if n & width:
                if result is None:
                    result, done = power, width
                else:
                    size = len(hashes) - done - width + 1
                    result, done = mixed(result[:size] * np.uint64(3) + mixed(power[done:done + size])), done + width
            if width * 2 > n:
                return result
            size = len(power) - width
            power, width = mixed(power[:size] * np.uint64(5) + mixed(power[width:width + size])), width * 2


def share_of(rows: DataFrame, size: Column, unit: int, least: int = 1) -> int:
    """How many shares of about `unit` (in units of `size`) the rows make: one aggregated row comes back."""
    total = rows.agg(F.sum(size).alias("total")).first()["total"] or 0
    return max(least, math.ceil(total / unit))


def sampled(texts: DataFrame, count: int) -> DataFrame:
    """Of the column `text` at most `count` different values: those with the smallest hashes.

    Tasks send hashes alone to find the last one; a text goes on only if it is in the sample.
    """
    hashed = texts.select("text", F.xxhash64("text").alias("h")).where("text is not null")
    last = hashed.select("h").distinct().orderBy("h").limit(count).agg(F.max("h")).first()[0]
    return hashed.where(F.col("h") <= F.lit(last)).dropDuplicates(["h"]).select("text")
