"""Keyed tables: upserts by touched partitions, and reads from the newest day on."""

import pytest
from pyspark.sql import functions as F

from pageflow.operators import serving, upsert
from pageflow.schema import PAGES, TABLE_KEYS
from pageflow.streaming import sinks, versions
from tests.conftest import plan_of

SCHEMA = "k string, at timestamp, v int"


@pytest.fixture
def frame(spark):
    def make(*rows):
        found = spark.createDataFrame(rows, "k string, at string, v int")
        return found.withColumn("at", F.col("at").cast("timestamp"))

    return make


def rows(found):
    return sorted(((r.k, None if r["at"] is None else str(r["at"]), r.v) for r in found.collect()), key=str)


def files(spark, path):
    return set(spark.read.parquet(path).inputFiles())


def test_an_upsert_touches_the_buckets_of_its_keys_alone(spark, frame, folder):
    path = folder()
    write = versions.upsert_sink(path, SCHEMA, ["k"], "k", buckets=16)
    first = [(f"k{n}", "2024-03-01 00:00:00", n) for n in range(200)]
    write(frame(*first), 0)
    before = files(spark, path)
    write(frame(("k7", "2024-03-02 00:00:00", -7), ("new", None, 1)), 1)
    added = files(spark, path) - before
    touched = {r[0] for r in frame(("k7", None, 0), ("new", None, 0)).select(sinks.bucket("k", 16)).collect()}
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in added} == touched
    expected = sorted([(k, t, v) for k, t, v in first if k != "k7"] + [("k7", "2024-03-02 00:00:00", -7), ("new", None, 1)], key=str)
    assert sorted(rows(versions.read_upserted(spark, path, SCHEMA)), key=str) == expected


def test_an_upsert_reads_the_buckets_of_its_keys_alone(spark, frame, folder, monkeypatch):
    path, read = folder(), []
    write = versions.upsert_sink(path, SCHEMA, ["k"], "k", buckets=16)
    write(frame(*[(f"k{n}", None, n) for n in range(200)]), 0)
    real = versions.upsert
    monkeypatch.setattr(versions, "upsert", lambda old, batch, *more: read.append(old.inputFiles()) or real(old, batch, *more))
    write(frame(("k7", None, -7)), 1)
    own, = {f.split("bucket=")[1].split("/")[0] for f in read[0]}
    assert int(own) == frame(("k7", None, 0)).select(sinks.bucket("k", 16)).first()[0]
    assert len({f.split("bucket=")[1].split("/")[0] for f in files(spark, path)}) == 16


def test_a_repeated_batch_and_an_older_row_change_nothing(spark, frame, folder):
    path = folder()
    write = versions.upsert_sink(path, SCHEMA, ["k"], "k", order_col="at")
    one, two = frame(("a", "2024-03-02 00:00:00", 1)), frame(("a", "2024-03-01 00:00:00", 2), ("a", "2024-03-02 00:00:00", 3))
    write(one, 0)
    for _ in range(3):
        write(two, 1)
        assert rows(versions.read_upserted(spark, path, SCHEMA)) == [("a", "2024-03-02 00:00:00", 3)]
    write(one.limit(0), 2)
    assert rows(versions.read_upserted(spark, path, SCHEMA, of=("k", "a"))) == [("a", "2024-03-02 00:00:00", 3)]
    assert rows(versions.read_upserted(spark, path, SCHEMA, of=("k", "b"))) == []
    assert rows(versions.read_upserted(spark, folder(), SCHEMA)) == []


def test_days_are_partitions_of_their_own(spark, frame, folder):
    path = folder()
    write = versions.upsert_sink(path, SCHEMA, ["k", "at"], "k", day_of="at", buckets=2)
    old = [(f"k{n % 3}", f"2024-03-{1 + n:02} 10:00:00", n) for n in range(9)] + [("k0", None, 50)]
    write(frame(*old), 0)
    before = files(spark, path)
    write(frame(("k1", "2024-03-02 10:00:00", 100), ("k0", None, 51)), 1)
    assert len(files(spark, path) - before) == 2
    expected = [r for r in old if r[2] not in (1, 50)] + [("k1", "2024-03-02 10:00:00", 100), ("k0", None, 51)]
    assert sorted(rows(versions.read_upserted(spark, path, SCHEMA, day_of="at")), key=str) == sorted(expected, key=str)


def test_old_versions_go_and_the_last_two_stay(spark, frame, folder):
    path = folder()
    write = versions.upsert_sink(path, SCHEMA, ["k"], "k", buckets=1)
    for n in range(5):
        write(frame((f"k{n}", None, n)), n)
    assert versions.expire_versions(spark, path, SCHEMA, keep=1) == 3
    assert len(rows(versions.read_upserted(spark, path, SCHEMA))) == 5
    write(frame(("k4", None, 40)), 4)  # the last batch again
    assert rows(versions.read_upserted(spark, path, SCHEMA))[-1] == ("k4", None, 40)


def test_same_as_the_upsert_of_whole_tables(spark, frame, folder):
    path = folder()
    write = versions.upsert_sink(path, SCHEMA, ["k"], "k", order_col="at", buckets=4)
    whole = frame().limit(0)
    for batch_id in range(4):
        batch = frame(*[(f"k{(n * 7 + batch_id) % 11}", f"2024-03-{1 + (n * batch_id) % 9:02} 00:00:00", n) for n in range(8)])
        # of a batch's equally late rows of one key the greater counts
        whole = upsert.upsert(whole, batch, ["k"], "at")
        write(batch, batch_id)
    assert rows(versions.read_upserted(spark, path, SCHEMA)) == rows(whole)


PAGE = PAGES["pages_by_domain"]
KEYS = TABLE_KEYS["pages_by_domain"]


@pytest.fixture
def pages(spark):
    """30 days of a hot domain's pages and a few of others; some without a time."""
    found = spark.range(3000).selectExpr(
        "if(id % 10 < 8, 'hot', concat('d', id % 7)) as domain",
        "if(id % 500 = 0, null, timestamp'2024-03-01 00:00:00' + make_dt_interval(0, 0, 0, id * 864)) as created_at",
        "cast(id as string) as page_id", "concat('T', id) as page_title", "'u' as user_name")
    return found


def test_newest_pages_come_from_the_newest_days(spark, pages, folder):
    path = folder()
    write = sinks.newest_first_sink(path, "domain", "created_at", 4)
    write(pages.where("page_id % 2 = 0"), 0)
    write(pages.where("page_id % 2 = 1"), 1)
    total = spark.read.parquet(path)

    def days(found):
        return {f.split("day=")[1].split("/")[0] for f in found.inputFiles()}

    def newest(limit, *between):
        return sinks.read_newest(spark, path, PAGE, KEYS, ("domain", "hot"), "created_at", limit, *between, buckets=4)

    def expected(limit, *between):
        return [tuple(r) for r in serving.pages_of_domain(pages, "hot", *between, limit=limit).collect()]

    few = newest(50)
    assert days(few) == {"2024-03-30"}  # 80 pages a day
    assert [tuple(r) for r in serving.pages_of_domain(few, "hot", limit=50).collect()] == expected(50)
    assert len(days(newest(100))) == 2 and len(days(newest(200))) == 4
    assert [tuple(r) for r in serving.pages_of_domain(newest(200), "hot", limit=200).collect()] == expected(200)
    between = ("2024-03-05 00:00:00", "2024-03-09 11:00:00")
    # 38 pages up to 11:00 of the last day and 80 of the day before
    assert days(newest(38, *between)) == {"2024-03-09"} and days(newest(39, *between)) == {"2024-03-08", "2024-03-09"}
    some = newest(100, *between)
    assert [tuple(r) for r in serving.pages_of_domain(some, "hot", *between, limit=100).collect()] == expected(100, *between)
    everything = newest(10 ** 6)
    assert sinks.NO_DAY in days(everything)
    assert sorted(map(str, everything.collect())) == sorted(map(str, pages.where("domain = 'hot'").collect()))
    assert len(few.inputFiles()) < len(total.inputFiles()) / 20
    assert sinks.read_newest(spark, path, PAGE, KEYS, ("domain", "nobody"), "created_at", 5, buckets=4).count() == 0
    assert sinks.read_newest(spark, folder(), PAGE, KEYS, ("domain", "hot"), "created_at", 5).count() == 0


def test_files_are_clustered_by_key_and_newest_first(spark, pages, folder):
    path = folder()
    sinks.newest_first_sink(path, "domain", "created_at", 2)(pages.where("created_at is not null"), 0)
    for file in spark.read.parquet(path).inputFiles():
        found = [(r.domain, -r.created_at.timestamp()) for r in spark.read.parquet(file).collect()]
        assert found == sorted(found)
    key = sinks.read_newest(spark, path, PAGE, KEYS, ("domain", "hot"), "created_at", 5, buckets=2)
    assert "EqualTo(domain,hot)" in plan_of(key)
