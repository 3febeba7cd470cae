import sys
import uuid
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pageflow.schema import EVENTS  # noqa: E402
from pageflow.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A function giving new paths."""
    return lambda: str(tmp_path / uuid.uuid4().hex)


@pytest.fixture
def events(spark):
    """A function making typed events from short rows (time, user, bot, domain, title, id)."""
    def make(*rows, day="2024-03-01"):
        def event(number, row):
            time, user, bot, domain, title, page_id = (*row, *[None] * 6)[:6]
            title = f"Title {number}" if title is None else title
            stamp = f"{day} {time}"
            return (page_id or str(number), title, domain, user, None, bot, stamp)

        schema = EVENTS.simpleString()[len("struct<"):-1].replace("event_time:timestamp", "event_time:string")
        frame = spark.createDataFrame([event(n, r) for n, r in enumerate(rows)], schema)
        return frame.withColumn("event_time", frame.event_time.cast("timestamp"))

    return make


def at(text: str, day: str = "2024-03-01") -> datetime:
    return datetime.fromisoformat(f"{day} {text}")


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
