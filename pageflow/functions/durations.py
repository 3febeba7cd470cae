"""Durations written as in Spark intervals ("10 minutes"), and points in time."""

from datetime import datetime

from pyspark.sql import Column, functions as F

UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds(duration: str) -> int:
    amount, unit = duration.split()
    return int(amount) * UNIT_SECONDS[unit.lower().rstrip("s")]


def panes_per_window(window: str, slide: str) -> int:
    """How many slides make up one window; they must divide evenly."""
    width, step = seconds(window), seconds(slide)
    if width % step:
        raise ValueError(f"window {window!r} is not a whole number of slides {slide!r}")
    return width // step


def instant(time: str | datetime | Column) -> Column:
    """A point in time. Text and datetimes without a zone are in the session's zone."""
    if isinstance(time, datetime) and time.tzinfo is None:
        time = str(time)
    return F.lit(time).cast("timestamp")
