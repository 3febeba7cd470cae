"""Hourly report per domain."""

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from pageflow.functions.durations import instant
from pageflow.functions.ranking import in_rank_order, top_per_group
from pageflow.functions.ratios import percent
from pageflow.operators.clean import present


def last_full_hours(events: DataFrame, as_of: str | datetime, hours: int) -> DataFrame:
    """Events of the `hours` whole hours before the hour `as_of` lies in."""
    start, end = hour_bounds(as_of, hours)
    return events.where((F.col("event_time") >= start) & (F.col("event_time") < end))


def hour_bounds(as_of: str | datetime, hours: int):
    end = F.date_trunc("hour", instant(as_of))
    return end - F.make_dt_interval(hours=F.lit(hours)), end


def author_hours(events: DataFrame) -> DataFrame:
    """Pages per (domain, hour, user_name, user_is_bot)."""
    return present(events, "domain", "event_time").groupBy(
        "domain", F.date_trunc("hour", "event_time").alias("time_start"), "user_name", "user_is_bot"
    ).agg(F.count("*").alias("pages"))


def top_authors(authors: DataFrame, k: int = 10) -> DataFrame:
    """The `k` busiest authors of each domain and hour, ranked; ties by name."""
    order = [F.col("pages").desc(), F.col("user_name").asc_nulls_last(), F.col("user_is_bot").asc_nulls_last()]
    return top_per_group(authors, ["domain", "time_start"], order, k)


def report_of(authors: DataFrame, k: int = 10) -> DataFrame:
    """The report from `author_hours`.

    An author seen with two bot flags counts once for each; pages of unnamed authors count as
    pages but not as an author. The authors' JSON spells out NULL, so that it can be read back
    into complete records.
    """
    pages, hour = F.col("pages"), ["domain", "time_start"]
    totals = authors.groupBy(*hour).agg(
        F.sum("pages").alias("total"),
        F.count("user_name").alias("unique_authors"),
        F.sum(F.when(F.col("user_is_bot"), pages).otherwise(0)).alias("by_bots"))
    author = F.struct(
        F.col("user_name").alias("name"), pages,
        F.col("user_is_bot").alias("is_bot"))
    top = top_authors(authors, k).groupBy(*hour).agg(in_rank_order(author).alias("authors"))
    return totals.join(top, hour).select(
        "domain",
        "time_start",
        (F.col("time_start") + F.make_dt_interval(hours=F.lit(1))).alias("time_end"),
        F.col("total").alias("pages_created"),
        "unique_authors",
        percent(F.col("by_bots"), F.col("total")).alias("bot_percent"),
        F.to_json("authors", {"ignoreNullFields": "false"}).alias("top_authors"))


def hourly_report(events: DataFrame, as_of: str | datetime | None = None, hours: int = 6, k: int = 10) -> DataFrame:
    """Pages, authors, bot share and top authors of every domain, for the last full hours.

    as_of=None reports every hour there is.
    """
    rows = events if as_of is None else last_full_hours(events, as_of, hours)
    return report_of(author_hours(rows), k)
