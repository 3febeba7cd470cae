"""Reads of the result tables."""

from pyspark.sql import DataFrame, functions as F

from pageflow.functions.durations import instant

# Fixed value: the record behind one entry of a report's top authors.
AUTHORS = "array<struct<name:string,pages:bigint,is_bot:boolean>>"


def get_hourly_report(report: DataFrame, domain: str, hours: int = 6) -> DataFrame:
    """The newest `hours` rows of a domain's report, times as HH:MM, authors as records."""
    newest = report.where(F.col("domain") == domain).orderBy(F.col("time_start").desc()).limit(hours)
    return newest.select(
        F.date_format("time_start", "HH:mm").alias("time_start"),
        F.date_format("time_end", "HH:mm").alias("time_end"),
        "domain", "pages_created", "unique_authors", "bot_percent",
        F.from_json("top_authors", AUTHORS).alias("top_authors"))


def get_editor_patterns(patterns: DataFrame, min_pages: int = 5) -> DataFrame:
    return patterns.where(F.col("total_pages") >= min_pages)


def list_domains(stats: DataFrame) -> DataFrame:
    return stats.select("domain", "pages_count", "unique_authors", "avg_title_length", "last_updated")


def pages_of_user(pages: DataFrame, user_id: str, limit: int = 100) -> DataFrame:
    return _newest(pages.where(F.col("user_id") == user_id), limit)


def page(details: DataFrame, page_id: str) -> DataFrame:
    """The page, or no row."""
    return details.where(F.col("page_id") == page_id)


def pages_of_domain(pages: DataFrame, domain: str, from_ts=None, to_ts=None, limit: int = 100) -> DataFrame:
    """A domain's newest pages between two times, both inclusive; either may be left open."""
    rows = pages.where(F.col("domain") == domain)
    if from_ts is not None:
        rows = rows.where(F.col("created_at") >= instant(from_ts))
    if to_ts is not None:
        rows = rows.where(F.col("created_at") <= instant(to_ts))
    return _newest(rows, limit)


def _newest(pages: DataFrame, limit: int) -> DataFrame:
    return pages.orderBy(F.col("created_at").desc(), F.col("page_id")).limit(limit)
