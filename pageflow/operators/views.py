"""Views of the pages for lookups by user, by page and by domain."""

from pyspark.sql import DataFrame, functions as F

from pageflow.operators.clean import present


def listed_pages(events: DataFrame) -> DataFrame:
    """Pages that can be listed. Anonymous users, who have no id, go by their name."""
    named = events.select(
        "page_id", "page_title", "domain", "user_name",
        F.coalesce("user_id", "user_name").alias("user_id"),
        F.col("event_time").alias("created_at"))
    return present(named, "page_id", "domain", "user_id")


def pages_by_user(pages: DataFrame) -> DataFrame:
    return pages.select("user_id", "created_at", "page_id", "page_title", "domain")


def page_details(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "page_title", "domain", "user_name", "created_at")


def pages_by_domain(pages: DataFrame) -> DataFrame:
    return pages.select("domain", "created_at", "page_id", "page_title", "user_name")


VIEWS = {
    "pages_by_user": pages_by_user,
    "page_details": page_details,
    "pages_by_domain": pages_by_domain,
}
