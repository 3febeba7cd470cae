"""Behaviour of human editors over all their pages."""

from pyspark.sql import DataFrame, Window, functions as F

from pageflow.functions.ratios import ratio
from pageflow.operators.clean import present


def human_pages(events: DataFrame) -> DataFrame:
    return present(events, "user_name").where(~F.col("user_is_bot"))


def editor_parts(events: DataFrame) -> DataFrame:
    """What `patterns_of` needs of each (editor, domain): counts, first and last time, hours.

    Hours are a 24-bit mask, so one hash aggregation over fixed-width values carries it all.
    """
    at = F.unix_seconds("event_time")
    return human_pages(events).groupBy("user_name", "domain").agg(
        F.count("*").alias("pages"),
        F.count("event_time").alias("timed"),
        F.min(at).alias("first"),
        F.max(at).alias("last"),
        F.bit_or(F.expr("shiftleft(1, hour(event_time))")).alias("hours"))


def merge_parts(parts: DataFrame) -> DataFrame:
    """Parts of several stretches of the history, such as stored daily ones, made into one.

    A profile of the whole history can so be kept up without reading the old events again.
    """
    return parts.groupBy("user_name", "domain").agg(
        F.sum("pages").alias("pages"),
        F.sum("timed").alias("timed"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.bit_or("hours").alias("hours"))


def patterns_of(parts: DataFrame, min_pages: int = 5) -> DataFrame:
    """Profiles from one part per (editor, domain).

    The gaps between sorted times add up to last minus first, so their mean needs no sort.
    Of equally used domains the first by name is the main one.
    """
    per_user = parts.groupBy("user_name").agg(
        F.sum("pages").alias("total"),
        F.sum("timed").alias("timed"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.bit_or("hours").alias("hours"),
        F.count("domain").alias("domains"),
        F.min_by("domain", F.struct(-F.col("pages"), "domain")).alias("specialization"))
    mean_gap = ratio(F.col("last") - F.col("first"), F.when(F.col("timed") > 1, F.col("timed") - 1))
    return per_user.where(F.col("total") >= min_pages).select(
        "user_name",
        F.coalesce(mean_gap, F.lit(0.0)).alias("avg_gap_seconds"),
        F.expr("filter(sequence(0, 23), h -> coalesce(hours, 0) & shiftleft(1, h) != 0)").alias("active_hours"),
        F.col("domains").alias("domains_count"),
        "specialization",
        F.col("total").alias("total_pages"))


def editor_patterns(events: DataFrame, min_pages: int = 5) -> DataFrame:
    """Pages, mean gap between pages, active hours, domains and main domain of each editor."""
    return patterns_of(editor_parts(events), min_pages)


def creation_gaps(events: DataFrame) -> DataFrame:
    """Each human page with the whole seconds since its editor's previous one (NULL for the first).

    An editor's history is cut by hour, so that a very busy editor is spread over many tasks;
    an hour's first page takes its predecessor from the editor's previous active hour, found
    among one row per hour.
    """
    hour = ["user_name", "hour"]
    pages = present(human_pages(events), "event_time").select(
        "user_name", F.date_trunc("hour", "event_time").alias("hour"), "page_id", "event_time")
    last_of_hour = pages.groupBy(*hour).agg(F.max("event_time").alias("last"))
    carried = last_of_hour.select(
        *hour, F.lag("last").over(Window.partitionBy("user_name").orderBy("hour")).alias("carried"))
    in_hour = Window.partitionBy(*hour).orderBy("event_time", "page_id")
    linked = pages.withColumn("before", F.lag("event_time").over(in_hour)).join(carried, hour)
    before = F.unix_seconds(F.coalesce("before", "carried"))
    return linked.select(
        "user_name", "page_id", "event_time",
        (F.unix_seconds("event_time") - before).alias("gap_seconds"))
