"""Domain activity per window, its trend, and the latest figures of each domain."""

from pyspark.sql import DataFrame, Window, functions as F

from pageflow.functions.durations import seconds
from pageflow.functions.ratios import percent_change
from pageflow.operators.clean import present


# Base-two logarithm of a sketch's registers: 1.04 / sqrt(2^12) is the standard error.
LG_K = 12


def activity_windows(events: DataFrame, window: str = "1 minute", exact: bool = False) -> DataFrame:
    """Pages, distinct authors and mean title length per (window, domain). Streams need exact=False.

    Authors are counted by a sketch of bounded size unless `exact`; the exact count first groups by author, so that a hot
    domain is spread over all tasks. The sketch's standard error is 1.6 %, and it counts up to some hundreds exactly,
    as it holds the hashes themselves until there are more than its registers would take.
    """
    authors = F.count_distinct("user_name") if exact else F.hll_sketch_estimate(F.hll_sketch_agg("user_name", F.lit(LG_K)))
    return present(events, "domain").groupBy(F.window("event_time", window), "domain").agg(
        F.count("*").alias("pages"),
        authors.alias("authors"),
        F.round(F.avg(F.length("page_title")), 2).alias("avg_title_length"))


def activity_rows(windows: DataFrame) -> DataFrame:
    return windows.select(
        "domain",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("pages").alias("pages_count"),
        F.col("authors").alias("unique_authors"),
        "avg_title_length")


def domain_activity(events: DataFrame, window: str = "1 minute", exact: bool = False) -> DataFrame:
    return activity_rows(activity_windows(events, window, exact))


def domain_sketches(events: DataFrame, window: str = "1 minute") -> DataFrame:
    """What longer windows need of each (window, domain), to be stored: counts, and the authors as a mergeable sketch."""
    return present(events, "domain").groupBy(F.window("event_time", window), "domain").agg(
        F.count("*").alias("pages"),
        F.hll_sketch_agg("user_name", F.lit(LG_K)).alias("authors"),
        F.sum(F.length("page_title")).alias("title_chars"),
        F.count("page_title").alias("titles")
    ).select("domain", F.col("window.start").alias("window_start"), "pages", "authors", "title_chars", "titles")


def activity_of_sketches(sketches: DataFrame, window: str) -> DataFrame:
    """Domain activity of longer windows, any multiple of the stored ones, without the events."""
    merged = sketches.groupBy(F.window("window_start", window), "domain").agg(
        F.sum("pages").alias("pages"),
        F.hll_sketch_estimate(F.hll_union_agg("authors")).alias("authors"),
        F.round(F.sum("title_chars") / F.sum("titles"), 2).alias("avg_title_length"))
    return activity_rows(merged)


def trend_stream(events: DataFrame, window: str = "1 minute") -> DataFrame:
    """Activity of a stream's closed windows with their trend: two aggregated streams joined on the time of their windows.

    `events` has a watermark. A window comes once, when it and the one before are closed; where there is none before, when the
    watermark shows that none will come. Nothing is read back from a table.
    """
    step = F.expr(f"INTERVAL {seconds(window)} SECONDS")  # a literal, from which Spark can tell how long to keep rows
    # The one event-time column of each side.
    now = activity_windows(events, window).select(
        "domain", F.window_time("window").alias("at"), F.col("pages").alias("pages_count"),
        F.col("authors").alias("unique_authors"), "avg_title_length")
    before = activity_windows(events, window).select(
        F.col("domain").alias("same"), F.window_time("window").alias("earlier"), F.col("pages").alias("earlier_count"))
    due = F.col("earlier") + step
    joined = now.join(before, (F.col("domain") == F.col("same")) & (F.col("at") >= due) & (F.col("at") <= due), "left")
    # The time of a window is its last microsecond.
    end = F.col("at") + F.expr("INTERVAL '0.000001' SECOND")
    return joined.select(
        "domain", (end - step).alias("window_start"), end.alias("window_end"), "pages_count", "unique_authors", "avg_title_length",
        percent_change(F.col("pages_count"), F.col("earlier_count")).alias("trend_percent"))


def with_trend(activity: DataFrame, step: str = "1 minute", previous: DataFrame | None = None) -> DataFrame:
    """Adds trend_percent, the change against the window exactly one `step` earlier.

    0.0 where that window is missing or empty; an older window does not stand in for it.
    With `previous` the earlier windows are looked up in that table. Without, they are in
    `activity` itself, and one pass over each domain's windows (aggregated rows, a few per
    step) finds them without computing the activity twice.
    """
    count = F.col("pages_count")
    back = F.make_dt_interval(secs=F.lit(seconds(step)))
    if previous is not None:
        earlier = previous.select(
            "domain", (F.col("window_start") + back).alias("window_start"),
            count.alias("earlier_count"))
        rows = activity.join(earlier, ["domain", "window_start"], "left")
    else:
        by_time = Window.partitionBy("domain").orderBy("window_start")
        adjacent = F.lag("window_start").over(by_time) == F.col("window_start") - back
        rows = activity.withColumn("earlier_count", F.when(adjacent, F.lag("pages_count").over(by_time)))
    trend = percent_change(count, F.col("earlier_count"))
    return rows.select(*activity.columns, trend.alias("trend_percent"))


def domain_latest(activity: DataFrame) -> DataFrame:
    """The figures of each domain's newest window."""
    newest = F.max_by(F.struct("pages_count", "unique_authors", "avg_title_length"), "window_end")
    return activity.groupBy("domain").agg(
        newest.alias("newest"), F.max("window_end").alias("last_updated")
    ).select("domain", "newest.*", "last_updated")
