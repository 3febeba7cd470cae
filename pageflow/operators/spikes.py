"""Domains whose newest slide of a sliding window far exceeds the rest of the window."""

from pyspark.sql import DataFrame, functions as F

from pageflow.functions.durations import panes_per_window, seconds
from pageflow.functions.ranking import in_rank_order, top_per_group
from pageflow.functions.ratios import ratio
from pageflow.functions.skew import spread_join
from pageflow.functions.sliding import pane_start
from pageflow.operators.alerts import alert_time
from pageflow.operators.clean import present

# Fixed value: alert type.
ACTIVITY_SPIKE = "activity_spike"

# Tasks that a hot slide's titles are ranked in before their best are ranked together.
PIECES = 32


def activity_spikes(events: DataFrame, window: str = "1 hour", slide: str = "5 minutes",
                    threshold: float | None = 3.0, samples: int = 5,
                    min_baseline: float | None = None, exclude_namespaces=()) -> DataFrame:
    """Windows whose last slide has more than `threshold` times the mean of the other slides.

    Events are counted per slide first; only those counts are copied into windows. The sample is the slide's
    `samples` earliest titles: once the spikes are known, the titles of their last slides alone are ranked, each task
    sending on no more than that many per slide. threshold=None reports every window.
    """
    titled = placed_titles(events, slide, exclude_namespaces)
    found = spikes_of(pane_counts(titled), window, slide, threshold, min_baseline)
    sought = found.select("domain", newest_pane(slide).alias("pane"))
    piece = F.pmod(F.xxhash64("event_time", "page_title"), F.lit(PIECES))
    hits = spread_join(titled, sought, ["domain", "pane"], piece)
    best = top_per_group(hits, ["domain", "pane", "piece"], ["event_time", "page_title"], samples).drop("rn")
    return with_samples(found, first_titles(best, samples), slide)


def counted_pages(events: DataFrame, exclude_namespaces=()) -> DataFrame:
    titled = present(events, "page_title", "domain", "event_time")
    for namespace in exclude_namespaces:
        titled = titled.where(~F.col("page_title").startswith(f"{namespace}:"))
    return titled


def placed_titles(events: DataFrame, slide: str, exclude_namespaces=()) -> DataFrame:
    """domain, pane (start of the slide), event_time and page_title of the pages that count."""
    return counted_pages(events, exclude_namespaces).select("domain", pane_start(slide).alias("pane"), "event_time", "page_title")


def pane_counts(titled: DataFrame) -> DataFrame:
    return titled.groupBy("domain", "pane").agg(F.count("*").alias("pages"))


def first_titles(titled: DataFrame, samples: int) -> DataFrame:
    """The `samples` earliest pages of each domain and pane, as an array of (event_time, page_title)."""
    first = top_per_group(titled, ["domain", "pane"], ["event_time", "page_title"], samples)
    return first.groupBy("domain", "pane").agg(in_rank_order(F.struct("event_time", "page_title")).alias("titles"))


def merged_titles(stored: DataFrame, samples: int) -> DataFrame:
    """First titles of several stretches of the input made into one row for each domain and pane."""
    titles = F.slice(F.sort_array(F.flatten(F.collect_list("titles"))), 1, samples)
    return stored.groupBy("domain", "pane").agg(titles.alias("titles"))


def spikes_of(panes: DataFrame, window: str, slide: str, threshold: float | None, min_baseline: float | None) -> DataFrame:
    """The spikes that (domain, pane, pages) hold."""
    width, step = seconds(window), seconds(slide)
    copies = panes.select("domain", "pane", "pages", F.explode(F.array(*[F.lit(o) for o in range(0, width, step)])).alias("offset"))
    newest = F.col("offset") == width - step
    start = F.timestamp_seconds(F.unix_seconds("pane") - F.col("offset"))
    windows = copies.groupBy("domain", start.alias("window_start")).agg(
        F.sum("pages").alias("pages"), F.sum(F.when(newest, F.col("pages")).otherwise(0)).alias("recent"))
    end = F.timestamp_seconds(F.unix_seconds("window_start") + width)
    return score_spikes(windows.withColumn("window_end", end), panes_per_window(window, slide), threshold, min_baseline)


def spike_stream(events: DataFrame, window: str, slide: str, threshold: float | None = 3.0,
                 min_baseline: float | None = None, exclude_namespaces=()) -> DataFrame:
    """The spikes of a stream with a watermark, as one aggregation: the window becomes a column first, so that pages of its
    last slide can be counted beside all. Counts are combined before the shuffle; the state is two numbers a window."""
    placed = counted_pages(events, exclude_namespaces).select("domain", "event_time", F.window("event_time", window, slide).alias("w"))
    recent = F.col("event_time") >= F.col("w.end") - F.make_dt_interval(secs=F.lit(seconds(slide)))
    windows = placed.groupBy("w", "domain").agg(F.count("*").alias("pages"), F.count_if(recent).alias("recent"))
    return _scored_stream(windows, window, slide, threshold, min_baseline)


def closed_spike_stream(events: DataFrame, window: str, slide: str, threshold: float | None = 3.0,
                        min_baseline: float | None = None, exclude_namespaces=()) -> DataFrame:
    """The same for closed windows alone, as two aggregations one after the other: pages are counted per slide, and closed
    slides, a row each, go into the windows they lie in. No page is copied; the watermark is handed on."""
    panes = counted_pages(events, exclude_namespaces).groupBy(F.window("event_time", slide).alias("pane"), "domain").agg(
        F.count("*").alias("pages")).select("domain", "pages", F.window_time("pane").alias("at"))
    recent = F.col("at") >= F.col("w.end") - F.make_dt_interval(secs=F.lit(seconds(slide)))
    windows = panes.select("domain", "pages", "at", F.window("at", window, slide).alias("w")).groupBy("w", "domain").agg(
        F.sum("pages").alias("pages"), F.sum(F.when(recent, F.col("pages")).otherwise(0)).alias("recent"))
    return _scored_stream(windows, window, slide, threshold, min_baseline)


def _scored_stream(windows: DataFrame, window: str, slide: str, threshold, min_baseline) -> DataFrame:
    rows = windows.select("domain", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "pages", "recent")
    return score_spikes(rows, panes_per_window(window, slide), threshold, min_baseline)


def newest_pane(slide: str):
    return F.timestamp_seconds(F.unix_seconds("window_end") - seconds(slide))


def with_samples(found: DataFrame, titles: DataFrame, slide: str) -> DataFrame:
    """The spikes with the titles of their last slide."""
    sample = F.transform("titles", lambda t: t["page_title"])
    return found.withColumn("pane", newest_pane(slide)).join(titles, ["domain", "pane"], "left").select(
        *found.columns, F.coalesce(sample, F.array().cast("array<string>")).alias("sample_pages"))


def score_spikes(windows: DataFrame, panes: int, threshold, min_baseline=None) -> DataFrame:
    """Mean of the earlier slides (1 if there were none or it is zero) and the ratio to it."""
    mean = ratio(F.col("pages") - F.col("recent"), F.lit(panes - 1))
    baseline = F.when(mean > 0, mean).otherwise(F.lit(1.0))
    if min_baseline is not None:
        baseline = F.greatest(baseline, F.lit(float(min_baseline)))
    scored = windows.withColumn("baseline", baseline).select(
        "domain", "window_start", "window_end",
        F.col("pages").alias("pages_last_1hour"),
        F.col("recent").alias("pages_last_5min"),
        F.col("baseline").alias("avg_pages_per_5min"),
        ratio(F.col("recent"), F.col("baseline")).alias("spike_ratio"))
    return scored if threshold is None else scored.where(F.col("spike_ratio") > threshold)


def spike_alerts(spikes: DataFrame) -> DataFrame:
    return spikes.select(
        alert_time(F.col("window_end")), F.lit(ACTIVITY_SPIKE).alias("alert_type"), "domain",
        "pages_last_5min", "avg_pages_per_5min", "spike_ratio", "sample_pages")
