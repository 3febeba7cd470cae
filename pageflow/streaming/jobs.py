"""The streaming jobs. Each takes a stream of events, its sinks, and a checkpoint of its own.

Triggers are given as keywords of `trigger` (processingTime, availableNow); default one minute.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from pageflow.functions.durations import seconds
from pageflow.operators import bots, clean, domains, spam, spikes, views
from pageflow.operators.upsert import latest
from pageflow.schema import FIRST_TITLES, LANGUAGE_ACTIVITY, TABLE_KEYS
from pageflow.streaming.sinks import BATCH, archive_sink, dated, read_rows, table_sink

EVERY_MINUTE = {"processingTime": "1 minute"}


def start_each_batch(rows: DataFrame, handle, checkpoint: str, mode: str, trigger: dict,
                     once: bool = False) -> StreamingQuery:
    """Calls handle(rows, batch_id) for each micro-batch that has rows, which are cached for it unless read `once`."""
    def process(batch: DataFrame, batch_id: int) -> None:
        if once:
            handle(batch, batch_id)
            return
        batch.persist()
        try:
            if not batch.isEmpty():
                handle(batch, batch_id)
        finally:
            batch.unpersist()

    return (
        rows.writeStream.foreachBatch(process).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or EVERY_MINUTE)).start())


def state_partitions(spark: SparkSession) -> int:
    """Partitions for a stream's state: `spark.sql.shuffle.partitions`, but two a core at most.

    Each partition keeps a state store or more for every operator, opened and committed in every micro-batch however few its
    rows; adaptive execution, which would merge small ones, does not apply to state. As cores may yet come where Spark
    allocates them as needed, the number is then left as set.
    """
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if spark.conf.get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return most
    return min(most, 2 * spark.sparkContext.defaultParallelism)


def start_stateful(rows: DataFrame, handle, checkpoint: str, mode: str, trigger: dict) -> StreamingQuery:
    """`start_each_batch` for a stream with state. Its checkpoint keeps the number of partitions it was first started with."""
    spark = rows.sparkSession
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", state_partitions(spark))
    try:
        return start_each_batch(rows, handle, checkpoint, mode, trigger)  # the query takes a copy of the settings
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def start_ingest(raw: DataFrame, sink, reject_sink, checkpoint: str, **trigger) -> StreamingQuery:
    """Raw messages cleaned on their way in: kept ones as (key, value), unsound ones apart.

    A micro-batch is examined once; both outputs come from the cached result.
    """
    def publish(messages: DataFrame, batch_id: int) -> None:
        sink(clean.kept(messages).select("key", "value"), batch_id)
        reject_sink(clean.rejected(messages), batch_id)

    return start_each_batch(clean.examined(raw), publish, checkpoint, "append", trigger)


def start_archive(events: DataFrame, path: str, checkpoint: str, files_per_day: int | None = None,
                  **trigger) -> StreamingQuery:
    return start_each_batch(events, archive_sink(path, files_per_day), checkpoint, "append", trigger, once=True)


def start_archive_files(events: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """The archive through Spark's own file sink: its log under `path` names the files of finished micro-batches, and readers
    of `path` take no others, so each event is there once also after a restart. Such a folder is read as a whole, by
    `spark.read.parquet(path)`, which prunes by year, month and day."""
    return (
        dated(events).writeStream.format("parquet").partitionBy("year", "month", "day").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or EVERY_MINUTE)).start())


def start_bot_activity(events: DataFrame, metrics_sink, alert_sink, checkpoint: str, window: str = "1 minute",
                       k: int = 5, threshold: float = 80.0, delay: str = "1 minute",
                       min_pages: int | None = None, **trigger) -> StreamingQuery:
    """Metrics and high-bot alerts of each window, once it is closed.

    Users are counted in the stream; their ranking runs on the counts of the closed windows.
    """
    def publish(counts: DataFrame, batch_id: int) -> None:
        metrics = bots.bot_metrics(counts, k).persist()
        try:
            metrics_sink(metrics, batch_id)
            alert_sink(bots.high_bot_alerts(metrics, threshold, min_pages), batch_id)
        finally:
            metrics.unpersist()

    counts = bots.user_counts(events.withWatermark("event_time", delay), window)
    return start_stateful(counts, publish, checkpoint, "append", trigger)


def start_bot_spam(events: DataFrame, sink, checkpoint: str, window: str = "10 minutes",
                   slide: str = "1 minute", threshold: int = 50, delay: str = "2 minutes",
                   **trigger) -> StreamingQuery:
    """Bot spam as soon as a count passes the threshold, and again as it grows."""
    spam_rows = bots.bot_spam_stream(events.withWatermark("event_time", delay), window, slide, threshold)
    return start_stateful(spam_rows, sink, checkpoint, "update", trigger)


def start_domain_activity(events: DataFrame, activity_path: str, stats_path: str, checkpoint: str,
                          window: str = "1 minute", delay: str = "1 minute", **trigger) -> StreamingQuery:
    """Domain activity with trend, and each domain's latest figures, as keyed tables.

    The stored windows next to the changed ones are read back and merged with them, so a
    window's trend sees its predecessor also when both arrive together, and is put right when
    the predecessor changes later. The table thus ends up equal to the batch result.
    """
    step = F.make_dt_interval(secs=F.lit(seconds(window)))
    keys = TABLE_KEYS["language_activity"]
    write_activity, write_stats = table_sink(activity_path, "window_start"), table_sink(stats_path)

    def publish(windows: DataFrame, batch_id: int) -> None:
        changed = domains.activity_rows(windows)
        start = F.col("window_start")
        first, last, day, until = changed.select(
            F.min(start) - step, F.max(start) + step, F.to_date(F.min(start) - step), F.to_date(F.max(start) + step)).first()
        # Of the days in question only the windows next to the changed ones; the files' statistics rule out the others.
        stored = latest(
            read_rows(changed.sparkSession, activity_path, LANGUAGE_ACTIVITY, "window_start", (day, until)).where(
                start.between(F.lit(first), F.lit(last))), keys, [BATCH]).drop(BATCH, "trend_percent")
        merged = latest(
            stored.withColumn("arrival", F.lit(0)).unionByName(changed.withColumn("arrival", F.lit(1))),
            keys, ["arrival"])
        earlier = F.lag("arrival", 1, 0).over(Window.partitionBy("domain").orderBy("window_start"))
        rows = domains.with_trend(merged, window).withColumn("earlier", earlier).where(
            (F.col("arrival") == 1) | (F.col("earlier") == 1)).drop("arrival", "earlier").persist()
        try:
            write_activity(rows, batch_id)
            write_stats(domains.domain_latest(rows), batch_id)
        finally:
            rows.unpersist()

    windows = domains.activity_windows(events.withWatermark("event_time", delay), window)
    return start_stateful(windows, publish, checkpoint, "update", trigger)


def start_domain_trend(events: DataFrame, sink, checkpoint: str, window: str = "1 minute", delay: str = "1 minute",
                       **trigger) -> StreamingQuery:
    """Activity and trend of closed windows, each once, from Spark's state alone."""
    rows = domains.trend_stream(events.withWatermark("event_time", delay), window)
    return start_stateful(rows, sink, checkpoint, "append", trigger)


def start_domain_sketches(events: DataFrame, sink, checkpoint: str, window: str = "1 minute", delay: str = "1 minute",
                          **trigger) -> StreamingQuery:
    """Mergeable figures of closed windows, each once, from which `activity_of_sketches` makes those of longer windows."""
    rows = domains.domain_sketches(events.withWatermark("event_time", delay), window)
    return start_stateful(rows, sink, checkpoint, "append", trigger)


def start_spam_alerts(events: DataFrame, sink, checkpoint: str, window: str = "5 minutes", delay: str = "2 minutes",
                      rules: dict | None = None, **trigger) -> StreamingQuery:
    """Spam alerts as soon as a user's window qualifies, and again as it fills; `rules` are keywords of `spam_alerts`.

    Spark's state has flags, a count and the set of domains for each user and window, until the watermark closes it.
    """
    alerts = spam.spam_alerts(events.withWatermark("event_time", delay), window, **(rules or {}))
    return start_stateful(alerts, sink, checkpoint, "update", trigger)


def start_spam_messages(events: DataFrame, sink, checkpoint: str, window: str = "5 minutes", delay: str = "2 minutes",
                        rules: dict | None = None, part_size: int = spam.TITLES_PER_PART, salts: int = 16,
                        **trigger) -> StreamingQuery:
    """Alerts of closed windows as messages with all their titles, each once.

    The titles wait in the state of a join with the closed windows, a row each. All pages of a window come out with it, in
    one micro-batch, so its messages are put together there.
    """
    rows = spam.alert_pages(events.withWatermark("event_time", delay), window, salts, **(rules or {}))
    return start_stateful(
        rows, lambda pages, batch_id: sink(spam.messages_of_pages(pages, part_size), batch_id), checkpoint, "append", trigger)


def start_first_titles(events: DataFrame, path: str, checkpoint: str, slide: str = "5 minutes", samples: int = 5,
                       exclude_namespaces=(), **trigger) -> StreamingQuery:
    """Keeps, for each micro-batch, the earliest titles of each domain and slide as the table `path`. Has no state."""
    keep = table_sink(path, "pane")

    def publish(batch: DataFrame, batch_id: int) -> None:
        keep(spikes.first_titles(spikes.placed_titles(batch, slide, exclude_namespaces), samples), batch_id)

    return start_each_batch(events, publish, checkpoint, "append", trigger, once=True)


def start_activity_spikes(events: DataFrame, sink, titles: str, checkpoint: str, window: str = "1 hour",
                          slide: str = "5 minutes", threshold: float | None = 3.0, delay: str = "5 minutes",
                          samples: int = 5, min_baseline: float | None = None, exclude_namespaces=(),
                          **trigger) -> StreamingQuery:
    """Spikes as soon as a window is one, and again as it changes, with the sample titles that the table `titles` has by then.

    Spark's state has two counts for each domain and window. `titles` is kept by `start_first_titles`; where that is
    behind, `sampled_spikes` gives stored spikes the samples known at the time of reading.
    """
    rows = spikes.spike_stream(events.withWatermark("event_time", delay), window, slide, threshold, min_baseline, exclude_namespaces)
    return start_stateful(
        rows, lambda found, batch_id: sink(sampled_spikes(found, titles, slide, samples), batch_id), checkpoint, "update", trigger)


def start_closed_spikes(events: DataFrame, sink, titles: str, checkpoint: str, window: str = "1 hour",
                        slide: str = "5 minutes", threshold: float | None = 3.0, delay: str = "5 minutes",
                        samples: int = 5, min_baseline: float | None = None, exclude_namespaces=(),
                        **trigger) -> StreamingQuery:
    """Spikes of closed windows, each once. Takes less than `start_activity_spikes`, as no page is copied into windows."""
    rows = spikes.closed_spike_stream(
        events.withWatermark("event_time", delay), window, slide, threshold, min_baseline, exclude_namespaces)
    return start_stateful(
        rows, lambda found, batch_id: sink(sampled_spikes(found, titles, slide, samples), batch_id), checkpoint, "append", trigger)


def sampled_spikes(found: DataFrame, titles: str, slide: str = "5 minutes", samples: int = 5) -> DataFrame:
    """Spikes with the sample titles that the table `titles` has now, of which only the days in question are read."""
    spark, pane = found.sparkSession, spikes.newest_pane(slide)
    days = found.select(F.to_date(F.min(pane)), F.to_date(F.max(pane))).first()
    between = None if days[0] is None else tuple(days)
    stored = read_rows(spark, titles, FIRST_TITLES, "pane", between)
    return spikes.with_samples(found.drop("sample_pages"), spikes.merged_titles(stored, samples), slide)


def start_views(events: DataFrame, sinks: dict, checkpoint: str, **trigger) -> StreamingQuery:
    """The page views named in `sinks`, all written from one reading of each micro-batch."""
    def publish(pages: DataFrame, batch_id: int) -> None:
        for name, sink in sinks.items():
            sink(views.VIEWS[name](pages), batch_id)

    return start_each_batch(views.listed_pages(events), publish, checkpoint, "append", trigger)


def run_until_any_stops(spark: SparkSession) -> None:
    """Waits until one of the session's queries ends, then stops the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in spark.streams.active:
            query.stop()


def dropped_late_rows(query: StreamingQuery) -> int:
    """Rows the query has dropped so far for being later than its watermark (recent progress)."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"])
