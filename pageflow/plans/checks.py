"""The registered queries: every operator over the shared `events` table, read as page creations.

The table is sparse (a few hundred events per day and domain at the smallest scale), so some
queries widen the windows; the operators' defaults are the production values.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, TimestampType

from pageflow.operators import (
    alerts, bots, clean, domains, editors, reports, serving, spam, spikes, upsert, views)
from pageflow.plans import batch
from pageflow.schema import LANGUAGE_ACTIVITY, PAGES, SKETCHES, TABLE_KEYS
from pageflow.session import configure, scratch_dir
from pageflow.sources.files import file_source, read_archive
from pageflow.sources.samples import mixed_messages, page_creates, raw_messages
from pageflow.streaming import jobs, sinks, versions

NOW = {"availableNow": True}

# Looked-up keys.
DOMAIN, USER, PAGE = "click", "7", "42"
FROM, TO = "2024-01-05 00:00:00", "2024-01-12 12:00:00"


def plain(rows: DataFrame) -> DataFrame:
    """Times without a zone and arrays of strings as text, to compare with other engines."""
    def column(field):
        if isinstance(field.dataType, TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, ArrayType):
            return F.array_join(field.name, "|").alias(field.name)
        return F.col(field.name)

    return rows.select(*[column(f) for f in rows.schema])


def creates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_creates(spark.read.parquet(f"{sf_dir}/events.parquet"))


def creates_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as a stream, through messages and the parser. All come in one micro-batch."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = file_source(spark, f"{sf_dir}/{{events.parquet}}", schema)
    return clean.parse_events(raw_messages(page_creates(events)))


# An event after all others, which lets the watermark close their windows.
CLOSING = "closing"


def run_in_turns(spark: SparkSession, sf_dir: str, *starts, closing: bool = False) -> None:
    """Feeds the events to streaming jobs in three stretches of time. Each job is started anew for every stretch, goes on from
    its checkpoint, and ends with the files there are. starts: functions (events, checkpoint) -> query, run one by one."""
    path, events = scratch_dir(spark, "feed"), spark.read.parquet(f"{sf_dir}/events.parquet")
    parts = [events.where(at) for at in _thirds(events)]
    if closing:
        parts.append(_closing_event(events))
    checkpoints = [scratch_dir(spark, "checkpoint") for _ in starts]
    for part in parts:
        part.write.mode("append").parquet(path)
        for start, checkpoint in zip(starts, checkpoints):
            feed = clean.parse_events(raw_messages(page_creates(file_source(spark, path, events.schema))))
            start(feed, checkpoint).awaitTermination()


def _thirds(events: DataFrame) -> list:
    """Conditions that cut the events into three stretches of time; those without a time are in the first."""
    first, second = events.agg(F.percentile_approx("ts", [1 / 3, 2 / 3])).first()[0] or (None, None)
    if first is None:
        return [F.lit(True), F.lit(False), F.lit(False)]
    ts, a, b = F.col("ts"), F.lit(first), F.lit(second)
    return [F.coalesce(ts < a, F.lit(True)), (ts >= a) & (ts < b), ts >= b]


def _closing_event(events: DataFrame) -> DataFrame:
    """A page by a person, of a domain of its own, a year after the last event."""
    late = events.agg((F.max("ts") + F.expr("INTERVAL 366 DAYS")).alias("ts"))
    values = {"event_id": F.lit(1), "user_id": F.lit(1), "event_type": F.lit(CLOSING), "ts": F.col("ts")}
    return late.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in events.schema])


def _last_time(events: DataFrame) -> str:
    return events.agg(F.max("event_time").cast("string")).first()[0]


# -- parsing and cleaning -------------------------------------------------------------------

def parse_events(spark, sf_dir):
    return clean.parse_events(raw_messages(creates(spark, sf_dir)), require=("page_id",))


def clean_raw(spark, sf_dir):
    return clean.clean_raw(mixed_messages(creates(spark, sf_dir)))


def clean_rejects(spark, sf_dir):
    return clean.split_rejects(mixed_messages(creates(spark, sf_dir)))[1]


# -- bots -----------------------------------------------------------------------------------

def bot_activity(spark, sf_dir):
    return bots.bot_activity(creates(spark, sf_dir), "1 hour")


def bot_activity_minute(spark, sf_dir):
    return bots.bot_activity(creates(spark, sf_dir))


def high_bot_alerts(spark, sf_dir):
    return bots.high_bot_alerts(bots.bot_shares(creates(spark, sf_dir)))


def high_bot_alerts_min_pages(spark, sf_dir):
    return bots.high_bot_alerts(bots.bot_shares(creates(spark, sf_dir), "1 hour"), threshold=20.0, min_pages=5)


def bot_alert_messages(spark, sf_dir):
    return alerts.to_alert_json(bots.high_bot_alerts(bot_activity(spark, sf_dir), threshold=20.0))


def bot_spam_wide(spark, sf_dir):
    """Windows of 240 slides."""
    return bots.bot_spam(creates(spark, sf_dir), "10 days", "1 hour", 5, method="panes")


def bot_spam(spark, sf_dir):
    return bots.bot_spam(creates(spark, sf_dir), "10 days", "1 day", 5)


def bot_spam_minutes(spark, sf_dir):
    return bots.bot_spam_alerts(bots.bot_spam(creates(spark, sf_dir), threshold=1))


# -- domains --------------------------------------------------------------------------------

def _with_close(rows, exact, *keys):
    """For the sketch's estimate of the authors, whether it is within 5 % (three standard errors) of their number: up to
    19 authors it must be their number."""
    known = exact.select(*keys, F.col("unique_authors").alias("authors"))
    close = F.abs(F.col("unique_authors") - F.col("authors")) * 100 <= F.col("authors") * 5
    return rows.join(known, list(keys)).withColumn("close", close).drop("unique_authors", "authors")


def domain_activity(spark, sf_dir):
    events = creates(spark, sf_dir)
    return _with_close(domains.domain_activity(events, "1 hour"), domains.domain_activity(events, "1 hour", exact=True),
                       "domain", "window_start")


def domain_activity_exact(spark, sf_dir):
    return domains.domain_activity(creates(spark, sf_dir), "1 day", exact=True)


def domain_trend(spark, sf_dir):
    return domains.with_trend(domain_activity_exact(spark, sf_dir), "1 day")


def domain_trend_minute(spark, sf_dir):
    return domains.with_trend(domains.domain_activity(creates(spark, sf_dir), exact=True))


def domain_trend_joined(spark, sf_dir):
    """The trend against a stored table, here the same one."""
    activity = domain_activity_exact(spark, sf_dir)
    return domains.with_trend(activity, "1 day", previous=activity)


def domain_activity_sketch(spark, sf_dir):
    return _with_close(domains.domain_activity(creates(spark, sf_dir), "1 day"), domain_activity_exact(spark, sf_dir),
                       "domain", "window_start")


def domain_activity_from_sketches(spark, sf_dir):
    """Days from the sketches of single minutes that a stream has stored, and the events no more."""
    path = scratch_dir(spark, "sketches")
    run_in_turns(spark, sf_dir, lambda events, checkpoint: jobs.start_domain_sketches(
        events, sinks.table_sink(path, "window_start"), checkpoint, **NOW), closing=True)
    minutes = sinks.read_rows(spark, path, SKETCHES, "window_start").drop(sinks.BATCH)
    return _with_close(domains.activity_of_sketches(minutes, "1 day"), domain_activity_exact(spark, sf_dir), "domain", "window_start")


def domain_latest(spark, sf_dir):
    return domains.domain_latest(domain_activity_exact(spark, sf_dir))


# -- spam and spikes ------------------------------------------------------------------------

def spam_alerts(spark, sf_dir):
    return spam.spam_alerts(creates(spark, sf_dir), "1 day")


def spam_alerts_rules(spark, sf_dir):
    return spam.spam_alerts(creates(spark, sf_dir), "10 days", velocity=20)


def spam_alert_messages(spark, sf_dir):
    events = creates(spark, sf_dir)
    found = spam.spam_alerts(events, "1 day")
    return spam.spam_messages(found, spam.spam_titles(events, found, "1 day"))


def spam_alert_titles(spark, sf_dir):
    """One row per title, however many parts an alert has."""
    events = creates(spark, sf_dir)
    found = spam.spam_alerts(events, "10 days", velocity=20)
    titles = spam.spam_titles(events, found, "10 days", part_size=20)
    return titles.select("window_start", "user_name", F.explode("titles").alias("page_title"))


def activity_spikes(spark, sf_dir):
    return spikes.activity_spikes(creates(spark, sf_dir), "12 hours", "1 hour")


def activity_spike_windows(spark, sf_dir):
    return spikes.activity_spikes(creates(spark, sf_dir), "12 hours", "1 hour", threshold=None)


def activity_spikes_minutes(spark, sf_dir):
    return spikes.spike_alerts(spikes.activity_spikes(creates(spark, sf_dir)))


# -- reports and profiles -------------------------------------------------------------------

def hourly_report(spark, sf_dir):
    events = creates(spark, sf_dir)
    return reports.hourly_report(events, _last_time(events))


def hourly_report_history(spark, sf_dir):
    return reports.hourly_report(creates(spark, sf_dir))


def hourly_top_authors(spark, sf_dir):
    return reports.top_authors(reports.author_hours(creates(spark, sf_dir)))


def editor_patterns(spark, sf_dir):
    return editors.editor_patterns(creates(spark, sf_dir))


def editor_patterns_merged(spark, sf_dir):
    """Profiles from parts of two stretches of the history, here even and odd pages."""
    events = creates(spark, sf_dir)
    odd = F.col("page_id").cast("bigint") % 2 == 1
    parts = editors.editor_parts(events.where(odd)).unionByName(editors.editor_parts(events.where(~odd)))
    return editors.patterns_of(editors.merge_parts(parts))


def editor_gap_lag(spark, sf_dir):
    return editors.creation_gaps(creates(spark, sf_dir))


# -- views, reads, keyed tables -------------------------------------------------------------

def pages_by_user(spark, sf_dir):
    return views.pages_by_user(views.listed_pages(creates(spark, sf_dir)))


def page_details(spark, sf_dir):
    return views.page_details(views.listed_pages(creates(spark, sf_dir)))


def pages_by_domain(spark, sf_dir):
    return views.pages_by_domain(views.listed_pages(creates(spark, sf_dir)))


def q_hourly_report(spark, sf_dir):
    return _listed(serving.get_hourly_report(hourly_report_history(spark, sf_dir), DOMAIN))


def _listed(rows):
    """The authors' records as texts."""
    return rows.withColumn("top_authors", F.transform("top_authors", lambda a: F.concat_ws(
        ":", a["name"], a["pages"].cast("string"), a["is_bot"].cast("string"))))


def q_editor_patterns(spark, sf_dir):
    return serving.get_editor_patterns(editors.editor_patterns(creates(spark, sf_dir), min_pages=1), 50)


def q_list_domains(spark, sf_dir):
    return serving.list_domains(domain_latest(spark, sf_dir))


def q_user_pages(spark, sf_dir):
    return serving.pages_of_user(pages_by_user(spark, sf_dir), USER)


def q_page(spark, sf_dir):
    return serving.page(page_details(spark, sf_dir), PAGE)


def q_domain_pages(spark, sf_dir):
    return serving.pages_of_domain(pages_by_domain(spark, sf_dir), DOMAIN)


def q_domain_pages_between(spark, sf_dir):
    return serving.pages_of_domain(pages_by_domain(spark, sf_dir), DOMAIN, FROM, TO, limit=50)


def upsert_latest(spark, sf_dir):
    """Each user's newest page: the first half of the events is the table, the rest the batch."""
    pages = pages_by_user(spark, sf_dir)
    number = F.col("page_id").cast("bigint")
    return upsert.upsert(pages.where(number % 2 == 0), pages.where(number % 2 == 1), ["user_id"], "created_at")


def upsert_batch_wins(spark, sf_dir):
    """Daily domain figures overwritten, for the days it has, by those of the bots alone."""
    events = creates(spark, sf_dir)
    return upsert.upsert(
        domains.domain_activity(events, "1 day", exact=True),
        domains.domain_activity(events.where(F.col("user_is_bot")), "1 day", exact=True),
        TABLE_KEYS["language_activity"])


# -- streams --------------------------------------------------------------------------------

def stream_ingest(spark, sf_dir):
    """The messages kept with their routing keys, and the rejected ones without."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = page_creates(file_source(spark, f"{sf_dir}/{{events.parquet}}", schema))
    path, rejects = scratch_dir(spark, "kept"), scratch_dir(spark, "rejects")
    jobs.start_ingest(
        mixed_messages(events), sinks.table_sink(path), sinks.table_sink(rejects), scratch_dir(spark, "checkpoint"), **NOW
    ).awaitTermination()
    return spark.read.parquet(path).select("value", "key").union(
        spark.read.parquet(rejects).select("value", F.lit(None).cast("string")))


def _archived(spark, sf_dir):
    path = scratch_dir(spark, "archive")
    query = jobs.start_archive(
        creates_stream(spark, sf_dir).drop("page_id", "user_id"), path, scratch_dir(spark, "checkpoint"), **NOW)
    query.awaitTermination()
    return path


def archive_roundtrip(spark, sf_dir):
    return spark.read.parquet(_archived(spark, sf_dir)).select(
        "page_title", "domain", "user_name", "user_is_bot", "event_time", "year", "month", "day")


def archive_between(spark, sf_dir):
    return read_archive(spark, _archived(spark, sf_dir), FROM, TO)


def archive_hourly_report(spark, sf_dir):
    path = _archived(spark, sf_dir)
    return batch.hourly_report_job(spark, path, _last_time(read_archive(spark, path)))


def archive_editor_patterns(spark, sf_dir):
    return batch.editor_patterns_job(spark, _archived(spark, sf_dir))


def editor_patterns_incremental(spark, sf_dir):
    """Profiles from the parts that two runs stored, each of which read only its own days."""
    path, parts = _archived(spark, sf_dir), scratch_dir(spark, "parts")
    for since, until in ((None, FROM), (FROM, None)):
        batch.editor_parts_job(spark, path, parts, since, until)
    return batch.stored_editor_patterns(spark, parts)


# -- reads of tables that jobs wrote --------------------------------------------------------

def _stored_pages(spark, sf_dir, name, key, value):
    path = scratch_dir(spark, "table")
    jobs.start_views(creates_stream(spark, sf_dir), {name: sinks.table_sink(path, bucket_of=key)},
                     scratch_dir(spark, "checkpoint"), **NOW).awaitTermination()
    return sinks.read_table(spark, path, PAGES[name], TABLE_KEYS[name], of=(key, value))


def stored_user_pages(spark, sf_dir):
    return serving.pages_of_user(_stored_pages(spark, sf_dir, "pages_by_user", "user_id", USER), USER)


def stored_page(spark, sf_dir):
    return serving.page(_stored_pages(spark, sf_dir, "page_details", "page_id", PAGE), PAGE)


def stored_domain_pages(spark, sf_dir):
    """A domain's newest pages, from a table that is read from its newest day on."""
    path = _newest_first(spark, sf_dir, "pages_by_domain", "domain")
    rows = sinks.read_newest(spark, path, PAGES["pages_by_domain"], TABLE_KEYS["pages_by_domain"], ("domain", DOMAIN), "created_at", 100)
    return serving.pages_of_domain(rows, DOMAIN)


def stored_domain_pages_between(spark, sf_dir):
    path = _newest_first(spark, sf_dir, "pages_by_domain", "domain")
    rows = sinks.read_newest(spark, path, PAGES["pages_by_domain"], TABLE_KEYS["pages_by_domain"], ("domain", DOMAIN),
                             "created_at", 50, FROM, TO)
    return serving.pages_of_domain(rows, DOMAIN, FROM, TO, limit=50)


def _newest_first(spark, sf_dir, name, key):
    path = scratch_dir(spark, "table")
    jobs.start_views(creates_stream(spark, sf_dir), {name: sinks.newest_first_sink(path, key, "created_at")},
                     scratch_dir(spark, "checkpoint"), **NOW).awaitTermination()
    return path


def stored_hourly_report(spark, sf_dir):
    path = scratch_dir(spark, "table")
    batch.run_job(reports.hourly_report(creates(spark, sf_dir)), sinks.table_sink(path, bucket_of="domain"), 0)
    return _listed(serving.get_hourly_report(sinks.read_table(
        spark, path, REPORT, TABLE_KEYS["hourly_activity_report"], of=("domain", DOMAIN)), DOMAIN))


def stored_editor_patterns(spark, sf_dir):
    path = scratch_dir(spark, "table")
    batch.run_job(editors.editor_patterns(creates(spark, sf_dir)), sinks.table_sink(path, bucket_of="user_name"), 0)
    return serving.get_editor_patterns(sinks.read_table(spark, path, EDITORS, TABLE_KEYS["editor_patterns"]), 50)


def _table_of(spark, start, schema, keys, **read):
    """Runs start(sink, checkpoint) to its end and reads the keyed table it wrote."""
    path = scratch_dir(spark, "table")
    start(sinks.table_sink(path), scratch_dir(spark, "checkpoint")).awaitTermination()
    return sinks.read_table(spark, path, schema, keys, **read)


METRICS = (
    "domain string, window_start timestamp, window_end timestamp, human_count bigint, bot_count bigint, "
    "bot_percentage double, top_humans array<string>, top_bots array<string>")
STATS = "domain string, pages_count bigint, unique_authors bigint, avg_title_length double, last_updated timestamp"
SPAM = "window_start timestamp, window_end timestamp, domain string, bot_name string, pages_created bigint"
HUMAN_SPAM = (
    "window_start timestamp, window_end timestamp, user_name string, severity string, page_count bigint, "
    "domains array<string>, reasons array<string>")
SPIKES = (
    "domain string, window_start timestamp, window_end timestamp, pages_last_1hour bigint, "
    "pages_last_5min bigint, avg_pages_per_5min double, spike_ratio double, sample_pages array<string>")
MESSAGES = (
    "alert_time string, user_name string, severity string, page_count bigint, domains array<string>, "
    "reasons array<string>, titles array<string>, part int, parts int")
REPORT = (
    "domain string, time_start timestamp, time_end timestamp, pages_created bigint, unique_authors bigint, "
    "bot_percent double, top_authors string")
EDITORS = (
    "user_name string, avg_gap_seconds double, active_hours array<int>, domains_count bigint, "
    "specialization string, total_pages bigint")


def _ignore(rows, batch_id):
    pass


def stream_bot_activity(spark, sf_dir):
    events = creates_stream(spark, sf_dir)
    return _table_of(
        spark, lambda sink, checkpoint: jobs.start_bot_activity(
            events, sink, _ignore, checkpoint, window="1 hour", **NOW),
        METRICS, TABLE_KEYS["bot_activity_metrics"])


def stream_high_bot_alerts(spark, sf_dir):
    events = creates_stream(spark, sf_dir)
    return _table_of(
        spark, lambda sink, checkpoint: jobs.start_bot_activity(
            events, _ignore, sink, checkpoint, window="1 hour", threshold=20.0, **NOW),
        "alert_time string, alert_type string, domain string, bot_percentage double, bot_count bigint, human_count bigint",
        ["alert_type", "domain", "alert_time"])


def stream_bot_spam(spark, sf_dir):
    events = creates_stream(spark, sf_dir)
    return _table_of(
        spark, lambda sink, checkpoint: jobs.start_bot_spam(
            events, sink, checkpoint, "10 days", "1 day", 5, **NOW),
        SPAM, ["window_start", "domain", "bot_name"])


def _stream_domains(spark, sf_dir):
    activity, stats = scratch_dir(spark, "activity"), scratch_dir(spark, "stats")
    jobs.start_domain_activity(
        creates_stream(spark, sf_dir), activity, stats, scratch_dir(spark, "checkpoint"),
        window="1 day", **NOW).awaitTermination()
    return activity, stats


def stream_domain_trend(spark, sf_dir):
    activity, _ = _stream_domains(spark, sf_dir)
    rows = sinks.read_table(spark, activity, LANGUAGE_ACTIVITY, TABLE_KEYS["language_activity"], "window_start")
    return _with_close(rows, domain_activity_exact(spark, sf_dir), "domain", "window_start")


def stream_domain_latest(spark, sf_dir):
    _, stats = _stream_domains(spark, sf_dir)
    rows = sinks.read_table(spark, stats, STATS, TABLE_KEYS["domain_stats"], order=["last_updated"])
    return _with_close(rows, domain_latest(spark, sf_dir), "domain")


def stream_domain_trend_joined(spark, sf_dir):
    """Closed windows with their trend, from a join of two streams."""
    path = scratch_dir(spark, "table")
    run_in_turns(spark, sf_dir, lambda events, checkpoint: jobs.start_domain_trend(
        events, sinks.table_sink(path), checkpoint, "1 day", **NOW), closing=True)
    rows = sinks.read_rows(spark, path, LANGUAGE_ACTIVITY).drop(sinks.BATCH)
    return _with_close(rows, domain_activity_exact(spark, sf_dir), "domain", "window_start")


def stored_domains(spark, sf_dir):
    _, stats = _stream_domains(spark, sf_dir)
    rows = serving.list_domains(sinks.read_table(spark, stats, STATS, TABLE_KEYS["domain_stats"], order=["last_updated"]))
    return _with_close(rows, domain_latest(spark, sf_dir), "domain")


def stream_spam_alerts(spark, sf_dir):
    path = scratch_dir(spark, "table")
    run_in_turns(spark, sf_dir, lambda events, checkpoint: jobs.start_spam_alerts(
        events, sinks.table_sink(path), checkpoint, "1 day", **NOW))
    return sinks.read_table(spark, path, HUMAN_SPAM, ["window_start", "user_name"])


def stream_spam_messages(spark, sf_dir):
    """Alerts of closed windows with all their titles, each once."""
    path = scratch_dir(spark, "table")
    run_in_turns(spark, sf_dir, lambda events, checkpoint: jobs.start_spam_messages(
        events, sinks.table_sink(path), checkpoint, "1 day", **NOW), closing=True)
    return sinks.read_rows(spark, path, MESSAGES).drop(sinks.BATCH)


def _spikes(spark, sf_dir, start, closing):
    path, titles = scratch_dir(spark, "table"), scratch_dir(spark, "titles")
    run_in_turns(
        spark, sf_dir,
        lambda events, checkpoint: jobs.start_first_titles(events, titles, checkpoint, "1 hour", **NOW),
        lambda events, checkpoint: start(events, sinks.table_sink(path), titles, checkpoint, "12 hours", "1 hour", **NOW),
        closing=closing)
    return path


def stream_spikes(spark, sf_dir):
    path = _spikes(spark, sf_dir, jobs.start_activity_spikes, False)
    return sinks.read_table(spark, path, SPIKES, ["domain", "window_start"])


def stream_spikes_closed(spark, sf_dir):
    """The same from slides that one aggregation counts and the next puts together, each window once."""
    path = _spikes(spark, sf_dir, jobs.start_closed_spikes, True)
    return sinks.read_rows(spark, path, SPIKES).drop(sinks.BATCH).where(F.col("domain") != CLOSING)


def archive_file_sink(spark, sf_dir):
    """The archive by Spark's own file sink, which a restart goes on with."""
    path = scratch_dir(spark, "archive")
    run_in_turns(spark, sf_dir, lambda events, checkpoint: jobs.start_archive_files(
        events.drop("page_id", "user_id"), path, checkpoint, **NOW))
    return spark.read.parquet(path).select(
        "page_title", "domain", "user_name", "user_is_bot", "event_time", "year", "month", "day")


def upsert_stored(spark, sf_dir):
    """Each user's newest page, kept in a table that micro-batches change only where their users are."""
    path = scratch_dir(spark, "table")
    write = versions.upsert_sink(path, PAGES["pages_by_user"], ["user_id"], "user_id", order_col="created_at")
    pages = pages_by_user(spark, sf_dir)
    number = F.col("page_id").cast("bigint")
    for batch_id in (0, 1):
        write(pages.where(number % 2 == batch_id), batch_id)
    return versions.read_upserted(spark, path, PAGES["pages_by_user"])


def _stream_view(name):
    def run(spark, sf_dir):
        events = creates_stream(spark, sf_dir)
        return _table_of(
            spark, lambda sink, checkpoint: jobs.start_views(events, {name: sink}, checkpoint, **NOW),
            PAGES[name], TABLE_KEYS[name])

    return run


stream_pages_by_user = _stream_view("pages_by_user")
stream_page_details = _stream_view("page_details")
stream_pages_by_domain = _stream_view("pages_by_domain")

QUERIES = [
    "parse_events", "clean_raw", "clean_rejects",
    "bot_activity", "bot_activity_minute", "high_bot_alerts", "high_bot_alerts_min_pages",
    "bot_alert_messages", "bot_spam", "bot_spam_minutes", "bot_spam_wide",
    "domain_activity", "domain_activity_exact", "domain_trend", "domain_trend_minute",
    "domain_trend_joined", "domain_activity_sketch", "domain_activity_from_sketches", "domain_latest",
    "spam_alerts", "spam_alerts_rules", "spam_alert_messages", "spam_alert_titles",
    "activity_spikes", "activity_spike_windows", "activity_spikes_minutes",
    "hourly_report", "hourly_report_history", "hourly_top_authors", "editor_patterns",
    "editor_patterns_merged", "editor_gap_lag",
    "pages_by_user", "page_details", "pages_by_domain",
    "q_hourly_report", "q_editor_patterns", "q_list_domains", "q_user_pages", "q_page",
    "q_domain_pages", "q_domain_pages_between", "upsert_latest", "upsert_batch_wins",
    "stream_ingest", "archive_roundtrip", "archive_between", "archive_hourly_report", "archive_editor_patterns",
    "editor_patterns_incremental", "stored_user_pages", "stored_page", "stored_domain_pages", "stored_hourly_report",
    "stored_editor_patterns", "stored_domains", "stored_domain_pages_between", "upsert_stored", "archive_file_sink",
    "stream_bot_activity", "stream_high_bot_alerts", "stream_bot_spam", "stream_domain_trend", "stream_domain_trend_joined",
    "stream_domain_latest", "stream_spam_alerts", "stream_spam_messages", "stream_spikes", "stream_spikes_closed",
    "stream_pages_by_user", "stream_page_details", "stream_pages_by_domain",
]


def registered() -> dict:
    def query(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(function(configure(spark), sf_dir))

        return run

    return {name: query(globals()[name]) for name in QUERIES}
