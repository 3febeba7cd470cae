"""Human users whose page creations look like spam."""

from pyspark.sql import DataFrame, functions as F

from pageflow.functions.skew import spread_join
from pageflow.operators.alerts import alert_time
from pageflow.operators.clean import present

# The title pattern, the severities and the reasons in their order.
SUSPICIOUS_TITLE = r"(http|www\.|\d{6,})"
HIGH, MEDIUM, LOW = "high", "medium", "low"
REASONS = ("High Velocity", "Cross-wiki activity", "Suspicious title", "Anomalous length")

# Titles per alert row; an alert with more is continued in further rows.
TITLES_PER_PART = 10_000


def spam_alerts(events: DataFrame, window: str = "5 minutes", velocity: int = 10,
                min_len: int = 3, max_len: int = 80, pattern: str = SUSPICIOUS_TITLE) -> DataFrame:
    """Scores each human user's window by four rules; windows no rule applies to are left out.

    Shuffles hold flags, a count and the set of domains per user and window, never the titles; `spam_titles` adds those
    afterwards.
    """
    return _alert_rows(scored_windows(events, window, velocity, min_len, max_len, pattern))


def scored_windows(events: DataFrame, window: str = "5 minutes", velocity: int = 10,
                   min_len: int = 3, max_len: int = 80, pattern: str = SUSPICIOUS_TITLE,
                   more: dict | None = None) -> DataFrame:
    """The same with the window as one column, which a stream's joins need. `more` are further aggregates, by name."""
    more = more or {}
    title, length = F.col("page_title"), F.length("page_title")
    scored = human_pages(events).groupBy(F.window("event_time", window), "user_name").agg(
        F.count("*").alias("page_count"),
        F.sort_array(F.collect_set("domain")).alias("domains"),
        F.coalesce(F.bool_or(title.rlike(pattern)), F.lit(False)).alias("suspicious"),
        F.coalesce(F.bool_or((length < min_len) | (length > max_len)), F.lit(False)).alias("odd_length"),
        *[value.alias(name) for name, value in more.items()])
    fast, wide = F.col("page_count") > velocity, F.size("domains") > 1
    suspicious, odd_length = F.col("suspicious"), F.col("odd_length")
    severity = (
        F.when(suspicious | (fast & wide), HIGH)
        .when(fast | wide, MEDIUM)
        .when(odd_length, LOW))
    reasons = F.array_compact(F.array(*[
        F.when(applies, reason) for applies, reason in zip((fast, wide, suspicious, odd_length), REASONS)]))
    # A window always has a start. Saying so here gives this plan the filter that a join on it
    # would otherwise add to one of its uses, so that they can share one shuffle.
    found = scored.where(F.col("window.start").isNotNull())
    return found.where(suspicious | fast | wide | odd_length).select(
        "window", "user_name", severity.alias("severity"), "page_count", "domains", reasons.alias("reasons"), *more)


def _alert_rows(scored: DataFrame) -> DataFrame:
    return scored.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "user_name", "severity", "page_count", "domains", "reasons")


def human_pages(events: DataFrame) -> DataFrame:
    return present(events, "user_name").where(~F.col("user_is_bot"))


def spam_titles(events: DataFrame, alerts: DataFrame, window: str = "5 minutes",
                part_size: int = TITLES_PER_PART) -> DataFrame:
    """The titles behind each alert: window_start, user_name, part, titles.

    All titles come out, dealt over ceil(page_count / part_size) parts, so that one user's
    window, however large, is never gathered into a single row or task.
    """
    created = present(human_pages(events), "page_title").select(
        F.window("event_time", window)["start"].alias("window_start"), "user_name", "page_title", _draw(events).alias("draw"))
    keyed = alerts.select("window_start", "user_name", _parts(part_size).alias("parts"))
    hits = spread_join(created, keyed, ["window_start", "user_name"], F.pmod("draw", "parts").cast("int"))
    return _gathered(hits.withColumnRenamed("piece", "part"))


def _draw(events: DataFrame):
    """A number for each page that deals it to a part."""
    return F.xxhash64(F.lit("part"), *[c for c in ("page_id", "page_title", "event_time") if c in events.columns])


def _gathered(hits: DataFrame) -> DataFrame:
    return hits.groupBy("window_start", "user_name", "part").agg(F.sort_array(F.collect_list("page_title")).alias("titles"))


def alert_pages(events: DataFrame, window: str = "5 minutes", salts: int = 16, **rules) -> DataFrame:
    """Of a stream with a watermark, each closed window's alert with each of its pages: alert columns, page_title, draw.

    Both sides are in Spark's state until the window closes: flags per user and window, and a row per page, which is
    evicted with its window. A user's pages of a window are dealt over at most `salts` tasks; alerts are copied to those that
    have pages of theirs, so that there are never more copies than pages.
    """
    draw = _draw(events)
    salt = F.pmod(draw, F.lit(salts)).cast("int")
    alerts = scored_windows(events, window, **rules, more={"salts": F.collect_set(salt)}).withColumn("salt", F.explode("salts"))
    pages = human_pages(events).select(
        F.window("event_time", window), "user_name", "page_title", draw.alias("draw"), salt.alias("salt"))
    return alerts.join(pages, ["window", "user_name", "salt"]).select(
        F.col("window.start").alias("window_start"), "user_name", "severity", "page_count", "domains", "reasons", "page_title", "draw")


def messages_of_pages(rows: DataFrame, part_size: int = TITLES_PER_PART) -> DataFrame:
    """The alerts of `alert_pages` as messages with all their titles."""
    part = F.pmod("draw", _parts(part_size)).cast("int")
    titles = _gathered(rows.where("page_title is not null").withColumn("part", part))
    return spam_messages(rows.drop("page_title", "draw").dropDuplicates(["window_start", "user_name"]), titles, part_size)


def spam_messages(alerts: DataFrame, titles: DataFrame, part_size: int = TITLES_PER_PART) -> DataFrame:
    """Alert messages with titles: `part` of `parts`, a row each, whatever the size of an alert."""
    parts = _parts(part_size).cast("int")
    rows = alerts.withColumn("parts", parts).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.join(titles, ["window_start", "user_name", "part"], "left").select(
        alert_time(F.col("window_start")),
        "user_name", "severity", "page_count", "domains", "reasons",
        F.coalesce("titles", F.array().cast("array<string>")).alias("titles"), "part", "parts")


def _parts(part_size: int):
    return F.ceil(F.col("page_count") / part_size)
