"""Bot and human activity per domain and window, and the two bot alerts."""

from pyspark.sql import DataFrame, functions as F

from pageflow.functions.ranking import in_rank_order, top_per_group
from pageflow.functions.ratios import percent
from pageflow.functions.sliding import sliding_counts
from pageflow.operators.alerts import alert_time
from pageflow.operators.clean import present

# Alert types.
HIGH_BOT_ACTIVITY = "high_bot_activity"
BOT_SPAM = "bot_spam"


def user_counts(events: DataFrame, window: str = "1 minute") -> DataFrame:
    """Pages per (window, domain, user_is_bot, user_name). Works on streams too."""
    return present(events, "domain", "user_name").groupBy(
        F.window("event_time", window), "domain", "user_is_bot", "user_name"
    ).agg(F.count("*").alias("pages"))


def shares(totals: DataFrame) -> DataFrame:
    """(domain, window bounds, human and bot pages, bot percentage) from sums `bots`, `humans`."""
    return totals.select(
        "domain",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("humans").alias("human_count"),
        F.col("bots").alias("bot_count"),
        percent(F.col("bots"), F.col("bots") + F.col("humans")).alias("bot_percentage"),
        *[c for c in ("top_humans", "top_bots") if c in totals.columns])


def bot_shares(events: DataFrame, window: str = "1 minute") -> DataFrame:
    """`bot_activity` without the top users: one aggregation, all that the alerts need."""
    bot = F.col("user_is_bot")
    return shares(present(events, "domain", "user_name").groupBy(
        F.window("event_time", window), "domain"
    ).agg(F.count_if(bot).alias("bots"), F.count_if(~bot).alias("humans")))


def bot_metrics(counts: DataFrame, k: int = 5) -> DataFrame:
    """Bot and human pages, bot percentage and the top users of each kind, from `user_counts`.

    Users with as many pages rank by name. A user whose bot flag is unknown is neither bot nor
    human; where nobody's flag is known the percentage is NULL. Both branches read `counts`
    unfiltered, so that its shuffle is run once and reused.
    """
    bot, pages = F.col("user_is_bot"), F.col("pages")
    totals = counts.groupBy("window", "domain").agg(
        F.sum(F.when(bot, pages).otherwise(0)).alias("bots"),
        F.sum(F.when(~bot, pages).otherwise(0)).alias("humans"))
    ranked = top_per_group(
        counts, ["window", "domain", "user_is_bot"], [pages.desc(), F.col("user_name").asc()], k)
    top = ranked.groupBy("window", "domain").agg(
        in_rank_order(F.col("user_name"), ~bot).alias("top_humans"),
        in_rank_order(F.col("user_name"), bot).alias("top_bots"))
    return shares(totals.join(top, ["window", "domain"], "left"))


def bot_activity(events: DataFrame, window: str = "1 minute", k: int = 5) -> DataFrame:
    return bot_metrics(user_counts(events, window), k)


def high_bot_alerts(metrics: DataFrame, threshold: float = 80.0, min_pages: int | None = None) -> DataFrame:
    """Windows whose bot percentage is above `threshold`, with `min_pages` pages if given."""
    rows = metrics.where(F.col("bot_percentage") > threshold)
    if min_pages is not None:
        rows = rows.where(F.col("bot_count") + F.col("human_count") >= min_pages)
    return rows.select(
        alert_time(F.col("window_end")),
        F.lit(HIGH_BOT_ACTIVITY).alias("alert_type"),
        "domain", "bot_percentage", "bot_count", "human_count")


def bot_spam(events: DataFrame, window: str = "10 minutes", slide: str = "1 minute",
             threshold: int = 50, method: str = "blocks") -> DataFrame:
    """Bots with more than `threshold` pages in one domain within a sliding window, counted by `method`."""
    spammers = sliding_counts(_bots(events), ["domain", "user_name"], window, slide, threshold, method)
    return spammers.select(
        "window_start", "window_end", "domain",
        F.col("user_name").alias("bot_name"), F.col("pages").alias("pages_created"))


def bot_spam_stream(events: DataFrame, window: str = "10 minutes", slide: str = "1 minute",
                    threshold: int = 50) -> DataFrame:
    """`bot_spam` over a stream with a watermark; counts are updated as events arrive."""
    counted = _bots(events).groupBy(
        F.window("event_time", window, slide), "domain", F.col("user_name").alias("bot_name")
    ).agg(F.count("*").alias("pages_created"))
    return counted.where(F.col("pages_created") > threshold).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "domain", "bot_name", "pages_created")


def _bots(events: DataFrame) -> DataFrame:
    return present(events, "domain", "user_name").where(F.col("user_is_bot"))


def bot_spam_alerts(spam: DataFrame) -> DataFrame:
    return spam.select(
        alert_time(F.col("window_end")), F.lit(BOT_SPAM).alias("alert_type"),
        "domain", "bot_name", "pages_created")
