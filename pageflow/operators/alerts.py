"""Alerts as messages."""

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: how alert times are written.
ALERT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def alert_time(time: Column) -> Column:
    return F.date_format(time, ALERT_TIME_FORMAT).alias("alert_time")


# The columns that tell alerts apart, those an alert has of them.
IDENTITY = ("alert_type", "domain", "bot_name", "user_name", "alert_time", "part")


def to_alert_json(alerts: DataFrame) -> DataFrame:
    """`key` and one JSON string `value` per alert; NULL fields are left out.

    The key is what tells alerts apart (their kind, domain or user, and time), so an alert sent again after a change
    or a repeated micro-batch replaces itself in a compacted topic and is known as the same by any consumer.
    """
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in IDENTITY if c in alerts.columns])
    return alerts.select(key.alias("key"), F.to_json(F.struct("*")).alias("value"))
