"""Page-creation events derived from the shared `events` table, for checks and benchmarks."""

from pyspark.sql import Column, DataFrame, functions as F

# The rule that gives every event a title, some of them suspicious or odd.
TITLE = """
case when event_id % 37 = 0 then concat('http://spam.example/', event_id)
     when event_id % 41 = 0 then concat('Report ', 1000000 + event_id)
     when event_id % 43 = 0 then 'ab'
     when event_id % 47 = 0 then repeat('x', 90)
     else concat('Page ', event_id) end
"""


def page_creates(events: DataFrame) -> DataFrame:
    """Typed page-creation events; works on a batch or a streaming `events`."""
    return events.select(
        F.col("event_id").cast("string").alias("page_id"),
        F.expr(TITLE).alias("page_title"),
        F.col("event_type").alias("domain"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("user_name"),
        F.col("user_id").cast("string").alias("user_id"),
        (F.col("user_id") % 5 == 0).alias("user_is_bot"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )


def message_body() -> Column:
    """A typed event as JSON."""
    return F.to_json(F.struct(
        F.col("page_id").cast("bigint").alias("page_id"),
        "page_title",
        F.struct("domain").alias("meta"),
        F.struct(
            F.col("user_id").cast("bigint").alias("user_id"),
            F.col("user_name").alias("user_text"),
            "user_is_bot").alias("performer")))


def raw_messages(creates: DataFrame) -> DataFrame:
    """The same events as messages (value, timestamp)."""
    return creates.select(message_body().alias("value"), F.col("event_time").alias("timestamp"))


def mixed_messages(creates: DataFrame) -> DataFrame:
    """Messages of which some are broken, some test events, some without a domain."""
    number = F.col("page_id").cast("bigint")

    def instead(text: str) -> Column:
        return F.format_string(text, number)

    value = (
        F.when(number % 31 == 0, instead('{"page_id": %d'))
        .when(number % 53 == 0, instead('{"meta":null,"page_id":%d}'))
        .when(number % 59 == 0, instead("[%d]"))
        .when(number % 23 == 0, instead('{"meta":{},"page_id":%d}'))
        .when(number % 29 == 0, instead('{"meta":{"domain":"canary"},"page_id":%d}'))
        .when(number % 61 == 0, instead("{'meta':{'domain':'x'},'page_id':%d}"))
        .when(number % 67 == 0, instead('{"meta":{"domain":"x"},"page_id":%d} {"a":1}'))
        .when(number % 71 == 0, instead('{"meta":{"domain":"x"},"page_id":%d} junk }'))
        .when(number % 73 == 0, instead('{"meta":{"domain":"x","domain":"y"},"page_id":%d}'))
        .when(number % 79 == 0, instead('{"meta":{"domain":"x"},"page_id":%d}] [1'))
        .when(number % 83 == 0, instead('{"meta":{"domain":"x"}},{"page_id":%d}'))
        .otherwise(message_body()))
    return creates.select(value.alias("value"), F.col("event_time").alias("timestamp"))
