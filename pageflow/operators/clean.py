"""From raw messages to typed events."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from pageflow.schema import EVENT_FIELDS, PAGE_CREATE

# The domain of test events, and the routing key of events without a domain.
CANARY = "canary"
UNKNOWN = "unknown"


def json_schema(columns) -> StructType:
    """The part of the message schema that holds `columns`, so nothing else is parsed."""
    paths = {EVENT_FIELDS[c][0] for c in columns}
    kept = StructType()
    for field in PAGE_CREATE:
        if field.name in paths:
            kept.add(field)
        elif isinstance(field.dataType, StructType):
            inner = [f for f in field.dataType if f"{field.name}.{f.name}" in paths]
            if inner:
                kept.add(field.name, StructType(inner))
    return kept


def parse_events(raw: DataFrame, columns=tuple(EVENT_FIELDS), require=()) -> DataFrame:
    """Messages as typed events with `columns` and event_time, the message's timestamp.

    A message that cannot be parsed gives NULL in every column; `require` names the columns
    that must be present. The parse result comes out of a generator, so that a filter on its
    columns is not pushed below it, where Spark would parse each message a second time.
    """
    parsed = F.from_json(F.col("value").cast("string"), json_schema(columns))
    fields = raw.select(F.col("timestamp").alias("event_time"), F.inline(F.array(parsed)))
    events = fields.select(
        *[F.col(EVENT_FIELDS[c][0]).cast(EVENT_FIELDS[c][1]).alias(c) for c in columns], "event_time")
    return present(events, *require)


def present(events: DataFrame, *columns: str) -> DataFrame:
    """Only rows in which all of `columns` are set."""
    for column in columns:
        events = events.where(F.col(column).isNotNull())
    return events


def examined(raw: DataFrame) -> DataFrame:
    """Messages with their `domain` and whether they are `sound`.

    Sound are JSON objects with `meta` absent or an object and `meta.domain` absent or a string. Of equal names in an
    object the last counts. The reader stops after the first value of a text, so each message is read as the first of two
    elements of an array, the second a mark made of the message's hash: whatever else the text holds, quotes of
    another kind included, there are then not just these two.
    """
    text = F.col("value").cast("string")
    mark = F.sha2(text.cast("binary"), 256)
    wrapped = F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]'))
    items = F.from_json(wrapped, "array<variant>", {"allowSingleQuotes": "false"})
    rows = raw.select("*", F.inline(F.array(F.struct(mark.alias("mark"), items.alias("items")))))
    item = rows.withColumn("item", F.get("items", F.lit(0)))
    only = (F.size("items") == 2) & (F.expr("try_variant_get(get(items, 1), '$', 'string')") == F.col("mark"))
    meta_kind = F.schema_of_variant(F.expr("variant_get(item, '$.meta', 'variant')"))
    domain_kind = F.schema_of_variant(F.expr("variant_get(item, '$.meta.domain', 'variant')"))
    sound = (
        F.coalesce(only, F.lit(False))
        & F.coalesce(F.schema_of_variant("item").startswith("OBJECT"), F.lit(False))
        & F.when(domain_kind.isNull(), meta_kind.isNull() | meta_kind.startswith("OBJECT")).otherwise(domain_kind == "STRING")
    )
    return item.select(
        *raw.columns,
        F.expr("try_variant_get(item, '$.meta.domain', 'string')").alias("domain"),
        sound.alias("sound"))


def kept(messages: DataFrame) -> DataFrame:
    """Of examined messages the sound ones, test events left out, with their routing `key`."""
    rest = [c for c in messages.columns if c not in ("domain", "sound")]
    keyed = messages.where(F.col("sound")).withColumn("key", F.coalesce("domain", F.lit(UNKNOWN)))
    return keyed.where(F.col("key") != CANARY).select(*rest, "key")


def rejected(messages: DataFrame) -> DataFrame:
    """Of examined messages those that are not sound."""
    return messages.where(~F.col("sound")).drop("domain", "sound")


def clean_raw(raw: DataFrame) -> DataFrame:
    """Messages worth keeping, with the routing `key`: their domain, or 'unknown'."""
    return kept(examined(raw))


def split_rejects(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(`clean_raw(raw)`, the messages that are not sound); test events are in neither."""
    messages = examined(raw)
    return kept(messages), rejected(messages)
