"""Event schemas, and the names and keys of the result tables."""

from pyspark.sql import types as T

# One raw JSON event. Identifiers are BIGINT: as INT a value above 2^31 would read as NULL.
PAGE_CREATE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("page_title", T.StringType()),
    T.StructField("meta", T.StructType([T.StructField("domain", T.StringType())])),
    T.StructField("performer", T.StructType([
        T.StructField("user_id", T.LongType()),
        T.StructField("user_text", T.StringType()),
        T.StructField("user_is_bot", T.BooleanType()),
    ])),
])

# The message envelope every source delivers; `timestamp` is the event time.
RAW = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

# The typed event: where each column sits in the raw JSON, and its type.
EVENT_FIELDS = {
    "page_id": ("page_id", "string"),
    "page_title": ("page_title", "string"),
    "domain": ("meta.domain", "string"),
    "user_name": ("performer.user_text", "string"),
    "user_id": ("performer.user_id", "string"),
    "user_is_bot": ("performer.user_is_bot", "boolean"),
}

EVENTS = T.StructType([
    T.StructField("page_id", T.StringType()),
    T.StructField("page_title", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("user_is_bot", T.BooleanType()),
    T.StructField("event_time", T.TimestampType()),
])

ARCHIVE = "page_title string, domain string, user_name string, user_is_bot boolean, event_time timestamp"

# Topic names.
RAW_TOPIC = "raw-page-creates"
BOT_ALERTS_TOPIC = "bot-alerts"
SPAM_ALERTS_TOPIC = "spam-alerts"
SPIKE_ALERTS_TOPIC = "breaking-news-alerts"

# Result tables and their keys. The two page listings carry page_id as well,
# so two pages created in the same instant both stay.
TABLE_KEYS = {
    "bot_activity_metrics": ["domain", "window_start"],
    "language_activity": ["domain", "window_start"],
    "hourly_activity_report": ["domain", "time_start"],
    "editor_patterns": ["user_name"],
    "domain_stats": ["domain"],
    "pages_by_user": ["user_id", "created_at", "page_id"],
    "page_details": ["page_id"],
    "pages_by_domain": ["domain", "created_at", "page_id"],
}

# What the spike job keeps of its input, and what longer windows of domain activity are made of.
FIRST_TITLES = "domain string, pane timestamp, titles array<struct<event_time:timestamp,page_title:string>>"
SKETCHES = "domain string, window_start timestamp, pages bigint, authors binary, title_chars bigint, titles bigint"

# The columns of the page listings.
PAGES = {
    "pages_by_user": "user_id string, created_at timestamp, page_id string, page_title string, domain string",
    "page_details": "page_id string, page_title string, domain string, user_name string, created_at timestamp",
    "pages_by_domain": "domain string, created_at timestamp, page_id string, page_title string, user_name string",
}

LANGUAGE_ACTIVITY = (
    "domain string, window_start timestamp, window_end timestamp, pages_count bigint, "
    "unique_authors bigint, avg_title_length double, trend_percent double"
)
