"""The registered queries in standard SQL over the shared tables, for an independent engine.

Written from the definitions, not from the Spark plans: averages and percentages are rounded
half-up in integer arithmetic, sliding windows are expanded event by event, ranks and gaps
are plain window functions over the whole history.
"""

EVENTS = """
ev AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS page_id,
    CASE WHEN event_id % 37 = 0 THEN 'http://spam.example/' || event_id
         WHEN event_id % 41 = 0 THEN 'Report ' || (1000000 + event_id)
         WHEN event_id % 43 = 0 THEN 'ab'
         WHEN event_id % 47 = 0 THEN repeat('x', 90)
         ELSE 'Page ' || event_id END AS page_title,
    event_type AS domain, 'user_' || user_id AS user_name, CAST(user_id AS VARCHAR) AS user_id,
    user_id % 5 = 0 AS user_is_bot, ts
  FROM events)"""


def with_events(body: str, *more: str) -> str:
    return "WITH " + ",\n".join([EVENTS.strip(), *more]) + "\n" + body


def half_up(part: str, whole: str) -> str:
    """part / whole to two places, half away from zero, NULL for whole = 0."""
    return (
        f"(CASE WHEN ({whole}) = 0 THEN NULL ELSE sign({part}) * "
        f"((200 * abs({part}) + ({whole})) // (2 * ({whole}))) / CAST(100 AS DOUBLE) END)")


def percent(part: str, whole: str) -> str:
    return half_up(f"100 * ({part})", whole)


# -- bots -----------------------------------------------------------------------------------

def bot_activity(unit: str) -> str:
    return f"""
users AS (
  SELECT domain, date_trunc('{unit}', ts) AS w, user_is_bot, user_name, count(*) AS n
  FROM ev GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY domain, w, user_is_bot ORDER BY n DESC, user_name) AS rn
  FROM users),
metrics AS (
  SELECT domain, w AS window_start, w + INTERVAL 1 {unit} AS window_end,
    CAST(coalesce(sum(n) FILTER (WHERE NOT user_is_bot), 0) AS BIGINT) AS human_count,
    CAST(coalesce(sum(n) FILTER (WHERE user_is_bot), 0) AS BIGINT) AS bot_count,
    {percent("coalesce(sum(n) FILTER (WHERE user_is_bot), 0)", "sum(n)")} AS bot_percentage,
    string_agg(user_name, '|' ORDER BY rn) FILTER (WHERE rn <= 5 AND NOT user_is_bot) AS top_humans,
    string_agg(user_name, '|' ORDER BY rn) FILTER (WHERE rn <= 5 AND user_is_bot) AS top_bots
  FROM ranked GROUP BY domain, w)"""


ALERT_TIME = "strftime(window_end, '%Y-%m-%d %H:%M:%S')"

HIGH_BOT = f"""
SELECT {ALERT_TIME} AS alert_time, 'high_bot_activity' AS alert_type,
  domain, bot_percentage, bot_count, human_count
FROM metrics"""


def sliding(size: int, unit: str) -> str:
    """Each event once per window of `size` units it lies in, as (window_start, window_end)."""
    return f"""
slid AS (
  SELECT ev.*, date_trunc('{unit}', ts) - i * INTERVAL 1 {unit} AS window_start,
    date_trunc('{unit}', ts) + ({size} - i) * INTERVAL 1 {unit} AS window_end
  FROM ev, range({size}) AS r(i))"""


BOT_SPAM = """
spam AS (
  SELECT window_start, window_end, domain, user_name AS bot_name, count(*) AS pages_created
  FROM slid WHERE user_is_bot GROUP BY ALL)"""


# -- domains --------------------------------------------------------------------------------

def activity(unit: str) -> str:
    return f"""
activity AS (
  SELECT domain, date_trunc('{unit}', ts) AS window_start,
    date_trunc('{unit}', ts) + INTERVAL 1 {unit} AS window_end,
    CAST(count(*) AS BIGINT) AS pages_count,
    CAST(count(DISTINCT user_name) AS BIGINT) AS unique_authors,
    {half_up("sum(length(page_title))", "count(*)")} AS avg_title_length
  FROM ev GROUP BY ALL)"""


def trend(unit: str, drop: str = "") -> str:
    change = percent("c.pages_count::BIGINT - p.pages_count", "p.pages_count::BIGINT")
    return f"""
SELECT c.* {drop}, coalesce({change}, 0.0::DOUBLE) AS trend_percent
FROM activity c LEFT JOIN activity p
  ON c.domain = p.domain AND c.window_start - INTERVAL 1 {unit} = p.window_start"""


LATEST = """
SELECT domain, pages_count, unique_authors, avg_title_length, window_end AS last_updated
FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY window_start DESC) AS rn FROM activity)
WHERE rn = 1"""


# -- spam -----------------------------------------------------------------------------------

def spam(bucket: str, length: str, velocity: int) -> str:
    return f"""
spam AS (
  SELECT *, page_count > {velocity} AS fast, wikis > 1 AS wide FROM (
    SELECT {bucket} AS window_start, {bucket} + INTERVAL {length} AS window_end, user_name,
      CAST(count(*) AS BIGINT) AS page_count,
      count(DISTINCT domain) AS wikis,
      string_agg(DISTINCT domain, '|' ORDER BY domain) AS domains,
      string_agg(page_title, '|' ORDER BY page_title) AS titles,
      bool_or(regexp_matches(page_title, '(http|www\\.|\\d{{6,}})')) AS suspicious,
      bool_or(length(page_title) < 3 OR length(page_title) > 80) AS odd
    FROM ev WHERE NOT user_is_bot GROUP BY ALL)),
alerts AS (
  SELECT window_start, window_end, user_name,
    CASE WHEN suspicious OR (fast AND wide) THEN 'high' WHEN fast OR wide THEN 'medium' ELSE 'low' END AS severity,
    page_count, domains,
    concat_ws('|', CASE WHEN fast THEN 'High Velocity' END, CASE WHEN wide THEN 'Cross-wiki activity' END,
      CASE WHEN suspicious THEN 'Suspicious title' END, CASE WHEN odd THEN 'Anomalous length' END) AS reasons,
    titles
  FROM spam WHERE suspicious OR fast OR wide OR odd)"""


TEN_DAYS = "time_bucket(INTERVAL 10 DAY, ts, TIMESTAMP '1970-01-01 00:00:00')"


# -- spikes ---------------------------------------------------------------------------------

def spike_windows(slides: int, step: str) -> str:
    """`slides` windows per event, each `step` (as an interval) after the one before."""
    pane = f"time_bucket(INTERVAL {step}, ts, TIMESTAMP '1970-01-01 00:00:00')"
    return f"""
paned AS (SELECT *, {pane} AS pane FROM ev),
counted AS (
  SELECT domain, pane - i * INTERVAL {step} AS window_start,
    pane + ({slides} - i) * INTERVAL {step} AS window_end,
    count(*) AS pages, count(*) FILTER (WHERE i = {slides - 1}) AS recent
  FROM paned, range({slides}) AS r(i) GROUP BY ALL),
based AS (
  SELECT *, (200 * (pages - recent) + {slides - 1}) // (2 * {slides - 1}) AS mean_cents FROM counted),
scored AS (
  SELECT *, CASE WHEN mean_cents <= 0 THEN 100 ELSE mean_cents END AS cents FROM based),
firsts AS (
  SELECT domain, pane, string_agg(page_title, '|' ORDER BY rn) AS sample_pages
  FROM (SELECT *, row_number() OVER (PARTITION BY domain, pane ORDER BY ts, page_title) AS rn FROM paned)
  WHERE rn <= 5 GROUP BY ALL),
spikes AS (
  SELECT s.domain, window_start, window_end, CAST(pages AS BIGINT) AS pages_last_1hour,
    CAST(recent AS BIGINT) AS pages_last_5min, cents / CAST(100 AS DOUBLE) AS avg_pages_per_5min,
    {half_up("100 * recent", "cents")} AS spike_ratio, coalesce(f.sample_pages, '') AS sample_pages
  FROM scored s LEFT JOIN firsts f ON s.domain = f.domain AND s.window_end - INTERVAL {step} = f.pane)"""


# -- reports --------------------------------------------------------------------------------

AUTHORS = """
authors AS (
  SELECT domain, date_trunc('hour', ts) AS time_start, user_name, user_is_bot, count(*) AS pages
  FROM ev GROUP BY ALL),
ranked AS (
  SELECT *, CAST(row_number() OVER (
    PARTITION BY domain, time_start ORDER BY pages DESC, user_name, user_is_bot) AS INT) AS rn
  FROM authors)"""

REPORT = f"""
report AS (
  SELECT domain, time_start, time_start + INTERVAL 1 HOUR AS time_end,
    CAST(sum(pages) AS BIGINT) AS pages_created, CAST(count(user_name) AS BIGINT) AS unique_authors,
    {percent("coalesce(sum(pages) FILTER (WHERE user_is_bot), 0)", "sum(pages)")} AS bot_percent,
    '[' || string_agg(
      '{{"name":"' || user_name || '","pages":' || pages || ',"is_bot":' || user_is_bot || '}}', ',' ORDER BY rn
    ) FILTER (WHERE rn <= 10) || ']' AS top_authors,
    string_agg(user_name || ':' || pages || ':' || user_is_bot, '|' ORDER BY rn) FILTER (WHERE rn <= 10) AS listed
  FROM ranked GROUP BY domain, time_start)"""

SIX_HOURS = """
SELECT * EXCLUDE (listed, hour_now) FROM report, (SELECT date_trunc('hour', max(ts)) AS hour_now FROM events) n
WHERE time_start >= hour_now - INTERVAL 6 HOUR AND time_start < hour_now"""

EDITORS = f"""
gaps AS (
  SELECT user_name, page_id, ts AS event_time, domain,
    CAST(floor(epoch(ts)) AS BIGINT)
      - CAST(floor(epoch(lag(ts) OVER (PARTITION BY user_name ORDER BY ts, page_id))) AS BIGINT) AS gap_seconds
  FROM ev WHERE NOT user_is_bot),
favourite AS (
  SELECT user_name, domain AS specialization FROM (
    SELECT user_name, domain,
      row_number() OVER (PARTITION BY user_name ORDER BY count(*) DESC, domain) AS rn
    FROM gaps GROUP BY user_name, domain)
  WHERE rn = 1),
profile AS (
  SELECT user_name, coalesce({half_up("sum(gap_seconds)", "count(gap_seconds)")}, 0.0::DOUBLE) AS avg_gap_seconds,
    array_to_string(list_sort(list(DISTINCT hour(event_time))), '|') AS active_hours,
    CAST(count(DISTINCT domain) AS BIGINT) AS domains_count, CAST(count(*) AS BIGINT) AS total_pages
  FROM gaps GROUP BY user_name),
patterns AS (
  SELECT user_name, avg_gap_seconds, active_hours, domains_count, specialization, total_pages
  FROM profile JOIN favourite USING (user_name))"""


# -- pages ----------------------------------------------------------------------------------

BY_USER = "SELECT user_id, ts AS created_at, page_id, page_title, domain FROM ev"
DETAILS = "SELECT page_id, page_title, domain, user_name, ts AS created_at FROM ev"
BY_DOMAIN = "SELECT domain, ts AS created_at, page_id, page_title, user_name FROM ev"
NEWEST = "ORDER BY created_at DESC, page_id LIMIT"

# What became of each event in the mixed messages, in the order the cases are tried: the text, and the routing key, NULL
# for a rejected message.
MIXED = """
mixed AS (
  SELECT ts,
    CASE WHEN event_id % 31 = 0 THEN '{"page_id": ' || event_id
         WHEN event_id % 53 = 0 THEN '{"meta":null,"page_id":' || event_id || '}'
         WHEN event_id % 59 = 0 THEN '[' || event_id || ']'
         WHEN event_id % 23 = 0 THEN '{"meta":{},"page_id":' || event_id || '}'
         WHEN event_id % 29 = 0 THEN '{"meta":{"domain":"canary"},"page_id":' || event_id || '}'
         WHEN event_id % 61 = 0 THEN '{''meta'':{''domain'':''x''},''page_id'':' || event_id || '}'
         WHEN event_id % 67 = 0 THEN '{"meta":{"domain":"x"},"page_id":' || event_id || '} {"a":1}'
         WHEN event_id % 71 = 0 THEN '{"meta":{"domain":"x"},"page_id":' || event_id || '} junk }'
         WHEN event_id % 73 = 0 THEN '{"meta":{"domain":"x","domain":"y"},"page_id":' || event_id || '}'
         WHEN event_id % 79 = 0 THEN '{"meta":{"domain":"x"},"page_id":' || event_id || '}] [1'
         WHEN event_id % 83 = 0 THEN '{"meta":{"domain":"x"}},{"page_id":' || event_id || '}'
         ELSE '{"page_id":' || event_id || ',"page_title":"' || page_title || '","meta":{"domain":"' || domain
           || '"},"performer":{"user_id":' || user_id || ',"user_text":"' || user_name || '","user_is_bot":'
           || user_is_bot || '}}' END AS value,
    CASE WHEN event_id % 31 = 0 OR event_id % 53 = 0 OR event_id % 59 = 0 THEN NULL
         WHEN event_id % 23 = 0 THEN 'unknown' WHEN event_id % 29 = 0 THEN 'canary'
         WHEN event_id % 61 = 0 OR event_id % 67 = 0 OR event_id % 71 = 0 THEN NULL WHEN event_id % 73 = 0 THEN 'y'
         WHEN event_id % 79 = 0 OR event_id % 83 = 0 THEN NULL ELSE domain END AS key
  FROM ev)"""

CLOSED = "(SELECT max(ts) - INTERVAL 1 MINUTE FROM events)"
ARCHIVED = "page_title, domain, user_name, user_is_bot, ts AS event_time"
BETWEEN = "ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts {} TIMESTAMP '2024-01-12 12:00:00'"


def statements() -> dict:
    hour, minute, day = bot_activity("hour"), bot_activity("minute"), activity("day")
    high_min_pages = f"{HIGH_BOT} WHERE bot_percentage > 20 AND bot_count + human_count >= 5"
    message = (
        """SELECT '{"alert_time":"' || alert_time || '","alert_type":"' || alert_type || '","domain":"' || domain """
        """|| '","bot_percentage":' || bot_percentage || ',"bot_count":' || bot_count || ',"human_count":' """
        f"""|| human_count || '}}' AS value, 'high_bot_activity|' || domain || '|' || alert_time AS key FROM ({HIGH_BOT} WHERE bot_percentage > 20)""")
    day_spam = spam("date_trunc('day', ts)", "1 DAY", 10)
    twelve_hours, one_hour = spike_windows(12, "1 HOUR"), spike_windows(12, "5 MINUTE")
    alerts = "SELECT * EXCLUDE (titles) FROM alerts"
    report = with_events("SELECT * EXCLUDE (listed) FROM report", AUTHORS, REPORT)
    six_hours = with_events(SIX_HOURS, AUTHORS, REPORT)
    patterns = with_events("SELECT * FROM patterns WHERE total_pages >= 5", EDITORS)
    spam_ten_days = with_events("SELECT * FROM spam WHERE pages_created > 5", sliding(10, "day"), BOT_SPAM)
    bot_figures = activity("day").replace("activity AS", "bot_activity AS").replace(
        "FROM ev", "FROM ev WHERE user_is_bot")
    newest = "EXCLUDE (unique_authors)"
    user_pages = with_events(f"{BY_USER} WHERE user_id = '7' {NEWEST} 100")
    one_page = with_events(f"{DETAILS} WHERE page_id = '42'")
    domain_pages = with_events(f"{BY_DOMAIN} WHERE domain = 'click' {NEWEST} 100")
    newest_hours = with_events(
        "SELECT strftime(time_start, '%H:%M') AS time_start, strftime(time_end, '%H:%M') AS time_end, "
        "domain, pages_created, unique_authors, bot_percent, listed AS top_authors FROM ("
        "SELECT * FROM report WHERE domain = 'click' ORDER BY time_start DESC LIMIT 6)", AUTHORS, REPORT)
    newest_page = with_events(
        "SELECT user_id, created_at, page_id, page_title, domain FROM ("
        "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, "
        f"CAST(page_id AS BIGINT) % 2 DESC, page_id DESC) AS rn FROM ({BY_USER})) WHERE rn = 1")
    domain_pages_between = with_events(f"{BY_DOMAIN} WHERE domain = 'click' AND {BETWEEN.format('<=')} {NEWEST} 50")
    archived = with_events(
        f"SELECT {ARCHIVED}, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day FROM ev")
    trends = with_events(trend("day", f"{newest}, true AS close"), day)
    latest_figures = with_events(f"SELECT * {newest}, true AS close FROM ({LATEST})", day)
    day_spikes = with_events("SELECT * FROM spikes WHERE spike_ratio > 3", twelve_hours)
    busy = with_events("SELECT * FROM patterns WHERE total_pages >= 50", EDITORS)
    messages = with_events(
        "SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS alert_time, "
        "* EXCLUDE (window_start, window_end), 0 AS part, 1 AS parts FROM alerts", day_spam)
    return {
        "parse_events": with_events(
            "SELECT page_id, page_title, domain, user_name, user_id, user_is_bot, ts AS event_time FROM ev"),
        "clean_raw": with_events(
            "SELECT value, key, ts AS timestamp FROM mixed WHERE key <> 'canary'", MIXED),
        "clean_rejects": with_events(
            "SELECT value, ts AS timestamp FROM mixed WHERE key IS NULL", MIXED),
        "bot_activity": with_events("SELECT * FROM metrics", hour),
        "bot_activity_minute": with_events("SELECT * FROM metrics", minute),
        "high_bot_alerts": with_events(f"{HIGH_BOT} WHERE bot_percentage > 80", minute),
        "high_bot_alerts_min_pages": with_events(high_min_pages, hour),
        "bot_alert_messages": with_events(message, hour),
        "bot_spam": spam_ten_days,
        "bot_spam_wide": with_events("SELECT * FROM spam WHERE pages_created > 5", sliding(240, "hour"), BOT_SPAM),
        "bot_spam_minutes": with_events(
            f"SELECT {ALERT_TIME} AS alert_time, 'bot_spam' AS alert_type, domain, bot_name, pages_created "
            "FROM spam WHERE pages_created > 1", sliding(10, "minute"), BOT_SPAM),
        "domain_activity": with_events("SELECT * EXCLUDE (unique_authors), true AS close FROM activity", activity("hour")),
        "domain_activity_exact": with_events("SELECT * FROM activity", day),
        "domain_trend": with_events(trend("day"), day),
        "domain_trend_minute": with_events(trend("minute"), activity("minute")),
        "domain_trend_joined": with_events(trend("day"), day),
        "domain_activity_sketch": with_events(
            "SELECT * EXCLUDE (unique_authors), true AS close FROM activity", day),
        "domain_activity_from_sketches": with_events(
            "SELECT * EXCLUDE (unique_authors), true AS close FROM activity", day),
        "domain_latest": with_events(LATEST, day),
        "spam_alerts": with_events(alerts, day_spam),
        "spam_alerts_rules": with_events(alerts, spam(TEN_DAYS, "10 DAY", 20)),
        "spam_alert_messages": messages,
        "stream_spam_messages": messages,
        "spam_alert_titles": with_events(
            f"SELECT a.window_start, a.user_name, e.page_title FROM alerts a JOIN ev e ON a.user_name = e.user_name "
            f"AND a.window_start = {TEN_DAYS.replace('ts,', 'e.ts,')}", spam(TEN_DAYS, "10 DAY", 20)),
        "activity_spikes": with_events("SELECT * FROM spikes WHERE spike_ratio > 3", twelve_hours),
        "activity_spike_windows": with_events("SELECT * FROM spikes", twelve_hours),
        "activity_spikes_minutes": with_events(
            f"SELECT {ALERT_TIME} AS alert_time, 'activity_spike' AS alert_type, domain, pages_last_5min, "
            "avg_pages_per_5min, spike_ratio, sample_pages FROM spikes WHERE spike_ratio > 3", one_hour),
        "hourly_report": six_hours,
        "hourly_report_history": report,
        "hourly_top_authors": with_events("SELECT * FROM ranked WHERE rn <= 10", AUTHORS),
        "editor_patterns": patterns,
        "editor_patterns_merged": patterns,
        "editor_gap_lag": with_events("SELECT * EXCLUDE (domain) FROM gaps", EDITORS),
        "pages_by_user": with_events(BY_USER),
        "page_details": with_events(DETAILS),
        "pages_by_domain": with_events(BY_DOMAIN),
        "q_hourly_report": newest_hours,
        "stored_hourly_report": newest_hours,
        "q_editor_patterns": busy,
        "stored_editor_patterns": busy,
        "editor_patterns_incremental": patterns,
        "q_list_domains": with_events(LATEST, day),
        "q_user_pages": user_pages,
        "stored_user_pages": user_pages,
        "q_page": one_page,
        "stored_page": one_page,
        "q_domain_pages": domain_pages,
        "stored_domain_pages": domain_pages,
        "q_domain_pages_between": domain_pages_between,
        "stored_domain_pages_between": domain_pages_between,
        "upsert_latest": newest_page,
        "upsert_stored": newest_page,
        "upsert_batch_wins": with_events(
            "SELECT * FROM bot_activity UNION ALL SELECT a.* FROM activity a "
            "WHERE NOT EXISTS (SELECT 1 FROM bot_activity b "
            "WHERE a.domain = b.domain AND a.window_start = b.window_start)", day, bot_figures),
        "stream_ingest": with_events(
            "SELECT value, key FROM mixed WHERE key IS DISTINCT FROM 'canary'", MIXED),
        "archive_roundtrip": archived,
        "archive_file_sink": archived,
        "archive_between": with_events(f"SELECT {ARCHIVED} FROM ev WHERE {BETWEEN.format('<')}"),
        "archive_hourly_report": six_hours,
        "archive_editor_patterns": patterns,
        "stream_bot_activity": with_events(f"SELECT * FROM metrics WHERE window_end <= {CLOSED}", hour),
        "stream_high_bot_alerts": with_events(
            f"{HIGH_BOT} WHERE bot_percentage > 20 AND window_end <= {CLOSED}", hour),
        "stream_bot_spam": spam_ten_days,
        "stream_domain_trend": trends,
        "stream_domain_trend_joined": trends,
        "stream_domain_latest": latest_figures,
        "stored_domains": latest_figures,
        "stream_spam_alerts": with_events(alerts, day_spam),
        "stream_spikes": day_spikes,
        "stream_spikes_closed": day_spikes,
        "stream_pages_by_user": with_events(BY_USER),
        "stream_page_details": with_events(DETAILS),
        "stream_pages_by_domain": with_events(BY_DOMAIN),
    }
