import json

import pytest
from pyspark.sql import functions as F

from pageflow.operators import spam
from pageflow.operators.alerts import to_alert_json
from tests.conftest import at


def scored(events, *titles, user="u", bot=False, domain="d", **rules):
    rows = events(*[("10:00:01", user, bot, domain, title) for title in titles])
    return [(r.severity, r.reasons) for r in spam.spam_alerts(rows, **rules).collect()]


@pytest.mark.parametrize("title, odd", [("ab", True), ("abc", False), ("x" * 80, False), ("x" * 81, True)])
def test_title_length(events, title, odd):
    assert scored(events, title) == ([("low", ["Anomalous length"])] if odd else [])


@pytest.mark.parametrize("title, match", [
    ("www.x", True), ("wwwx", False), ("12345", False), ("a 123456", True), ("http", True)])
def test_suspicious_titles(events, title, match):
    assert scored(events, title) == ([("high", ["Suspicious title"])] if match else [])


def test_velocity_and_domains(events):
    fast = [(f"10:00:{n:02}", "fast", False, "d") for n in range(11)]
    calm = [(f"10:00:{n:02}", "calm", False, "d") for n in range(10)]
    wide = [("10:00:00", "wide", False, "d"), ("10:00:01", "wide", False, "e"), ("10:04:59", "wide", False, None)]
    both = [(f"10:00:{n:02}", "both", False, "de"[n % 2]) for n in range(11)]
    rows = spam.spam_alerts(events(*fast, *calm, *wide, *both)).collect()
    assert {r.user_name: (r.severity, r.page_count, r.domains) for r in rows} == {
        "fast": ("medium", 11, ["d"]), "wide": ("medium", 3, ["d", "e"]), "both": ("high", 11, ["d", "e"])}


def test_only_humans_with_names(events):
    assert scored(events, "www.x", bot=True) == scored(events, "www.x", bot=None) == []
    assert scored(events, "www.x", user=None) == []


def test_user_without_domain_or_title_still_counts(events):
    rows = events(*[("10:00:01", "u", False, None)] * 11)
    untitled = rows.withColumn("page_title", F.lit(None).cast("string"))
    row, = spam.spam_alerts(untitled).collect()
    assert (row.severity, row.domains, row.reasons) == ("medium", [], ["High Velocity"])
    alerts = spam.spam_alerts(untitled)
    message, = spam.spam_messages(alerts, spam.spam_titles(untitled, alerts)).collect()
    assert message.titles == []


def test_all_titles_are_dealt_over_parts(events):
    rows = events(*[("10:00:01", "u", False, "d", f"http {n}") for n in range(100)],
                  ("10:00:02", "v", False, "d", "ab"))
    alerts = spam.spam_alerts(rows)
    whole = spam.spam_messages(alerts, spam.spam_titles(rows, alerts))
    messages = {m["user_name"]: m for m in (json.loads(r.value) for r in to_alert_json(whole).collect())}
    assert messages["v"] == {
        "alert_time": "2024-03-01 10:00:00", "user_name": "v", "severity": "low", "page_count": 1,
        "domains": ["d"], "reasons": ["Anomalous length"], "titles": ["ab"], "part": 0, "parts": 1}
    assert messages["u"]["titles"] == sorted(f"http {n}" for n in range(100))

    parts = spam.spam_messages(alerts, spam.spam_titles(rows, alerts, part_size=30), part_size=30)
    mine = parts.where("user_name = 'u'").collect()
    assert sorted(r.part for r in mine) == [0, 1, 2, 3]
    assert sorted(t for r in mine for t in r.titles) == messages["u"]["titles"]
    assert {r.alert_time for r in mine} == {str(at("10:00:00"))}
