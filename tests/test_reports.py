import json

from pageflow.operators import editors, reports, serving, views
from pageflow.operators.upsert import upsert
from pageflow.sources.samples import page_creates
from tests.conftest import at


def test_last_full_hours_only(events):
    rows = events(("03:59:59", "a", False, "d"), ("04:00:00", "a", False, "d"), ("09:59:59", "b", True, "d"),
                  ("10:00:00", "c", True, "d"), ("05:00:00", "x", False, None))
    found = reports.hourly_report(rows, "2024-03-01 10:32:10").orderBy("time_start").collect()
    assert [(r.time_start, r.time_end, r.bot_percent) for r in found] == [
        (at("04:00:00"), at("05:00:00"), 0.0), (at("09:00:00"), at("10:00:00"), 100.0)]
    assert reports.hourly_report(rows, "2024-03-01 10:32:10", hours=7).count() == 3


def test_authors_count_per_flag_and_unnamed_pages_count_as_pages(events):
    rows = events(("10:00:01", "a", True, "d"), ("10:00:02", "a", False, "d"), ("10:00:03", "a", False, "d"),
                  ("10:00:04", None, False, "d"), ("10:00:05", "b", None, "d"))
    row, = reports.hourly_report(rows).collect()
    assert (row.pages_created, row.unique_authors, row.bot_percent) == (5, 3, 20.0)
    assert json.loads(row.top_authors) == [
        {"name": "a", "pages": 2, "is_bot": False}, {"name": "a", "pages": 1, "is_bot": True},
        {"name": "b", "pages": 1, "is_bot": None}, {"name": None, "pages": 1, "is_bot": False}]


def test_top_ten(events):
    rows = events(*[("10:00:01", f"u{n:02}", False, "d") for n in range(12)], ("10:00:02", "u11", False, "d"))
    row, = reports.hourly_report(rows).collect()
    assert [a["name"] for a in json.loads(row.top_authors)] == ["u11", *[f"u{n:02}" for n in range(9)]]


def test_editors_with_five_pages(events):
    rows = events(*[(f"1{n}:00:00.9", "four", False, "d") for n in range(4)],
                  *[(f"1{n % 3}:00:0{n}", "five", False, "ed"[n % 2]) for n in range(4)],
                  ("23:59:59", "five", False, None), *[("10:00:00", "bot", True, "d")] * 5)
    row, = editors.editor_patterns(rows).collect()
    assert (row.user_name, row.total_pages, row.domains_count, row.specialization) == ("five", 5, 2, "d")
    assert row.active_hours == [10, 11, 12, 23]
    assert row.avg_gap_seconds == round((13 * 3600 + 59 * 60 + 59) / 4 + 0.0, 2)


def test_pages_of_one_second_have_gap_zero(events):
    row, = editors.editor_patterns(events(*[("10:00:00", "u", False, "d")] * 5)).collect()
    assert row.avg_gap_seconds == 0.0
    row, = editors.editor_patterns(events(("10:00:00", "u", False, "d")), min_pages=1).collect()
    assert (row.avg_gap_seconds, row.total_pages) == (0.0, 1)


def test_mean_gap_equals_the_mean_of_the_single_gaps(spark):
    rows = page_creates(spark.read.parquet("/root/testdata/sf0.01/events.parquet"))
    single = {r[0]: r[1] for r in editors.creation_gaps(rows).groupBy("user_name").avg("gap_seconds").collect()}
    for row in editors.editor_patterns(rows).collect():
        assert abs(single[row.user_name] - row.avg_gap_seconds) <= 0.005 + 1e-9


def test_anonymous_users_go_by_their_name(events):
    pages = views.listed_pages(events(("10:00:00", "1.2.3.4", False, "d"), ("10:00:00", None, False, "d"),
                                      ("10:00:00", "x", False, None)))
    assert [(r.user_id, r.page_id) for r in views.pages_by_user(pages).collect()] == [("1.2.3.4", "0")]


def test_reads(events):
    rows = events(*[(f"10:0{n}:00", "u", False, "d") for n in range(6)], ("11:00:00", "u", True, "d"))
    pages = views.pages_by_domain(views.listed_pages(rows))

    def ids(frame):
        return [r.page_id for r in frame.collect()]

    first, last = "2024-03-01 10:01:00", "2024-03-01 10:03:00"
    assert ids(serving.pages_of_domain(pages, "d", first, last)) == ["3", "2", "1"]
    assert ids(serving.pages_of_domain(pages, "d", from_ts=last, limit=2)) == ["6", "5"]
    assert ids(serving.pages_of_domain(pages, "d", to_ts=first)) == ["1", "0"]
    assert ids(serving.pages_of_domain(pages, "none")) == []
    users = views.pages_by_user(views.listed_pages(rows))
    assert ids(serving.pages_of_user(users, "u", limit=3)) == ["6", "5", "4"]
    details = views.page_details(views.listed_pages(rows))
    assert ids(serving.page(details, "4")) == ["4"] and ids(serving.page(details, "9")) == []
    newest, older = serving.get_hourly_report(reports.hourly_report(rows), "d").collect()
    assert (newest.time_start, newest.time_end, older.time_start) == ("11:00", "12:00", "10:00")
    assert [tuple(a) for a in older.top_authors] == [("u", 6, False)]
    assert serving.get_hourly_report(reports.hourly_report(rows), "d", hours=1).count() == 1
    assert serving.get_editor_patterns(editors.editor_patterns(rows), 7).count() == 0


def test_upsert(spark):
    schema = "id int, at int, name string"
    table = spark.createDataFrame([(1, 5, "old"), (2, 5, "kept"), (3, 5, "same")], schema)
    batch = spark.createDataFrame([(1, 6, "new"), (2, 4, "late"), (3, 5, "batch"), (4, 1, "a"), (4, 2, "b")], schema)
    by_time = upsert(table, batch, ["id"], "at")
    assert {r.id: r.name for r in by_time.collect()} == {1: "new", 2: "kept", 3: "batch", 4: "b"}
    assert by_time.columns == ["id", "at", "name"]
    assert {r.id: r.name for r in upsert(table, batch, ["id"]).collect()} == {1: "new", 2: "late", 3: "batch", 4: "b"}
    assert upsert(table.select("id"), batch.select("id"), ["id"]).count() == 4
