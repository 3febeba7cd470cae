from datetime import datetime

import pytest

from pageflow.operators.clean import clean_raw, json_schema, parse_events, present, split_rejects
from tests.conftest import plan_of

NOW = datetime(2024, 3, 1, 12)

KEPT = {
    '{"meta":{"domain":"a"},"page_id":1}': "a",
    '{"meta":{}}': "unknown",
    "{}": "unknown",
    ' \n{"meta":{"domain":"b"}} ': "b",
    '{"meta":{"domain":""}}': "",
    '{"meta":{"domain":"x","domain":"y"}}': "y",
}
REJECTED = [
    "bad{", "", "null", "[]", "5", '"text"', '{"meta":null}', '{"meta":"x"}', '{"meta":[]}',
    '{"meta":{"domain":null}}', '{"meta":{"domain":5}}', '{"meta":{"domain":"a"}', '{"meta":{"domain":"a"}} more',
    '[{"meta":{"domain":"a"}}]', None, "{'meta':{'domain':'x'}}", '{"meta":{"domain":"x"}} {"a":1}',
    '{"meta":{"domain":"x"}} junk }', '{"meta":{"domain":"x"}}] [1', '{"meta":{"domain":"x"}},{"a":1}',
    '{"meta":{"domain":"x"}},"y"], ["z"', '{"meta":{"domain":"x"}} // more', "{meta:{}}",
]
CANARY = '{"meta":{"domain":"canary"}}'


def raw(spark, *values):
    return spark.createDataFrame([(v, NOW) for v in values], "value string, timestamp timestamp")


@pytest.mark.parametrize("binary", [False, True])
def test_messages_are_kept_dropped_or_rejected(spark, binary):
    rows = raw(spark, *KEPT, CANARY, *REJECTED)
    if binary:
        rows = rows.selectExpr("cast(value as binary) as value", "timestamp")
    kept, rejects = split_rejects(rows)
    assert kept.columns == ["value", "timestamp", "key"]

    def text(value):
        return bytes(value).decode() if binary and value is not None else value

    assert {text(r.value): r.key for r in kept.collect()} == KEPT
    assert sorted(map(str, (text(r.value) for r in rejects.collect()))) == sorted(map(str, REJECTED))
    assert clean_raw(rows).count() == len(KEPT)


def test_parsing_keeps_every_message_unless_columns_are_required(spark):
    rows = raw(
        spark, "bad{", None,
        '{"page_id":3000000000,"page_title":"T","meta":{"domain":"d"},'
        '"performer":{"user_text":"1.2.3.4","user_is_bot":false}}')
    parsed = parse_events(rows).collect()
    assert len(parsed) == 3
    assert [r.page_id for r in parsed] == [None, None, "3000000000"]
    assert all(r.event_time == NOW for r in parsed)
    good = parse_events(rows, require=("domain", "user_name")).collect()
    assert [(r.user_name, r.user_id, r.user_is_bot, r.domain) for r in good] == [("1.2.3.4", None, False, "d")]


def test_only_the_wanted_fields_are_parsed_and_only_once(spark):
    assert json_schema(["domain", "user_is_bot"]).simpleString() == (
        "struct<meta:struct<domain:string>,performer:struct<user_is_bot:boolean>>")
    frame = parse_events(raw(spark, "{}"), columns=("domain", "user_name"), require=("domain", "user_name"))
    assert frame.columns == ["domain", "user_name", "event_time"]
    assert plan_of(frame).count("from_json") == 1


def test_present(spark):
    rows = spark.createDataFrame([("a", None), (None, 1), ("b", 2)], "x string, y int")
    assert [r.x for r in present(rows, "x", "y").collect()] == ["b"]
