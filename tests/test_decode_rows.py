"""Hand cases per operator (FIXTURES.md section 4)."""

import base64
import gzip
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tideline.operators.rows import decode_payload, merge, parse_payload, rows_from_envelopes
from tideline.plans.ingest import events_spec, ingest

TS = '"ts":"2024-01-10T00:00:00Z"'


def _rows(envelopes, items, spec=None):
    spec = spec or events_spec(minimum_message_time=None, maximum_message_time=None)
    return {r["messageId"]: r for r in rows_from_envelopes(envelopes(items), spec).collect()}


def test_json_object_edge_cases(envelopes):
    got = _rows(
        envelopes,
        [
            {"messageId": "dup", "data": "{" + TS + ',"a":1,"a":2,"value":1}'},
            {"messageId": "junk", "data": "{" + TS + ',"value":1} junk'},
            {"messageId": "null", "data": "null"},
            {"messageId": "empty", "data": ""},
            {"messageId": "arr", "data": "[1]"},
            {"messageId": "str", "data": '"x"'},
            {"messageId": "missing", "data": None},
            {"messageId": "notime", "data": '{"value":1}'},
            {"messageId": "badtime", "data": '{"ts":"yesterday","value":1}'},
            {"messageId": "badmetric", "data": "{" + TS + ',"value":"lots"}'},
        ],
    )
    assert got["dup"]["disposition"] == "processed"
    assert got["junk"]["disposition"] == "processed"
    for m, reason in [
        ("null", "not_object"),
        ("arr", "not_object"),
        ("str", "not_object"),
        ("empty", "bad_json"),
        ("missing", "missing_payload"),
        ("notime", "no_event_time"),
        ("badtime", "bad_event_time"),
        ("badmetric", "bad_metric"),
    ]:
        assert (got[m]["disposition"], got[m]["reason"]) == ("unparseable", reason), m


def test_duplicate_keys_last_wins(envelopes):
    env = envelopes([{"data": '{"a":1,"a":2,"b":{"c":[1,2]}}'}])
    m = merge(parse_payload(decode_payload(env, events_spec()))).select("merged").first()[0]
    assert m["a"] == "2"
    assert m["b"] == '{"c":[1,2]}'  # nested values kept as JSON


def test_attributes_win_and_null_or_empty_attributes(envelopes):
    data = "{" + TS + ',"event_type":"raw","origin":"p","value":2.5}'
    got = _rows(
        envelopes,
        [
            {"messageId": "attr", "data": data, "attributes": {"event_type": "click"}},
            {"messageId": "none", "data": data, "attributes": None},
            {"messageId": "empty", "data": data, "attributes": {}},
        ],
    )
    assert got["attr"]["event_type"] == "click" and got["attr"]["origin"] == "p"
    assert got["none"]["event_type"] == "raw" and got["empty"]["event_type"] == "raw"


def test_time_bounds_inclusive(envelopes):
    spec = events_spec(minimum_message_time=datetime(2024, 1, 5), maximum_message_time=datetime(2024, 1, 25))
    items = [
        {"messageId": "min", "data": '{"ts":"2024-01-05T00:00:00Z","value":1}'},
        {"messageId": "max", "data": '{"ts":"2024-01-25T00:00:00Z","value":1}'},
        {"messageId": "below", "data": '{"ts":"2024-01-04T23:59:59.999999Z","value":1}'},
        {"messageId": "above", "data": '{"ts":"2024-01-25T00:00:00.000001Z","value":1}'},
    ]
    got = _rows(envelopes, items, spec)
    assert got["min"]["disposition"] == got["max"]["disposition"] == "processed"
    assert (got["below"]["disposition"], got["below"]["reason"]) == ("thrown_away", "before_minimum_time")
    assert (got["above"]["disposition"], got["above"]["reason"]) == ("thrown_away", "after_maximum_time")
    unbounded = _rows(envelopes, items)
    assert {r["disposition"] for r in unbounded.values()} == {"processed"}


def test_base64_gzip_and_utf8_failures(envelopes):
    text = "{" + TS + ',"value":3}'
    b64 = base64.b64encode(text.encode()).decode()
    gz = base64.b64encode(gzip.compress(text.encode())).decode()
    bad_utf8 = base64.b64encode(gzip.compress(b"\xc3\x28")).decode()
    not_gzip = base64.b64encode(b"plain bytes").decode()
    spec_b64 = events_spec(minimum_message_time=None, maximum_message_time=None, payload_encoding="base64")
    spec_gz = spec_b64.with_io(decompress_data=True)
    got = _rows(envelopes, [{"messageId": "ok", "data": b64}, {"messageId": "bad", "data": "@@not base64@@"}], spec_b64)
    assert got["ok"]["disposition"] == "processed" and got["ok"]["value"] == 3.0
    assert got["bad"]["reason"] == "bad_base64"
    got = _rows(
        envelopes,
        [
            {"messageId": "ok", "data": gz},
            {"messageId": "notgz", "data": not_gzip},
            {"messageId": "utf8", "data": bad_utf8},
        ],
        spec_gz,
    )
    assert got["ok"]["disposition"] == "processed"
    assert got["notgz"]["reason"] == "bad_gzip"
    assert got["utf8"]["reason"] == "bad_utf8"


def test_batch_message_three_rows_and_null_row(envelopes):
    spec = events_spec(minimum_message_time=None, maximum_message_time=None).with_schema(rows_field="rows")
    data = '{"rows":[{' + TS + ',"value":1},{' + TS + ',"value":2},{' + TS + ',"value":3},null]}'
    rows = rows_from_envelopes(envelopes([{"messageId": "b", "data": data, "attributes": {"origin": "x"}}]), spec)
    got = sorted(rows.collect(), key=lambda r: r["pos"])
    assert [r["pos"] for r in got] == [0, 1, 2, 3]
    assert {r["messageId"] for r in got} == {"b"}
    assert [r["value"] for r in got[:3]] == [1.0, 2.0, 3.0]
    assert all(r["origin"] == "x" for r in got[:3])
    assert (got[3]["disposition"], got[3]["reason"]) == ("thrown_away", "null_row")


def test_numeric_times_and_unrepresentable(envelopes):
    spec = events_spec(minimum_message_time=None, maximum_message_time=None).with_schema(timestamp_format="millis")
    got = _rows(
        envelopes,
        [
            {"messageId": "ok", "data": '{"ts":1704844800123,"value":1}'},
            {"messageId": "far", "data": '{"ts":100000000000000000000,"value":1}'},
            {"messageId": "text", "data": '{"ts":"soon","value":1}'},
        ],
        spec,
    )
    assert got["ok"]["ts"] == datetime(2024, 1, 10, 0, 0, 0, 123000)
    assert got["far"]["reason"] == "unrepresentable_time"
    assert got["text"]["reason"] == "bad_event_time"


def test_late_and_early_rejection(envelopes):
    spec = events_spec(
        minimum_message_time=None,
        maximum_message_time=None,
        reference_time=datetime(2024, 1, 20),
        late_message_rejection_period=__import__("datetime").timedelta(days=10),
        early_message_rejection_period=__import__("datetime").timedelta(days=2),
    )
    got = _rows(
        envelopes,
        [
            {"messageId": "late", "data": '{"ts":"2024-01-09T23:59:59Z","value":1}'},
            {"messageId": "edge", "data": '{"ts":"2024-01-10T00:00:00Z","value":1}'},
            {"messageId": "early", "data": '{"ts":"2024-01-22T00:00:01Z","value":1}'},
        ],
        spec,
    )
    assert got["late"]["reason"] == "too_late"
    assert got["edge"]["disposition"] == "processed"
    assert got["early"]["reason"] == "too_early"


def test_dedup_keeps_one_copy_and_ledger_keeps_all(envelopes):
    data = "{" + TS + ',"value":1}'
    env = envelopes(
        [
            {"ackId": "a2", "messageId": "m", "data": data},
            {"ackId": "a1", "messageId": "m", "data": data},
            {"ackId": "b1", "messageId": "n", "data": data},
        ]
    )
    res = ingest(env, events_spec(minimum_message_time=None, maximum_message_time=None))
    assert sorted(r["messageId"] for r in res.rows.collect()) == ["m", "n"]
    assert sorted(r["ackId"] for r in res.ledger.collect()) == ["a1", "a2", "b1"]


def test_suspended_spec_reads_nothing(spark, envelopes):
    from dataclasses import replace

    spec = replace(events_spec(), suspended=True)
    rows = rows_from_envelopes(envelopes([{"data": "{}"}]), spec)
    assert rows.count() == 0
    assert "LocalTableScan" in rows._jdf.queryExecution().executedPlan().toString() or rows.isEmpty()


def test_strict_segments_raise(envelopes):
    spec = events_spec(minimum_message_time=None, maximum_message_time=None).with_tuning(strict_segments=True)
    rows = rows_from_envelopes(envelopes([{"data": "{" + TS + ',"value":1}'}]), spec)
    assert rows.first()["segment_start"] == datetime(2024, 1, 10)


@pytest.mark.parametrize("variant", ["plain", "base64", "gzip"])
def test_variants_give_same_rows(spark, variant):
    from tideline.sources import fixtures as fx

    spec = events_spec()
    if variant != "plain":
        spec = spec.with_io(payload_encoding="base64", decompress_data=variant == "gzip")
    rows = ingest(fx.envelopes(spark, "/root/testdata/sf0.001", variant), spec).rows
    plain = ingest(fx.envelopes(spark, "/root/testdata/sf0.001"), events_spec()).rows
    cols = ["messageId", "pos", "ts", "event_type", "origin", "value", "k", "disposition", "reason"]
    assert rows.select(cols).exceptAll(plain.select(cols)).isEmpty()
    assert plain.select(cols).exceptAll(rows.select(cols)).isEmpty()


def test_merged_json_keeps_json_types(envelopes):
    import json

    from tideline.functions import decode as D

    env = envelopes([{"data": '{"v":1.50,"n":{"k":[1,2]},"z":null,"e":"raw","b":true}', "attributes": {"e": "x"}}])
    df = merge(parse_payload(decode_payload(env, events_spec())))
    text = df.select(D.merged_json(F.col("payload"), F.col("payload_map"), F.col("attributes"))).first()[0]
    got = json.loads(text)
    assert got == {"v": 1.5, "n": {"k": [1, 2]}, "z": None, "e": "x", "b": True}
    # a payload with duplicate keys falls back to the last-wins string map
    env = envelopes([{"data": '{"a":1,"a":2}', "attributes": None}])
    df = merge(parse_payload(decode_payload(env, events_spec())))
    text = df.select(D.merged_json(F.col("payload"), F.col("payload_map"), F.col("attributes"))).first()[0]
    assert json.loads(text) == {"a": "2"}


def test_last_day_has_no_segment(envelopes):
    rows = [{"messageId": "m", "data": '{"ts":"9999-12-31T12:00:00Z","value":1}'}, {"messageId": "n", "data": '{"ts":"9999-12-30T12:00:00Z","value":1}'}]
    spec = events_spec(minimum_message_time=None, maximum_message_time=None)
    got = {r["messageId"]: (r["disposition"], r["reason"], r["segment_start"]) for r in rows_from_envelopes(envelopes(rows), spec).collect()}
    assert got == {"m": ("unparseable", "unallocatable", None), "n": ("processed", None, datetime(9999, 12, 30))}
    strict = spec.with_tuning(strict_segments=True)
    with pytest.raises(Exception, match="cannot allocate a segment for message m"):
        rows_from_envelopes(envelopes(rows), strict).collect()
