import json
from datetime import datetime, timedelta

import pytest

from tideline.plans.ingest import events_spec
from tideline.spec import DatasetMetadata, IngestSpec, SpecError, parse_period

SPEC = {
    "dataSchema": {
        "dataSource": "events",
        "fields": [
            {"name": "event_type"},
            {"name": "value", "type": "double", "role": "metric"},
            {"name": "k", "type": "bigint", "path": "props.k", "role": "other"},
        ],
        "timestampSpec": {"column": "ts", "format": "auto"},
        "granularitySpec": {"queryGranularity": "HOUR", "segmentGranularity": "DAY"},
    },
    "ioConfig": {
        "topic": "t",
        "projectId": "p",
        "subscriptionId": "s",
        "decompressData": True,
        "payloadEncoding": "base64",
        "minimumMessageTime": "2024-01-05T00:00:00Z",
        "lateMessageRejectionPeriod": "P10D",
        "referenceTime": "2024-01-20T00:00:00Z",
    },
    "tuningConfig": {"maxRowsPerSegment": 100, "reportParseExceptions": True, "maxSavedParseExceptions": 5},
    "suspended": False,
}


def test_spec_from_json_defaults_and_values():
    s = IngestSpec.from_json(json.dumps(SPEC))
    assert s.data_source == "events"
    assert s.data_schema.dimensions == ("event_type",)
    assert s.data_schema.metrics == ("value",)
    assert s.data_schema.query_granularity == "hour"
    assert s.io_config.decompress_data and s.io_config.payload_encoding == "base64"
    assert s.io_config.minimum_message_time == datetime(2024, 1, 5)
    assert s.io_config.maximum_message_time is None
    assert s.io_config.late_message_rejection_period == timedelta(days=10)
    assert s.tuning.max_rows_per_segment == 100
    assert s.tuning.max_total_rows == 25_000
    # reportParseExceptions: no failure allowed, at most one saved
    assert s.tuning.allowed_parse_exceptions == 0
    assert s.tuning.saved_parse_exceptions == 1


@pytest.mark.parametrize(
    "mutate",
    [
        lambda d: d["dataSchema"].update(dataSource=""),
        lambda d: d.pop("dataSchema"),
        lambda d: d.pop("ioConfig"),
        lambda d: d["ioConfig"].pop("topic"),
        lambda d: d["ioConfig"].update(payloadEncoding="hex"),
        lambda d: d["ioConfig"].pop("referenceTime"),
        lambda d: d["tuningConfig"].update(maxRowsPerSegment=0),
        lambda d: d["dataSchema"]["fields"].append({"name": "value"}),
        lambda d: d["dataSchema"]["granularitySpec"].update(queryGranularity="fortnight"),
    ],
)
def test_metadata_validate_rejects(mutate):
    d = json.loads(json.dumps(SPEC))
    mutate(d)
    with pytest.raises(SpecError):
        IngestSpec.from_json(d)


def test_periods():
    assert parse_period("PT1H30M") == timedelta(hours=1, minutes=30)
    assert parse_period("P1W") == timedelta(days=7)
    with pytest.raises(SpecError):
        parse_period("P1M2")


def test_metadata_match_is_set_based():
    a = events_spec()
    b = a.with_schema(fields=tuple(reversed(a.data_schema.fields)))
    assert DatasetMetadata.of(a).matches(DatasetMetadata.of(b))
    c = a.with_schema(fields=a.data_schema.fields[:-2])
    assert not DatasetMetadata.of(a).matches(DatasetMetadata.of(c))
    assert DatasetMetadata.of(a).columns == ["event_type", "origin", "user_id", "value"]
    with pytest.raises(SpecError):
        DatasetMetadata("", frozenset(), frozenset())
    m = DatasetMetadata.of(a)
    assert DatasetMetadata.from_json(m.to_json()) == m
