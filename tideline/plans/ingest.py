"""The ingest plan: landing envelopes -> dedup -> classified rows (+ ledger).

Shuffles: one for dedup (keyed by messageId, partially aggregated on the
map side), then the decode .. classify chain is a single narrow stage.
Rollups and the catalog add one partially aggregated shuffle each.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame

from tideline.operators.dedup import dedup_messages
from tideline.operators.ledger import ack_ledger
from tideline.operators.rows import rows_from_envelopes
from tideline.spec import DataSchema, Field, IngestSpec, IOConfig, TuningConfig


@dataclass
class Ingested:
    rows: DataFrame  # one row per (messageId, pos) with disposition
    ledger: DataFrame  # every received copy: ackId, messageId, batch_id


def ingest(env: DataFrame, spec: IngestSpec, batch_id: int | Column = 0, dedup: bool = True) -> Ingested:
    """Batch ingest of an envelope frame (all received copies)."""
    unique = dedup_messages(env) if dedup else env
    return Ingested(rows=rows_from_envelopes(unique, spec, batch_id), ledger=ack_ledger(env, batch_id))


# The spec the fixtures are ingested with (FIXTURES.md section 3).
EVENTS_FIELDS = (
    Field("event_id", "bigint", role="other"),
    Field("user_id", "bigint", role="dimension"),
    Field("event_type", "string", role="dimension"),
    Field("origin", "string", role="dimension"),
    Field("value", "double", role="metric"),
    Field("k", "bigint", path="props.k", role="other"),
)
DEFAULT_MIN_TIME = datetime(2024, 1, 5, 0, 0, 0)
DEFAULT_MAX_TIME = datetime(2024, 1, 25, 0, 0, 0)
REFERENCE_TIME = datetime(2024, 1, 20, 0, 0, 0)


def events_spec(**io) -> IngestSpec:
    """Spec for envelopes made from ``events``; bounds default to 2024-01-05 .. 2024-01-25."""
    io_kw = dict(
        topic="events",
        project_id="fixtures",
        subscription_id="events-sub",
        minimum_message_time=DEFAULT_MIN_TIME,
        maximum_message_time=DEFAULT_MAX_TIME,
    )
    io_kw.update(io)
    return IngestSpec(
        data_schema=DataSchema(
            data_source="events",
            fields=EVENTS_FIELDS,
            timestamp_column="ts",
            query_granularity="day",
            segment_granularity="day",
        ),
        io_config=IOConfig(**io_kw),
        tuning=TuningConfig(),
    )
