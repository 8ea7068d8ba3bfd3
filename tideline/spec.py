"""Ingest spec: one frozen dataclass tree, loadable from the JSON a user submits.

Field names follow the public spec format (camelCase in JSON, snake_case
here).  Scheduling knobs (task count, replicas, task duration, ...) are not
mirrored: Spark schedules the work.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta, timezone

# Granularity names understood by the spec.  Calendar units are
# truncated with date_trunc; the others are fixed-width buckets in seconds.
CALENDAR_GRANULARITIES = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")
FIXED_GRANULARITIES = {
    "five_minute": 300,
    "ten_minute": 600,
    "fifteen_minute": 900,
    "thirty_minute": 1800,
    "six_hour": 21600,
}

# Spec defaults (rows per segment, rows per push).
DEFAULT_MAX_ROWS_PER_SEGMENT = 5_000_000
DEFAULT_MAX_TOTAL_ROWS = 25_000

_PERIOD = re.compile(
    r"^P(?:(?P<w>\d+)W)?(?:(?P<d>\d+)D)?(?:T(?:(?P<h>\d+)H)?(?:(?P<m>\d+)M)?(?:(?P<s>\d+(?:\.\d+)?)S)?)?$"
)


class SpecError(ValueError):
    """Raised for an invalid spec or a metadata mismatch."""


def parse_period(text: str | None) -> timedelta | None:
    """ISO-8601 period such as ``P10D`` or ``PT1H30M`` (no months / years)."""
    if text is None:
        return None
    m = _PERIOD.match(text.strip().upper())
    if not m or text.strip().upper() in ("P", "PT"):
        raise SpecError(f"unsupported period {text!r}")
    g = {k: float(v) if v else 0.0 for k, v in m.groupdict().items()}
    return timedelta(weeks=g["w"], days=g["d"], hours=g["h"], minutes=g["m"], seconds=g["s"])


def parse_time(text: str | datetime | None) -> datetime | None:
    """ISO timestamp as a naive UTC datetime; an offset is applied, and a time
    without one is UTC."""
    if text is None:
        return None
    t = text if isinstance(text, datetime) else datetime.fromisoformat(text.strip())
    return t if t.tzinfo is None else t.astimezone(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Field:
    """One column of the declared row schema.

    ``path`` names the key in the merged message; a dotted path reads a nested
    JSON value (``props.k``).  ``role`` is ``dimension``, ``metric`` or ``other``.
    """

    name: str
    type: str = "string"
    path: str | None = None
    role: str = "dimension"

    @property
    def source(self) -> str:
        return self.path or self.name


@dataclass(frozen=True)
class Aggregator:
    """One aggregate of the rollup: ``kind`` is count, sum, min or max."""

    name: str
    kind: str
    field: str | None = None


# Column types and aggregator types of the submitted form.
DIMENSION_TYPES = {"string": "string", "long": "bigint", "float": "float", "double": "double"}
METRIC_TYPES = {"long": "bigint", "float": "float", "double": "double"}
_AGGREGATOR = re.compile(r"^(long|float|double)(Sum|Min|Max)$")


def submitted_fields(parse_spec: dict, metrics_spec: list) -> tuple[tuple[Field, ...], tuple[Aggregator, ...]]:
    """Columns and aggregators of ``dimensionsSpec`` and ``metricsSpec``.

    A dimension is a name or an object with name and type; an aggregator reads
    ``fieldName``, which becomes a metric column of its type.
    """
    fields: dict[str, Field] = {}
    for d in (parse_spec.get("dimensionsSpec") or {}).get("dimensions") or []:
        d = {"name": d} if isinstance(d, str) else d
        kind = str(d.get("type", "string")).lower()
        if kind not in DIMENSION_TYPES:
            raise SpecError(f"unknown dimension type {kind!r}")
        if d["name"] in fields:
            raise SpecError(f"duplicate field names: {d['name']}")
        fields[d["name"]] = Field(d["name"], DIMENSION_TYPES[kind])
    aggregators = []
    for m in metrics_spec:
        if m.get("type") == "count":
            aggregators.append(Aggregator(m["name"], "count"))
            continue
        found = _AGGREGATOR.match(str(m.get("type")))
        if not found:
            raise SpecError(f"unknown aggregator type {m.get('type')!r}")
        name, type_ = m.get("fieldName") or m["name"], METRIC_TYPES[found[1]]
        known = fields.setdefault(name, Field(name, type_, role="metric"))
        if known.type != type_:
            raise SpecError(f"{name} is read as {known.type} and as {type_}")
        aggregators.append(Aggregator(m["name"], found[2].lower(), name))
    return tuple(fields.values()), tuple(aggregators)


@dataclass(frozen=True)
class DataSchema:
    data_source: str
    fields: tuple[Field, ...]
    timestamp_column: str = "ts"
    timestamp_format: str = "auto"
    query_granularity: str = "none"
    segment_granularity: str = "day"
    rows_field: str | None = None
    aggregators: tuple[Aggregator, ...] = ()

    @property
    def dimensions(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields if f.role == "dimension")

    @property
    def metrics(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields if f.role == "metric")


@dataclass(frozen=True)
class IOConfig:
    topic: str
    project_id: str = ""
    subscription_id: str = ""
    payload_encoding: str = "plain"  # plain | base64
    decompress_data: bool = False
    minimum_message_time: datetime | None = None
    maximum_message_time: datetime | None = None
    late_message_rejection_period: timedelta | None = None
    early_message_rejection_period: timedelta | None = None
    reference_time: datetime | None = None
    batch_clock: bool = False  # "referenceTime": "batch": the time when a batch is first tried
    max_messages_per_poll: int = 0
    max_message_size_per_poll: int = 0


@dataclass(frozen=True)
class TuningConfig:
    max_rows_per_segment: int = DEFAULT_MAX_ROWS_PER_SEGMENT
    max_total_rows: int = DEFAULT_MAX_TOTAL_ROWS
    max_parse_exceptions: int | None = None
    max_saved_parse_exceptions: int = 0
    log_parse_exceptions: bool = False
    report_parse_exceptions: bool = False
    intermediate_handoff_period: timedelta | None = None
    dedup_horizon: timedelta = timedelta(days=1)
    strict_segments: bool = False

    @property
    def allowed_parse_exceptions(self) -> int | None:
        """``reportParseExceptions`` means no failure is allowed."""
        if self.report_parse_exceptions:
            return 0
        return self.max_parse_exceptions

    @property
    def saved_parse_exceptions(self) -> int:
        if self.report_parse_exceptions:
            return min(1, self.max_saved_parse_exceptions)
        return self.max_saved_parse_exceptions


@dataclass(frozen=True)
class IngestSpec:
    data_schema: DataSchema
    io_config: IOConfig
    tuning: TuningConfig = field(default_factory=TuningConfig)
    suspended: bool = False
    context: dict | None = None

    def __post_init__(self):
        validate(self)

    @property
    def data_source(self) -> str:
        return self.data_schema.data_source

    def landing_path(self, root: str) -> str:
        """Landing folder of this spec's subscription under a shared root."""
        io = self.io_config
        parts = [p for p in (io.project_id, io.subscription_id or io.topic) if p]
        return "/".join([root.rstrip("/"), *parts])

    def with_io(self, **kw) -> "IngestSpec":
        return replace(self, io_config=replace(self.io_config, **kw))

    def with_tuning(self, **kw) -> "IngestSpec":
        return replace(self, tuning=replace(self.tuning, **kw))

    def with_schema(self, **kw) -> "IngestSpec":
        return replace(self, data_schema=replace(self.data_schema, **kw))

    # -- loading -----------------------------------------------------------
    @staticmethod
    def from_json(doc: str | dict) -> "IngestSpec":
        d = json.loads(doc) if isinstance(doc, str) else doc
        if "dataSchema" not in d:
            raise SpecError("dataSchema is required")
        if "ioConfig" not in d:
            raise SpecError("ioConfig is required")
        ds, io, tu = d["dataSchema"], d["ioConfig"], d.get("tuningConfig") or {}
        # a private list of fields, or the submitted form, with or without "parser"
        parse_spec = (ds.get("parser") or {}).get("parseSpec") or ds
        if "fields" in ds:
            fields = tuple(
                Field(
                    name=f["name"],
                    type=f.get("type", "string"),
                    path=f.get("path"),
                    role=f.get("role", "dimension"),
                )
                for f in ds["fields"]
            )
            aggregators = submitted_fields({}, ds.get("metricsSpec") or [])[1]
        else:
            fields, aggregators = submitted_fields(parse_spec, ds.get("metricsSpec") or [])
            if not fields:
                raise SpecError("dataSchema lists no columns: dimensionsSpec, metricsSpec or fields is required")
        ts = parse_spec.get("timestampSpec") or ds.get("timestampSpec") or {}
        gran = ds.get("granularitySpec") or {}
        schema = DataSchema(
            data_source=ds.get("dataSource", ""),
            fields=fields,
            timestamp_column=ts.get("column", "ts"),
            timestamp_format=ts.get("format", "auto"),
            query_granularity=str(gran.get("queryGranularity", "none")).lower(),
            segment_granularity=str(gran.get("segmentGranularity", "day")).lower(),
            rows_field=ds.get("rowsField"),
            aggregators=aggregators,
        )
        if "topic" not in io:
            raise SpecError("ioConfig.topic is required")
        ioc = IOConfig(
            topic=io["topic"],
            project_id=io.get("projectId", ""),
            subscription_id=io.get("subscriptionId", ""),
            payload_encoding=io.get("payloadEncoding", "plain"),
            decompress_data=bool(io.get("decompressData", False)),
            minimum_message_time=parse_time(io.get("minimumMessageTime")),
            maximum_message_time=parse_time(io.get("maximumMessageTime")),
            late_message_rejection_period=parse_period(io.get("lateMessageRejectionPeriod")),
            early_message_rejection_period=parse_period(io.get("earlyMessageRejectionPeriod")),
            reference_time=None if io.get("referenceTime") == "batch" else parse_time(io.get("referenceTime")),
            batch_clock=io.get("referenceTime") == "batch",
            max_messages_per_poll=int(io.get("maxMessagesPerPoll", 0)),
            max_message_size_per_poll=int(io.get("maxMessageSizePerPoll", 0)),
        )
        tun = TuningConfig(
            max_rows_per_segment=int(tu.get("maxRowsPerSegment", DEFAULT_MAX_ROWS_PER_SEGMENT)),
            max_total_rows=int(tu.get("maxTotalRows", DEFAULT_MAX_TOTAL_ROWS)),
            max_parse_exceptions=tu.get("maxParseExceptions"),
            max_saved_parse_exceptions=int(tu.get("maxSavedParseExceptions", 0)),
            log_parse_exceptions=bool(tu.get("logParseExceptions", False)),
            report_parse_exceptions=bool(tu.get("reportParseExceptions", False)),
            intermediate_handoff_period=parse_period(tu.get("intermediateHandoffPeriod")),
            dedup_horizon=parse_period(tu.get("dedupHorizon")) or timedelta(days=1),
            strict_segments=bool(tu.get("strictSegments", False)),
        )
        return IngestSpec(
            data_schema=schema,
            io_config=ioc,
            tuning=tun,
            suspended=bool(d.get("suspended", False)),
            context=d.get("context"),
        )


def validate(spec: IngestSpec) -> None:
    """Checks made when a spec is built (base source, roles, knobs)."""
    ds = spec.data_schema
    if not ds.data_source:
        raise SpecError("dataSource must be a non-empty name")
    if ds.fields is None:
        raise SpecError("fields must not be null")
    names = [f.name for f in ds.fields]
    if len(set(names)) != len(names):
        raise SpecError(f"duplicate field names in {names}")
    for a in ds.aggregators:
        if a.field is not None and a.field not in names:
            raise SpecError(f"aggregator {a.name} reads the unknown field {a.field}")
    if len({a.name for a in ds.aggregators}) != len(ds.aggregators):
        raise SpecError("duplicate aggregator names")
    for f in ds.fields:
        if f.role not in ("dimension", "metric", "other"):
            raise SpecError(f"unknown role {f.role!r} for {f.name}")
    for g in (ds.query_granularity,):
        if g != "none" and g not in CALENDAR_GRANULARITIES and g not in FIXED_GRANULARITIES:
            raise SpecError(f"unknown query granularity {g!r}")
    if ds.segment_granularity not in CALENDAR_GRANULARITIES and ds.segment_granularity not in FIXED_GRANULARITIES:
        raise SpecError(f"unknown segment granularity {ds.segment_granularity!r}")
    io = spec.io_config
    if io.payload_encoding not in ("plain", "base64"):
        raise SpecError(f"payloadEncoding must be plain or base64, not {io.payload_encoding!r}")
    if (io.late_message_rejection_period or io.early_message_rejection_period) and io.reference_time is None and not io.batch_clock:
        raise SpecError("late / early rejection needs an explicit referenceTime, or \"batch\"")
    if io.max_messages_per_poll < 0 or io.max_message_size_per_poll < 0:
        raise SpecError("poll limits must be >= 0")
    t = spec.tuning
    if t.max_rows_per_segment <= 0 or t.max_total_rows <= 0:
        raise SpecError("row limits must be positive")
    if t.max_parse_exceptions is not None and t.max_parse_exceptions < 0:
        raise SpecError("maxParseExceptions must be >= 0")


# -- dataset metadata (dimension / metric roles) ------------------------------


@dataclass(frozen=True)
class DatasetMetadata:
    """Base data source plus the dimension and metric column sets."""

    base_data_source: str
    dimensions: frozenset[str]
    metrics: frozenset[str]

    def __post_init__(self):
        if not self.base_data_source:
            raise SpecError("base data source must be non-empty")
        if self.dimensions is None or self.metrics is None:
            raise SpecError("dimension and metric sets must not be null")

    @staticmethod
    def of(spec: IngestSpec) -> "DatasetMetadata":
        return DatasetMetadata(
            spec.data_source, frozenset(spec.data_schema.dimensions), frozenset(spec.data_schema.metrics)
        )

    @property
    def columns(self) -> list[str]:
        """Dimensions together with metrics, in a stable order."""
        return sorted(self.dimensions | self.metrics)

    def matches(self, other: "DatasetMetadata") -> bool:
        """Same base source and the same dimension and metric *sets*."""
        return (
            self.base_data_source == other.base_data_source
            and self.dimensions == other.dimensions
            and self.metrics == other.metrics
        )

    def to_json(self) -> str:
        return json.dumps(
            {
                "baseDataSource": self.base_data_source,
                "dimensions": sorted(self.dimensions),
                "metrics": sorted(self.metrics),
            }
        )

    @staticmethod
    def from_json(text: str) -> "DatasetMetadata":
        d = json.loads(text)
        return DatasetMetadata(d["baseDataSource"], frozenset(d["dimensions"]), frozenset(d["metrics"]))
