"""Row accounting: meters, failure sample, quarantine, report, failure limit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.rows import PROCESSED, THROWN_AWAY, UNPARSEABLE
from tideline.spec import IngestSpec


class ParseFailureLimitExceeded(RuntimeError):
    """More unparseable rows than the spec allows; nothing was written."""


def meter_columns() -> list[Column]:
    d = F.col("disposition")
    return [
        F.count_if(d == PROCESSED).cast("bigint").alias("processed"),
        F.count_if(d == UNPARSEABLE).cast("bigint").alias("unparseable"),
        F.count_if(d == THROWN_AWAY).cast("bigint").alias("thrown_away"),
    ]


def ingest_meters(rows: DataFrame, spec: IngestSpec, by_batch: bool = False) -> DataFrame:
    """processed / unparseable / thrown_away counts (one global partial aggregation)."""
    keys = ["batch_id"] if by_batch else []
    return rows.groupBy(*keys).agg(*meter_columns()).select(
        F.lit(spec.data_source).alias("data_source"), *keys, "processed", "unparseable", "thrown_away"
    )


def failures(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("disposition") == UNPARSEABLE)


def quarantine(rows: DataFrame) -> DataFrame:
    """Every parse failure with its reason and payload (the failure log)."""
    return failures(rows).select("messageId", "pos", "publishTime", "reason", "data")


def failure_sample(rows: DataFrame, n: int) -> DataFrame:
    """The last ``n`` failures by publish time (ties by messageId, pos): a top-k."""
    return (
        failures(rows)
        .select("messageId", "pos", "publishTime", "reason")
        .orderBy(F.col("publishTime").desc(), F.col("messageId").desc(), F.col("pos").desc())
        .limit(n)
    )


def last_failures(rows: DataFrame, n: int) -> list[dict]:
    """``failure_sample`` as records (at most ``n`` rows reach the driver)."""
    return [r.asDict() for r in failure_sample(rows, n).collect()]


def last_of(records: list[dict], n: int) -> list[dict]:
    """The last ``n`` failures of several samples, in the order of ``failure_sample``:
    samples of batches merge into the sample of the job."""
    key = lambda r: tuple((r[c] is not None, r[c] if r[c] is not None else 0) for c in ("publishTime", "messageId", "pos"))
    return sorted(records, key=key, reverse=True)[:n]


def ingest_report(rows: DataFrame, spec: IngestSpec, report_time: datetime) -> DataFrame:
    """Status report per data source: meters, suspended flag, generation time."""
    return ingest_meters(rows, spec).select(
        "data_source",
        F.lit(report_time.isoformat(sep=" ")).cast("timestamp_ntz").alias("generated_at"),
        F.lit(spec.suspended).alias("suspended"),
        "processed",
        "unparseable",
        "thrown_away",
    )


def check_failure_limit(unparseable: int, spec: IngestSpec) -> None:
    allowed = spec.tuning.allowed_parse_exceptions
    if allowed is not None and unparseable > allowed:
        raise ParseFailureLimitExceeded(
            f"{unparseable} unparseable rows for {spec.data_source}, at most {allowed} allowed"
        )


def report_from_meters(meters: DataFrame, spec: IngestSpec, report_time: datetime) -> DataFrame:
    """Status report from the per-batch meters table of a running ingest."""
    return meters.groupBy("data_source").agg(
        F.lit(report_time.isoformat(sep=" ")).cast("timestamp_ntz").alias("generated_at"),
        F.lit(spec.suspended).alias("suspended"),
        F.count(F.lit(1)).alias("batches"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("processed", "unparseable", "thrown_away")],
    )
