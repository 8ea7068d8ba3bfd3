"""Registered queries: one per operator of the inventory, each with its oracle.

Every query reads ``events`` of the given scale-factor folder and derives the
message envelopes from it with Spark (``tideline.sources.fixtures``), so its
work grows with the table.  Queries that exercise a sink or a stream write
to a fresh folder under the shared checkpoint root and read the result back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import decode as D
from tideline.operators import meters as M
from tideline.operators.dedup import dedup_messages
from tideline.operators.ledger import pending_redelivery
from tideline.operators.metadata import metadata_columns
from tideline.operators.rollup import processed, rollup, segment_catalog, tumbling_windows, with_query_time
from tideline.operators.rows import decode_payload, merge, parse_payload, rows_from_envelopes
from tideline.plans import oracle as O
from tideline.plans.ingest import REFERENCE_TIME, events_spec, ingest
from tideline.session import ensure_utc, scratch_path
from tideline.sinks import segments as S
from tideline.sources import fixtures as fx
from tideline.sources import landing as L
from tideline.sources.schema import ENVELOPE, ENVELOPE_COLUMNS
from tideline.spec import IngestSpec
from tideline.sinks.merge import files_by_segment, merge_ledger, merge_segments
from tideline.sources.manifest import POLLS
from tideline.operators.dedup import dedup_stream
from tideline.streaming.ingest import (
    StreamPaths,
    drain_rollup,
    ingest_landing,
    process_batch,
    read_last_failures,
    read_meters,
    read_rollup_log,
    read_rollup_updates,
    start_ingest,
    start_rollup,
    start_rollup_log,
)

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    fn: QueryFn
    sql: str | None
    headline: bool = False


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, headline: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Query(run, sql, headline)
        return run

    return deco


def r2(c: str) -> F.Column:
    return F.round(F.col(c), 2).alias(c)


def _rows(spark: SparkSession, sf_dir: str, spec=None, variant: str = "plain") -> DataFrame:
    return ingest(fx.envelopes(spark, sf_dir, variant), spec or events_spec()).rows


TYPED = ["messageId", "ts", "event_id", "user_id", "event_type", "origin", "value", "k"]
DECODE_FAILURES = ["missing_payload", "bad_base64", "bad_gzip", "bad_utf8", "bad_json", "not_object"]


# ---------------------------------------------------------------- 2.1 sources


def _landing_pulls(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "pulls")
    pulls = fx.pull_responses(fx.envelopes(spark, sf_dir, keep_event_id=True))
    pulls.select(F.to_json(F.struct("receivedMessages")).alias("value")).write.text(path)
    return path


def _attr_cols() -> list:
    return [
        F.col("attributes")["origin"].alias("attr_origin"),
        F.col("attributes")["event_type"].alias("attr_event_type"),
    ]


ENVELOPE_SQL = (
    O.BASE_ENV
    + """SELECT ackId, messageId, publishTime, data,
       CASE WHEN e % 13 <> 0 THEN concat('o', e % 5) END AS attr_origin,
       CASE WHEN e % 13 <> 0 THEN event_type END AS attr_event_type
FROM env"""
)


@register("pull_unnest", ENVELOPE_SQL)
def q_pull_unnest(spark, sf_dir):
    """Pull responses (JSON lines, one with no messages) flattened to envelopes."""
    env = L.read_pull_responses(spark, _landing_pulls(spark, sf_dir))
    return env.select("ackId", "messageId", "publishTime", "data", *_attr_cols())


@register("attach_ack_id", O.BASE_ENV + "SELECT messageId, ackId FROM env")
def q_attach_ack_id(spark, sf_dir):
    """Outer ackId copied onto messages that carry none (in-memory pulls)."""
    pulls = fx.pull_responses(fx.envelopes(spark, sf_dir, keep_event_id=True))
    return L.unnest_pull(pulls).select("messageId", "ackId")


@register("envelope_scan", ENVELOPE_SQL)
def q_envelope_scan(spark, sf_dir):
    """Envelopes landed as Parquet, read back with the declared schema."""
    path = scratch_path(spark, "landing")
    fx.envelopes(spark, sf_dir).write.parquet(path)
    env = L.read_envelopes(spark, path)
    return env.select("ackId", "messageId", "publishTime", "data", *_attr_cols())


@register(
    "publish_time",
    O.BASE_ENV + "SELECT ackId, messageId, ts + to_seconds(e % 7) AS publish_ts FROM env",
)
def q_publish_time(spark, sf_dir):
    env = fx.envelopes(spark, sf_dir)
    return env.select("ackId", "messageId", F.try_to_timestamp("publishTime").cast("timestamp_ntz").alias("publish_ts"))


@register(
    "multi_source",
    O.BASE_ENV
    + "SELECT CASE WHEN e % 2 = 0 THEN 'sub-even' ELSE 'sub-odd' END AS subscription, ackId, messageId FROM env",
)
def q_multi_source(spark, sf_dir):
    """Two subscriptions, two landing folders, one table (``unionByName``)."""
    env = fx.envelopes(spark, sf_dir, keep_event_id=True)
    paths = {}
    for name, parity in (("sub-even", 0), ("sub-odd", 1)):
        paths[name] = scratch_path(spark, name)
        env.filter(F.col("event_id") % 2 == parity).drop("event_id", "delivery").write.parquet(paths[name])
    both = L.union_subscriptions({n: L.read_envelopes(spark, p) for n, p in paths.items()})
    return both.select("subscription", "ackId", "messageId")


# ---------------------------------------------------------------- 2.2 decode

PAYLOAD_SQL = O.BASE_ENV + "SELECT ackId, messageId, data AS payload FROM env"


@register("base64_payload", PAYLOAD_SQL)
def q_base64_payload(spark, sf_dir):
    env = fx.envelopes(spark, sf_dir, "base64")
    spec = events_spec(payload_encoding="base64")
    return decode_payload(env, spec).select("ackId", "messageId", "payload")


@register("gunzip_payload", PAYLOAD_SQL, headline=True)
def q_gunzip_payload(spark, sf_dir):
    env = fx.envelopes(spark, sf_dir, "gzip")
    spec = events_spec(payload_encoding="base64", decompress_data=True)
    return decode_payload(env, spec).select("ackId", "messageId", "payload")


def _parsed(spark, sf_dir) -> DataFrame:
    env = dedup_messages(fx.envelopes(spark, sf_dir))
    return merge(parse_payload(decode_payload(env, events_spec())))


@register(
    "parse_json_object",
    O.BASE
    + """SELECT messageId, bad IS NULL OR bad IN ('no_event_time', 'bad_event_time') AS is_object,
       CAST(CASE WHEN bad IS NULL OR bad = 'bad_event_time' THEN 6 WHEN bad = 'no_event_time' THEN 5 END AS INTEGER) AS n_keys,
       CASE WHEN bad IS NULL THEN strftime(ts, """
    + O.ISO
    + """) WHEN bad = 'bad_event_time' THEN 'not a time' END AS p_ts,
       CASE WHEN bad IS NULL OR bad IN ('no_event_time', 'bad_event_time') THEN p_event_type END AS p_event_type,
       CASE WHEN bad IS NULL OR bad IN ('no_event_time', 'bad_event_time') THEN value END AS p_value,
       CASE WHEN bad IN ('bad_json', 'not_object') THEN bad END AS parse_error
FROM txt""",
)
def q_parse_json_object(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    m = F.col("payload_map")
    return p.select(
        "messageId",
        m.isNotNull().alias("is_object"),
        F.when(m.isNotNull(), F.size(m)).alias("n_keys"),
        m["ts"].alias("p_ts"),
        m["event_type"].alias("p_event_type"),
        m["value"].try_cast("double").alias("p_value"),
        "parse_error",
    )


@register(
    "merge_attributes",
    O.BASE
    + """SELECT messageId,
       CASE WHEN bad IS NULL OR bad IN ('no_event_time', 'bad_event_time') THEN m_event_type END AS m_event_type,
       CASE WHEN bad IS NULL OR bad IN ('no_event_time', 'bad_event_time') THEN origin END AS m_origin,
       CAST(CASE WHEN bad IS NULL OR bad = 'bad_event_time' THEN 6 WHEN bad = 'no_event_time' THEN 5 END
            + CASE WHEN e % 13 <> 0 THEN 1 ELSE 0 END AS INTEGER) AS n_keys
FROM txt""",
)
def q_merge_attributes(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    m = F.col("merged")
    return p.select(
        "messageId",
        m["event_type"].alias("m_event_type"),
        m["origin"].alias("m_origin"),
        F.when(m.isNotNull(), F.size(m)).alias("n_keys"),
    )


@register(
    "merged_json",
    O.BASE
    + """SELECT messageId,
       CASE WHEN bad IS NULL THEN strftime(ts, """
    + O.ISO
    + """) WHEN bad = 'bad_event_time' THEN 'not a time' END AS j_ts,
       CASE WHEN bad IS NULL OR bad IN ('no_event_time', 'bad_event_time') THEN e END AS j_event_id,
       CASE WHEN bad IS NULL OR bad IN ('no_event_time', 'bad_event_time') THEN m_event_type END AS j_event_type,
       CASE WHEN bad IS NULL OR bad IN ('no_event_time', 'bad_event_time') THEN origin END AS j_origin,
       CASE WHEN bad IS NULL OR bad IN ('no_event_time', 'bad_event_time') THEN value END AS j_value,
       CASE WHEN bad IS NULL OR bad IN ('no_event_time', 'bad_event_time') THEN k END AS j_k
FROM txt""",
)
def q_merged_json(spark, sf_dir):
    """Merged object back to JSON text; nested ``props`` stays an object."""
    p = _parsed(spark, sf_dir).withColumn(
        "mj", D.merged_json(F.col("payload"), F.col("payload_map"), F.col("attributes"))
    )
    j = F.col("mj")
    return p.select(
        "messageId",
        F.get_json_object(j, "$.ts").alias("j_ts"),
        F.get_json_object(j, "$.event_id").cast("bigint").alias("j_event_id"),
        F.get_json_object(j, "$.event_type").alias("j_event_type"),
        F.get_json_object(j, "$.origin").alias("j_origin"),
        F.get_json_object(j, "$.value").cast("double").alias("j_value"),
        F.get_json_object(j, "$.props.k").cast("bigint").alias("j_k"),
    )


TYPED_SQL = (
    O.BASE_CLS
    + """SELECT messageId, tts AS ts, e AS event_id, user_id, m_event_type AS event_type, origin, value, k
FROM cls WHERE bad IS NULL OR bad IN ('no_event_time', 'bad_event_time')"""
)


@register("typed_rows", TYPED_SQL, headline=True)
def q_typed_rows(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    return rows.filter(F.col("reason").isNull() | ~F.col("reason").isin(DECODE_FAILURES)).select(*TYPED)


def _batch_spec():
    return events_spec(minimum_message_time=None, maximum_message_time=None).with_schema(rows_field="rows")


@register(
    "explode_batch",
    O.BATCH + "SELECT messageId, pos, event_id, ts, event_type, origin, value FROM brows WHERE event_id IS NOT NULL",
)
def q_explode_batch(spark, sf_dir):
    """One message -> several rows, keyed by (messageId, pos)."""
    rows = rows_from_envelopes(dedup_messages(fx.batch_envelopes(spark, sf_dir)), _batch_spec())
    return rows.filter(F.col("event_id").isNotNull()).select(
        "messageId", "pos", "event_id", "ts", "event_type", "origin", "value"
    )


# ---------------------------------------------------------------- 2.3 filters


@register("drop_null_rows", O.BATCH + "SELECT messageId, pos, disposition, reason FROM brows")
def q_drop_null_rows(spark, sf_dir):
    rows = rows_from_envelopes(dedup_messages(fx.batch_envelopes(spark, sf_dir)), _batch_spec())
    return rows.select("messageId", "pos", "disposition", "reason")


@register("message_time_bounds", O.BASE_CLS + f"SELECT messageId, ts FROM cls WHERE {O.PROCESSED}")
def q_message_time_bounds(spark, sf_dir):
    """min <= event time <= max, both ends inclusive."""
    return processed(_rows(spark, sf_dir)).select("messageId", "ts")


def _disposition_sql(conds) -> str:
    return O.base_cls(conds) + "SELECT messageId, tts AS ts, disposition, reason FROM cls"


@register("late_rejection", _disposition_sql([("ts < TIMESTAMP '2024-01-10 00:00:00'", "too_late")]))
def q_late_rejection(spark, sf_dir):
    """Rows older than reference time - P10D are thrown away."""
    spec = events_spec(
        minimum_message_time=None,
        maximum_message_time=None,
        reference_time=REFERENCE_TIME,
        late_message_rejection_period=timedelta(days=10),
    )
    return _rows(spark, sf_dir, spec).select("messageId", "ts", "disposition", "reason")


@register("early_rejection", _disposition_sql([("ts > TIMESTAMP '2024-01-22 00:00:00'", "too_early")]))
def q_early_rejection(spark, sf_dir):
    """Rows newer than reference time + P2D are thrown away."""
    spec = events_spec(
        minimum_message_time=None,
        maximum_message_time=None,
        reference_time=REFERENCE_TIME,
        early_message_rejection_period=timedelta(days=2),
    )
    return _rows(spark, sf_dir, spec).select("messageId", "ts", "disposition", "reason")


@register(
    "representable_timestamp",
    (
        O.with_ctes(O.FX)
        + """SELECT concat('t', e) AS messageId,
       CASE WHEN e % 71 <> 0 THEN make_timestamp((epoch_us(ts) // 1000) * 1000) END AS ts,
       CASE WHEN e % 71 = 0 THEN 'unparseable' ELSE 'processed' END AS disposition,
       CASE WHEN e % 71 = 0 THEN 'unrepresentable_time' END AS reason
FROM fx"""
    ),
)
def q_representable_timestamp(spark, sf_dir):
    """Epoch-millisecond times; one in 71 lies beyond what a timestamp holds."""
    env = fx.epoch_envelopes(spark, sf_dir)
    spec = events_spec(minimum_message_time=None, maximum_message_time=None).with_schema(timestamp_format="millis")
    return rows_from_envelopes(env, spec).select("messageId", "ts", "disposition", "reason")


@register(
    "suspended_gate",
    O.BASE_CLS
    + """SELECT 'events' AS data_source,
       count(*) FILTER (WHERE disposition = 'processed') AS processed,
       count(*) FILTER (WHERE disposition = 'unparseable') AS unparseable,
       count(*) FILTER (WHERE disposition = 'thrown_away') AS thrown_away
FROM cls UNION ALL SELECT 'paused', 0, 0, 0""",
)
def q_suspended_gate(spark, sf_dir):
    """Two specs over the same messages: the running one counts them all, the
    suspended one nothing (Catalyst folds its scan away)."""
    running = events_spec()
    paused = replace(running.with_schema(data_source="paused"), suspended=True)
    counted = [M.ingest_meters(_rows(spark, sf_dir, spec), spec) for spec in (running, paused)]
    return counted[0].unionByName(counted[1])


# ---------------------------------------------------------------- 2.4 time, rollup


@register(
    "query_granularity",
    O.BASE_CLS
    + f"""SELECT messageId, date_trunc('hour', ts) AS t_hour, time_bucket(INTERVAL 15 MINUTE, ts) AS t_15m
FROM cls WHERE {O.PROCESSED}""",
)
def q_query_granularity(spark, sf_dir):
    rows = processed(_rows(spark, sf_dir))
    rows = with_query_time(rows, "hour", "t_hour")
    rows = with_query_time(rows, "fifteen_minute", "t_15m")
    return rows.select("messageId", "t_hour", "t_15m")


@register(
    "segment_interval",
    O.BASE_CLS
    + f"""SELECT messageId, date_trunc('day', ts) AS segment_start, date_trunc('day', ts) + INTERVAL 1 DAY AS segment_end
FROM cls WHERE {O.PROCESSED}""",
)
def q_segment_interval(spark, sf_dir):
    return processed(_rows(spark, sf_dir)).select("messageId", "segment_start", "segment_end")


@register(
    "segment_catalog",
    O.BASE_CLS
    + f"""SELECT date_trunc('day', ts) AS segment_start, date_trunc('day', ts) + INTERVAL 1 DAY AS segment_end,
       count(*) AS rows, min(ts) AS min_ts, max(ts) AS max_ts, CAST(ceil(count(*) / 100) AS BIGINT) AS files_expected
FROM cls WHERE {O.PROCESSED} GROUP BY 1, 2""",
)
def q_segment_catalog(spark, sf_dir):
    spec = events_spec().with_tuning(max_rows_per_segment=100)
    return segment_catalog(_rows(spark, sf_dir, spec), spec)


ROLLUP_SQL = (
    O.BASE_CLS
    + f"""SELECT date_trunc('day', ts) AS t, m_event_type AS event_type, count(*) AS rows,
       round(sum(value), 2) AS value_sum, min(value) AS value_min, max(value) AS value_max
FROM cls WHERE {O.PROCESSED} GROUP BY 1, 2"""
)


def rollup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and value per day and event type from raw envelopes (the flagship)."""
    spec = events_spec()
    r = rollup(_rows(spark, sf_dir, spec), spec, dimensions=["event_type"], granularity="day")
    return r.select("t", "event_type", "rows", r2("value_sum"), "value_min", "value_max")


register("rollup", ROLLUP_SQL, headline=True)(rollup_query)


@register(
    "tumbling_segments",
    O.BASE_CLS
    + f"""SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       count(*) AS rows FROM cls WHERE {O.PROCESSED} GROUP BY 1, 2""",
)
def q_tumbling_segments(spark, sf_dir):
    return tumbling_windows(_rows(spark, sf_dir), "1 day")


# ---------------------------------------------------------------- 2.6 accounting

DISPOSITION_SQL = O.BASE_CLS + "SELECT messageId, disposition, reason FROM cls"


@register("row_disposition", DISPOSITION_SQL, headline=True)
def q_row_disposition(spark, sf_dir):
    return _rows(spark, sf_dir).select("messageId", "disposition", "reason")


METERS_SQL = (
    O.BASE_CLS
    + """SELECT 'events' AS data_source,
       count(*) FILTER (WHERE disposition = 'processed') AS processed,
       count(*) FILTER (WHERE disposition = 'unparseable') AS unparseable,
       count(*) FILTER (WHERE disposition = 'thrown_away') AS thrown_away
FROM cls"""
)


@register("ingest_meters", METERS_SQL, headline=True)
def q_ingest_meters(spark, sf_dir):
    return M.ingest_meters(_rows(spark, sf_dir), events_spec())


@register(
    "parse_failure_sample",
    O.BASE_CLS
    + """SELECT messageId, CAST(0 AS INTEGER) AS pos, publishTime, reason FROM cls
WHERE disposition = 'unparseable' ORDER BY publishTime DESC, messageId DESC LIMIT 10""",
)
def q_parse_failure_sample(spark, sf_dir):
    """The last 10 parse failures by publish time (a top-k by design)."""
    return M.failure_sample(_rows(spark, sf_dir), 10)


@register(
    "parse_failure_log",
    O.BASE_CLS + "SELECT messageId, CAST(0 AS INTEGER) AS pos, publishTime, reason, data FROM cls WHERE disposition = 'unparseable'",
)
def q_parse_failure_log(spark, sf_dir):
    """Quarantine: every failure with reason and payload."""
    return M.quarantine(_rows(spark, sf_dir))


@register(
    "ingest_report",
    O.BASE_CLS
    + """SELECT 'events' AS data_source, TIMESTAMP '2024-02-01 00:00:00' AS generated_at, false AS suspended,
       count(*) FILTER (WHERE disposition = 'processed') AS processed,
       count(*) FILTER (WHERE disposition = 'unparseable') AS unparseable,
       count(*) FILTER (WHERE disposition = 'thrown_away') AS thrown_away
FROM cls""",
)
def q_ingest_report(spark, sf_dir):
    return M.ingest_report(_rows(spark, sf_dir), events_spec(), datetime(2024, 2, 1))


# ---------------------------------------------------------------- 2.7 metadata


@register(
    "metadata_columns",
    O.BASE_CLS + f"SELECT m_event_type AS event_type, origin, user_id, value FROM cls WHERE {O.PROCESSED}",
)
def q_metadata_columns(spark, sf_dir):
    spec = events_spec()
    return metadata_columns(processed(_rows(spark, sf_dir, spec)), spec)


SEGMENT_ROWS_SQL = (
    O.BASE_CLS + f"SELECT date_trunc('day', ts) AS segment_start, count(*) AS rows FROM cls WHERE {O.PROCESSED} GROUP BY 1"
)


def _table(spark: SparkSession, name: str) -> StreamPaths:
    root = scratch_path(spark, name)
    return StreamPaths(
        landing=f"{root}/landing",
        table=f"{root}/rows",
        ledger=f"{root}/ledger",
        meters=f"{root}/meters",
        checkpoint=f"{root}/checkpoint",
    )


def _segment_counts(spark, paths: StreamPaths, spec) -> DataFrame:
    return S.read_segments(spark, paths.table, spec).groupBy("segment_start").agg(F.count(F.lit(1)).alias("rows"))


def _publish_before(t: str):
    return F.col("publishTime") < F.lit(t)


def _arrivals(spark, paths: StreamPaths, env: DataFrame, parts: list) -> list[DataFrame]:
    """The messages of each part (conditions that exclude each other), landed once in
    a folder of their own, so a batch reads its own messages and no others."""
    number = F.coalesce(*[F.when(part, n) for n, part in enumerate(parts)])
    env.withColumn("_part", number).filter(F.col("_part").isNotNull()).write.partitionBy("_part").parquet(paths.landing)
    landed = spark.read.schema(T.StructType([*ENVELOPE.fields, T.StructField("_part", T.IntegerType())])).parquet(paths.landing)
    return [landed.filter(F.col("_part") == n).select(*ENVELOPE_COLUMNS) for n in range(len(parts))]


@register("metadata_match", SEGMENT_ROWS_SQL)
def q_metadata_match(spark, sf_dir):
    """Two appends whose specs list the same roles in another order: accepted."""
    spec_a = events_spec()
    spec_b = spec_a.with_schema(fields=tuple(reversed(spec_a.data_schema.fields)))
    paths = _table(spark, "metadata-match")
    env = fx.envelopes(spark, sf_dir)
    cut = "2024-01-15T00:00:00.000000Z"
    process_batch(env.filter(_publish_before(cut)), 0, spec_a, paths)
    process_batch(env.filter(~_publish_before(cut)), 1, spec_b, paths)
    return _segment_counts(spark, paths, spec_a)


# ---------------------------------------------------------------- 2.8 dedup, ledger


@register(
    "dedup_message_id",
    O.BASE + "SELECT messageId, concat('a', e, '-0') AS ackId, publishTime FROM txt",
    headline=True,
)
def q_dedup_message_id(spark, sf_dir):
    """One envelope per messageId; the copy with the smallest (publishTime, ackId) wins."""
    return dedup_messages(fx.envelopes(spark, sf_dir)).select("messageId", "ackId", "publishTime")


@register("ack_ledger", O.BASE_ENV + "SELECT ackId, messageId, CAST(0 AS BIGINT) AS batch_id FROM env")
def q_ack_ledger(spark, sf_dir):
    """Every received copy, written after the batch's rows."""
    paths = _table(spark, "ledger")
    process_batch(fx.envelopes(spark, sf_dir), 0, events_spec(), paths)
    return S.read_ledger(spark, paths.ledger).select("ackId", "messageId", "batch_id")


@register(
    "pending_redelivery",
    O.BASE_ENV + "SELECT ackId, messageId FROM env WHERE publishTime >= '2024-01-15T00:00:00.000000Z'",
)
def q_pending_redelivery(spark, sf_dir):
    """Batch 0 commits what was published before Jan 15; the rest is pending."""
    paths = _table(spark, "pending")
    env = fx.envelopes(spark, sf_dir)
    process_batch(env.filter(_publish_before("2024-01-15T00:00:00.000000Z")), 0, events_spec(), paths)
    return pending_redelivery(env, S.read_ledger(spark, paths.ledger)).select("ackId", "messageId")


# ---------------------------------------------------------------- 2.5 sinks


@register(
    "segment_write",
    O.BASE_CLS
    + f"""SELECT messageId, ts, m_event_type AS event_type, value, date_trunc('day', ts) AS segment_start
FROM cls WHERE {O.PROCESSED}""",
    headline=True,
)
def q_segment_write(spark, sf_dir):
    spec = events_spec()
    paths = _table(spark, "segments")
    process_batch(fx.envelopes(spark, sf_dir), 0, spec, paths)
    return S.read_segments(spark, paths.table, spec).select("messageId", "ts", "event_type", "value", "segment_start")


@register(
    "size_bounded_files",
    O.BASE_CLS
    + f"""SELECT date_trunc('day', ts) AS segment_start, count(*) AS rows, CAST(0 AS BIGINT) AS files_over_limit
FROM cls WHERE {O.PROCESSED} GROUP BY 1""",
)
def q_size_bounded_files(spark, sf_dir):
    """maxRowsPerSegment = 100: no file holds more, the rows are unchanged."""
    spec = events_spec().with_tuning(max_rows_per_segment=100)
    paths = _table(spark, "bounded")
    process_batch(fx.envelopes(spark, sf_dir), 0, spec, paths)
    per_file = (
        S.read_segments(spark, paths.table, spec)
        .groupBy("segment_start", F.input_file_name().alias("file"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_file.groupBy("segment_start").agg(
        F.sum("n").cast("bigint").alias("rows"), F.count_if(F.col("n") > 100).cast("bigint").alias("files_over_limit")
    )


@register(
    "sequence_tag",
    O.BASE_CLS
    + """SELECT messageId, CAST(CASE WHEN publishTime < '2024-01-11T00:00:00.000000Z' THEN 0
                         WHEN publishTime < '2024-01-21T00:00:00.000000Z' THEN 1 ELSE 2 END AS BIGINT) AS batch_id
FROM cls""",
)
def q_sequence_tag(spark, sf_dir):
    """Three batches by publish time; every row carries its batch id."""
    spec = events_spec()
    paths = _table(spark, "sequence")
    env = fx.envelopes(spark, sf_dir)
    first, second = (_publish_before(t) for t in ("2024-01-11T00:00:00.000000Z", "2024-01-21T00:00:00.000000Z"))
    for n, part in enumerate(_arrivals(spark, paths, env, [first, ~first & second, ~second])):
        process_batch(part, n, spec, paths)
    return S.read_rows(spark, paths.table, spec).select("messageId", "batch_id")


@register(
    "interval_purge",
    O.BASE_CLS
    + f"""SELECT date_trunc('day', ts) AS segment_start, count(*) AS rows FROM cls
WHERE {O.PROCESSED} AND NOT (ts >= TIMESTAMP '2024-01-10 12:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00')
GROUP BY 1""",
)
def q_interval_purge(spark, sf_dir):
    """Purge [Jan 10 12:00, Jan 15): four segments deleted, one rewritten."""
    spec = events_spec()
    paths = _table(spark, "purge")
    process_batch(fx.envelopes(spark, sf_dir), 0, spec, paths)
    S.purge_interval(spark, paths.table, spec, datetime(2024, 1, 10, 12), datetime(2024, 1, 15))
    return _segment_counts(spark, paths, spec)


@register(
    "purge_dispositions",
    O.BASE_CLS
    + """SELECT disposition, count(*) AS rows, CAST(0 AS BIGINT) AS files_over_limit FROM cls
WHERE tts IS NULL OR NOT (tts >= TIMESTAMP '2024-01-01 00:00:00' AND tts < TIMESTAMP '2024-01-10 12:00:00')
GROUP BY 1""",
)
def q_purge_dispositions(spark, sf_dir):
    """A purge takes the rows of every disposition and keeps the bound of files."""
    spec = events_spec().with_tuning(max_rows_per_segment=100)
    paths = _table(spark, "purge-all")
    process_batch(fx.envelopes(spark, sf_dir), 0, spec, paths)
    S.purge_interval(spark, paths.table, spec, datetime(2024, 1, 1), datetime(2024, 1, 10, 12))
    files = S.read_rows(spark, paths.table, spec).groupBy("disposition", F.input_file_name().alias("file")).count()
    return files.groupBy("disposition").agg(
        F.sum("count").cast("bigint").alias("rows"), F.count_if(F.col("count") > 100).cast("bigint").alias("files_over_limit")
    )


PROCESSED_ROWS_SQL = O.BASE_CLS + f"SELECT messageId, ts FROM cls WHERE {O.PROCESSED}"


@register("idempotent_commit", PROCESSED_ROWS_SQL)
def q_idempotent_commit(spark, sf_dir):
    """The same batch committed twice: the table is unchanged."""
    spec = events_spec()
    paths = _table(spark, "replay")
    env = fx.envelopes(spark, sf_dir)
    process_batch(env, 0, spec, paths)
    process_batch(env, 0, spec, paths)
    return S.read_segments(spark, paths.table, spec).select("messageId", "ts")


# ---------------------------------------------------------------- streams


def _land(spark, sf_dir, paths: StreamPaths, files: int = 8) -> None:
    env = fx.envelopes(spark, sf_dir)
    # round-robin files: copies of a message may land in different micro-batches
    L.land_envelopes(env.repartition(files), paths.landing)


def _stream(spark, sf_dir, name, spec=None, files=8, **kw) -> StreamPaths:
    spec = spec or events_spec()
    paths = _table(spark, name)
    _land(spark, sf_dir, paths, files)
    q = start_ingest(spark, spec, paths, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return paths


@register("drain_available", PROCESSED_ROWS_SQL, headline=True)
def q_drain_available(spark, sf_dir):
    """availableNow: read the landing folder until it is empty, then stop."""
    spec = events_spec()
    paths = _stream(spark, sf_dir, "drain", spec)
    return S.read_segments(spark, paths.table, spec).select("messageId", "ts")


BOUNDED_SQL = O.BASE_CLS + "SELECT messageId, disposition, reason, true AS kept FROM cls"


def _landed(spark, paths: StreamPaths) -> DataFrame:
    """(ackId, path, bytes): which landed file each copy came in."""
    meta = F.col("_metadata")
    return spark.read.parquet(paths.landing).select("ackId", meta["file_path"].alias("path"), meta["file_size"].alias("bytes"))


def _kept(spark, paths: StreamPaths, spec, per_batch: DataFrame) -> DataFrame:
    """Rows with whether their batch kept its bound (``batch_id``, ``kept``)."""
    rows = S.read_rows(spark, paths.table, spec).join(per_batch, "batch_id")
    return rows.select("messageId", "disposition", "reason", "kept")


@register("bounded_poll", BOUNDED_SQL)
def q_bounded_poll(spark, sf_dir):
    """At most 2 landing files per micro-batch; copies across batches are deduplicated."""
    spec = events_spec()
    paths = _stream(spark, sf_dir, "poll", spec, max_files_per_trigger=2)
    came = S.read_ledger(spark, paths.ledger).join(_landed(spark, paths), "ackId").groupBy("batch_id").agg((F.count_distinct("path") <= 2).alias("kept"))
    return _kept(spark, paths, spec, came)


@register("bounded_poll_bytes", BOUNDED_SQL)
def q_bounded_poll_bytes(spark, sf_dir):
    """Byte-bounded micro-batches (maxBytesPerTrigger): several files within the
    bound, or one."""
    spec, bound = events_spec(), 256 * 1024
    paths = _stream(spark, sf_dir, "poll-bytes", spec, max_bytes_per_trigger=bound)
    files = S.read_ledger(spark, paths.ledger).join(_landed(spark, paths), "ackId").select("batch_id", "path", "bytes").distinct()
    came = files.groupBy("batch_id").agg(((F.sum("bytes") <= bound) | (F.count(F.lit(1)) == 1)).alias("kept"))
    return _kept(spark, paths, spec, came)


@register("periodic_publish", DISPOSITION_SQL)
def q_periodic_publish(spark, sf_dir):
    """A running stream that publishes by the clock (intermediateHandoffPeriod)
    until all that is landed is in the table; then it is stopped."""
    spec, paths = events_spec().with_tuning(intermediate_handoff_period=timedelta(seconds=1)), _table(spark, "periodic")
    _land(spark, sf_dir, paths)
    q = start_ingest(spark, spec, paths, max_files_per_trigger=4, available_now=False)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return S.read_rows(spark, paths.table, spec).select("messageId", "disposition", "reason")


@register(
    "reject_unallocatable",
    O.with_ctes(O.FX)
    + """SELECT concat('t', e) AS messageId, CASE WHEN e % 71 = 0 OR e % 73 = 0 THEN 'unparseable' ELSE 'processed' END AS disposition,
       CASE WHEN e % 71 = 0 THEN 'unrepresentable_time' WHEN e % 73 = 0 THEN 'unallocatable' END AS reason,
       CASE WHEN e % 71 <> 0 AND e % 73 <> 0 THEN date_trunc('day', ts) END AS segment_start
FROM fx""",
)
def q_reject_unallocatable(spark, sf_dir):
    """Rows on the last day that a timestamp holds: their segment would end beyond."""
    spec = events_spec(minimum_message_time=None, maximum_message_time=None).with_schema(timestamp_format="millis")
    rows = rows_from_envelopes(fx.epoch_envelopes(spark, sf_dir, last_day_every=73), spec)
    return rows.select("messageId", "disposition", "reason", "segment_start")


@register("publish", METERS_SQL)
def q_publish(spark, sf_dir):
    """Every micro-batch commits: the per-batch meters add up to the whole input."""
    spec = events_spec()
    paths = _stream(spark, sf_dir, "publish", spec, max_files_per_trigger=3)
    m = read_meters(spark, paths.meters)
    return m.groupBy("data_source").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("processed", "unparseable", "thrown_away")]
    )


@register("rollup_stream", ROLLUP_SQL, headline=True)
def q_rollup_stream(spark, sf_dir):
    """Query 1 (ingest) then query 2 (watermark + window rollup, update mode; the
    landed files are in no order of time, so rows may be a month late)."""
    spec = events_spec()
    paths = _stream(spark, sf_dir, "rollup-stream", spec, max_files_per_trigger=4)
    return _rolled(_streamed_rollup(spark, spec, paths))


def _rolled(r: DataFrame) -> DataFrame:
    return r.select("t", "event_type", "rows", r2("value_sum"), "value_min", "value_max")


def _streamed_rollup(spark, spec, paths: StreamPaths, late: str = "31 days") -> DataFrame:
    out = f"{paths.table}_rollup"
    q = start_rollup(spark, spec, paths.table, out, f"{paths.checkpoint}_rollup", None, ["event_type"], late)
    q.awaitTermination()
    return read_rollup_updates(spark, out, ["event_type"])


@register("rollup_stream_replay", ROLLUP_SQL)
def q_rollup_stream_replay(spark, sf_dir):
    """Ingest, roll up, replay a committed batch, roll up again: nothing doubles."""
    spec = events_spec()
    paths = _table(spark, "rollup-replay")
    env = fx.envelopes(spark, sf_dir)
    cut = "2024-01-15T00:00:00.000000Z"
    for batch, part in enumerate((env.filter(_publish_before(cut)), env.filter(~_publish_before(cut)))):
        process_batch(part, batch, spec, paths)
    _streamed_rollup(spark, spec, paths)
    process_batch(env.filter(_publish_before(cut)), 0, spec, paths)
    return _rolled(_streamed_rollup(spark, spec, paths))


def _rollup_sql(bucket: str) -> str:
    return ROLLUP_SQL.replace("date_trunc('day', ts) AS t", f"{bucket} AS t")


@register("rollup_week", _rollup_sql("date_trunc('week', ts)"))
def q_rollup_week(spark, sf_dir):
    """Weeks start on Monday."""
    spec = events_spec().with_schema(query_granularity="week")
    return _rolled(rollup(_rows(spark, sf_dir, spec), spec, dimensions=["event_type"]))


@register("rollup_stream_week", _rollup_sql("date_trunc('week', ts)"))
def q_rollup_stream_week(spark, sf_dir):
    """The streamed rollup has the buckets of the batch rollup."""
    spec = events_spec().with_schema(query_granularity="week")
    paths = _table(spark, "rollup-week")
    process_batch(fx.envelopes(spark, sf_dir), 0, spec, paths)
    return _rolled(_streamed_rollup(spark, spec, paths))


@register("rollup_stream_week_late", _rollup_sql("date_trunc('week', ts)"))
def q_rollup_stream_week_late(spark, sf_dir):
    """Messages come up to 19 hours late, in batches that end on Monday at 6:00:
    rows of the week before come after rows of the new week, within the delay."""
    spec = events_spec().with_schema(query_granularity="week")
    paths = _table(spark, "rollup-week-late")
    hours = F.pmod(F.crc32(F.col("messageId").cast("binary")), F.lit(20))
    env = fx.envelopes(spark, sf_dir)
    come = F.to_timestamp("publishTime") + F.make_dt_interval(hours=hours.cast("int"))
    cuts = [F.to_timestamp(F.lit(f"2024-01-{day:02d} 06:00:00")) for day in (8, 15, 22)]
    number = sum((F.when(come >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    for batch in range(len(cuts) + 1):
        process_batch(env.filter(number == batch), batch, spec, paths)
        rolled = _streamed_rollup(spark, spec, paths, "1 day")
    return _rolled(rolled)


@register("rollup_none", _rollup_sql("ts"))
def q_rollup_none(spark, sf_dir):
    """Without a query granularity the event time stays as it is."""
    spec = events_spec().with_schema(query_granularity="none")
    return _rolled(rollup(_rows(spark, sf_dir, spec), spec, dimensions=["event_type"]))


@register(
    "rollup_submitted_spec",
    O.BASE_CLS
    + f"""SELECT date_trunc('day', ts) AS t, m_event_type AS event_type, count(*) AS n, round(sum(value), 2) AS total, max(value) AS largest
FROM cls WHERE {O.PROCESSED} GROUP BY 1, 2""",
)
def q_rollup_submitted_spec(spark, sf_dir):
    """The flagship from a submitted JSON spec: its own aggregators, and bounds
    written with an offset (02:00+02:00 is midnight UTC)."""
    spec = IngestSpec.from_json(SUBMITTED)
    return rollup(_rows(spark, sf_dir, spec), spec).select("t", "event_type", "n", r2("total"), "largest")


SUBMITTED = {
    "dataSchema": {
        "dataSource": "events",
        "parser": {"parseSpec": {"timestampSpec": {"column": "ts", "format": "auto"}, "dimensionsSpec": {"dimensions": ["event_type"]}}},
        "metricsSpec": [
            {"type": "count", "name": "n"},
            {"type": "doubleSum", "name": "total", "fieldName": "value"},
            {"type": "doubleMax", "name": "largest", "fieldName": "value"},
        ],
        "granularitySpec": {"segmentGranularity": "DAY", "queryGranularity": "DAY"},
    },
    "ioConfig": {
        "topic": "events",
        "minimumMessageTime": "2024-01-05T02:00:00+02:00",
        "maximumMessageTime": "2024-01-25T02:00:00+02:00",
    },
}


@register(
    "late_watermark",
    O.BASE_CLS
    + f"""SELECT date_trunc('day', ts) AS t, m_event_type AS event_type, count(*) AS rows
FROM cls WHERE {O.PROCESSED}
  AND date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM cls WHERE {O.PROCESSED}) - INTERVAL 10 DAY
GROUP BY 1, 2""",
)
def q_late_watermark(spark, sf_dir):
    """Append mode with a P10D watermark: only windows the watermark has passed."""
    spec = events_spec()
    paths = _stream(spark, sf_dir, "late-watermark", spec)
    out = f"{paths.table}_rollup"
    q = start_rollup(
        spark, spec, paths.table, out, f"{paths.checkpoint}_rollup", "1 day", ["event_type"], "10 days", "append"
    )
    q.awaitTermination()
    return spark.read.parquet(out).select("t", "event_type", "rows")


# ---------------------------------------------------------------- jobs over landing folders

CUT = "2024-01-15T00:00:00.000000Z"


@register(
    "batch_growing_landing",
    O.with_ctes(O.FX, O.TXT, O.ENV, O.cls())
    + """SELECT messageId, disposition, reason, acks FROM cls JOIN (SELECT messageId, count(*) AS acks FROM env GROUP BY 1) USING (messageId)""",
)
def q_batch_growing_landing(spark, sf_dir):
    """Two batch jobs, the landing folder growing in between: every message is
    stored once and every copy acknowledged."""
    spec, paths, env = events_spec(), _table(spark, "growing"), fx.envelopes(spark, sf_dir)
    for part in (env.filter(_publish_before(CUT)), env.filter(~_publish_before(CUT))):
        L.land_envelopes(part, paths.landing)
        ingest_landing(spark, spec, paths)
    acks = S.read_ledger(spark, paths.ledger).groupBy("messageId").agg(F.count(F.lit(1)).alias("acks"))
    return S.read_rows(spark, paths.table, spec).join(acks, "messageId").select("messageId", "disposition", "reason", "acks")


@register(
    "bounded_admission",
    O.BASE_ENV + "SELECT count(*) AS messages, CAST(0 AS BIGINT) AS polls_over, CAST(0 AS BIGINT) AS commits_short, CAST(0 AS BIGINT) AS commits_over FROM env",
)
def q_bounded_admission(spark, sf_dir):
    """Polls of at most 100 messages and 8 KiB of file, commits from 250 rows on:
    what the commit records say was taken."""
    spec = events_spec(max_messages_per_poll=100, max_message_size_per_poll=8192).with_tuning(max_total_rows=_scaled(spark, sf_dir, 250))
    paths = _table(spark, "admission")
    L.land_envelopes(fx.envelopes(spark, sf_dir).repartition(3), paths.landing)
    done = ingest_landing(spark, spec, paths)
    record = spark.read.schema(POLLS).json(f"{paths.table}/_commits").select(F.posexplode("polls").alias("at", "poll"), F.input_file_name().alias("commit"))
    sums = record.select("commit", "at", *[F.aggregate(F.col(f"poll.{c}"), F.lit(0).cast("bigint"), lambda a, x: a + x).alias(c) for c in ("messages", "bytes", "rows")])
    over = (F.col("messages") > 100) | ((F.col("bytes") > 8192) & (F.col("messages") > 1))
    by_commit = sums.groupBy("commit").agg(F.sum("messages").alias("messages"), F.count_if(over).alias("over"), F.sum("rows").alias("rows"))
    limit, last = spec.tuning.max_total_rows, f"%/{max(done)}.json"
    short = (F.col("rows") < limit) & ~F.col("commit").like(last)
    return by_commit.agg(
        F.sum("messages").cast("bigint").alias("messages"),
        F.sum("over").cast("bigint").alias("polls_over"),
        F.count_if(short).cast("bigint").alias("commits_short"),
        F.count_if(F.col("rows") >= limit + 100).cast("bigint").alias("commits_over"),
    )


def _scaled(spark, sf_dir: str, least: int) -> int:
    """A bound of rows that cuts the table into about five commits at any size."""
    return max(least, fx.read_events(spark, sf_dir).count() // 4)


@register(
    "batch_clock",
    O.base_cls([
        (f"publishTime < '{cut}' AND publishTime >= '{lo}' AND (ts < TIMESTAMP '{at}' - INTERVAL 5 DAY)", "too_late")
        for lo, cut, at in (("0", "2024-01-11T", "2024-01-11 00:00:00"), ("2024-01-11T", "2024-01-21T", "2024-01-21 00:00:00"), ("2024-01-21T", "9", "2024-02-01 00:00:00"))
    ])
    + "SELECT messageId, disposition, reason FROM cls",
)
def q_batch_clock(spark, sf_dir):
    """Three batches at three times, rows older than five days thrown away; the
    second is replayed at a later time and keeps its dispositions."""
    spec = events_spec(minimum_message_time=None, maximum_message_time=None, batch_clock=True, late_message_rejection_period=timedelta(days=5))
    paths, env = _table(spark, "clock"), fx.envelopes(spark, sf_dir)
    cuts = [("0", "2024-01-11T"), ("2024-01-11T", "2024-01-21T"), ("2024-01-21T", "9")]
    clocks = [datetime(2024, 1, 11), datetime(2024, 1, 21), datetime(2024, 2, 1)]
    parts = _arrivals(spark, paths, env, [(F.col("publishTime") >= lo) & (F.col("publishTime") < hi) for lo, hi in cuts])
    for n, at in enumerate(clocks):
        process_batch(parts[n], n, spec, paths, clock=lambda at=at: at)
    S.delete_path(spark, S._marker(paths.table, 1))  # cut off before its commit
    process_batch(parts[1], 1, spec, paths, clock=lambda: datetime(2024, 3, 1))
    return S.read_rows(spark, paths.table, spec).select("messageId", "disposition", "reason")


@register(
    "multi_source_stream",
    O.BASE_CLS
    + """SELECT 'sub-a' AS subscription, messageId, disposition FROM cls WHERE e % 10 < 6
UNION ALL SELECT 'sub-b', messageId, disposition FROM cls WHERE e % 10 >= 4""",
)
def q_multi_source_stream(spark, sf_dir):
    """One stream over two subscriptions; two in ten ids come from both."""
    spec, paths = events_spec(), _table(spark, "multi-stream")
    env = fx.envelopes(spark, sf_dir, keep_event_id=True)
    folders = {name: f"{paths.landing}/{name}" for name in ("sub-a", "sub-b")}
    for name, keep in (("sub-a", F.col("event_id") % 10 < 6), ("sub-b", F.col("event_id") % 10 >= 4)):
        env.filter(keep).drop("event_id", "delivery").repartition(4).write.parquet(folders[name])
    q = start_ingest(spark, spec, paths, max_files_per_trigger=2, subscriptions=folders)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return S.read_rows(spark, paths.table, spec).select("subscription", "messageId", "disposition")


@register("job_failure_sample", REGISTRY["parse_failure_sample"].sql)
def q_job_failure_sample(spark, sf_dir):
    """The last 10 failures of a job of three batches, from its last record."""
    spec, paths, env = events_spec().with_tuning(max_saved_parse_exceptions=10), _table(spark, "job-failures"), fx.envelopes(spark, sf_dir)
    third = F.pmod(F.crc32(F.col("messageId").cast("binary")), F.lit(3))
    for batch in range(3):
        process_batch(env.filter(third == batch), batch, spec, paths)
    return read_last_failures(spark, paths.table)


@register("rollup_stream_crash", ROLLUP_SQL)
def q_rollup_stream_crash(spark, sf_dir):
    """A publish is cut off half way; rollup, replay, rollup: nothing doubles."""
    spec, paths, env = events_spec(), _table(spark, "rollup-crash"), fx.envelopes(spark, sf_dir)
    for batch, part in enumerate((env.filter(_publish_before(CUT)), env.filter(~_publish_before(CUT)))):
        process_batch(part, batch, spec, paths)
    # the state that a crash leaves on a store without atomic renames: every other file is still staged
    for name, _ in sorted(S.list_files(spark, f"{paths.table}/batch_id=1"))[::2]:
        fs, back = S._fs(spark, f"{S.staging_path(paths.table, 1)}/{name}")
        fs.mkdirs(back.getParent())
        fs.rename(S._fs(spark, f"{paths.table}/batch_id=1/{name}")[1], back)
    _streamed_rollup(spark, spec, paths)
    process_batch(env.filter(~_publish_before(CUT)), 1, spec, paths)
    return _rolled(_streamed_rollup(spark, spec, paths))


@register(
    "merge_segment_files",
    O.with_ctes(O.FX, O.TXT, O.ENV, O.cls())
    + """SELECT date_trunc('day', ts) AS segment_start, count(*) AS rows, CAST(ceil(count(*) / 100) AS BIGINT) AS files,
       (SELECT count(*) FROM env) AS acks, CAST(ceil((SELECT count(*) FROM cls WHERE disposition = 'processed') / 1) AS BIGINT) AS rolled
FROM cls WHERE disposition = 'processed' GROUP BY 1""",
)
def q_merge_segment_files(spark, sf_dir):
    """Six micro-batches and a last one without rows, rolled up as a stream
    before and after a merge: each segment has as few files as its rows fill."""
    spec, paths, env = events_spec().with_tuning(max_rows_per_segment=100), _table(spark, "merge"), fx.envelopes(spark, sf_dir)
    hour = F.pmod(F.crc32(F.col("messageId").cast("binary")), F.lit(6))
    for batch, part in enumerate(_arrivals(spark, paths, env, [hour == batch for batch in range(6)])):
        process_batch(part, batch, spec, paths)
    process_batch(env.filter(F.lit(False)), 6, spec, paths)
    out, checkpoint = f"{paths.table}_rollup", f"{paths.checkpoint}_rollup"
    drain_rollup(spark, spec, paths.table, out, checkpoint, None, ["event_type"], "31 days")
    merge_segments(spark, paths.table, spec)
    merge_ledger(spark, paths.ledger, paths.table)
    drain_rollup(spark, spec, paths.table, out, checkpoint, None, ["event_type"], "31 days")
    rolled = read_rollup_updates(spark, out, ["event_type"]).agg(F.sum("rows").cast("bigint").alias("rolled"))
    acks = S.read_ledger(spark, paths.ledger).agg(F.count(F.lit(1)).alias("acks"))
    return files_by_segment(S.read_segments(spark, paths.table, spec)).crossJoin(rolled).crossJoin(acks)  # one row each


@register(
    "rollup_late_rows",
    O.BASE_CLS
    + f"""SELECT date_trunc('day', ts) AS t, m_event_type AS event_type, count(*) FILTER (WHERE NOT late) AS rows, count(*) FILTER (WHERE late) AS late_rows
FROM (SELECT *, publishTime < '{CUT}' AND date_trunc('day', ts) + INTERVAL 1 DAY <= mark AS late
      FROM cls, (SELECT max(ts) - INTERVAL 15 DAY AS mark FROM cls WHERE {O.PROCESSED} AND publishTime >= '{CUT}') WHERE {O.PROCESSED}) GROUP BY 1, 2""",
)
def q_rollup_late_rows(spark, sf_dir):
    """The newer half comes first: older rows whose day is over by the watermark
    are kept as late rows; rolled and late rows are all processed rows."""
    spec, paths, env = events_spec(), _table(spark, "late-rows"), fx.envelopes(spark, sf_dir)
    out = f"{paths.table}_rollup"
    for batch, part in enumerate((env.filter(~_publish_before(CUT)), env.filter(_publish_before(CUT)))):
        process_batch(part, batch, spec, paths)
        start_rollup_log(spark, spec, paths.table, out, f"{paths.checkpoint}_rollup", "15 days", ["event_type"]).awaitTermination()
    rolled = read_rollup_log(spark, out, spec, ["event_type"]).select("t", "event_type", F.col("rows").cast("bigint").alias("rows"), F.lit(0).cast("bigint").alias("late_rows"))
    late = rolled.limit(0)
    if S.path_exists(spark, f"{out}_late"):
        kept = with_query_time(spark.read.parquet(f"{out}_late"), "day")
        late = kept.groupBy("t", "event_type").agg(F.lit(0).cast("bigint").alias("rows"), F.count(F.lit(1)).alias("late_rows"))
    both = rolled.unionByName(late).groupBy("t", "event_type")
    return both.agg(F.sum("rows").cast("bigint").alias("rows"), F.sum("late_rows").cast("bigint").alias("late_rows"))


@register("dedup_stream", O.BASE + "SELECT messageId, publishTime FROM txt")
def q_dedup_stream(spark, sf_dir):
    """Dedup in the state store over landed files, copies in other micro-batches."""
    paths = _table(spark, "dedup-stream")
    _land(spark, sf_dir, paths)
    src = dedup_stream(L.stream_envelopes(spark, paths.landing, max_files_per_trigger=2), "60 days")
    q = src.writeStream.format("parquet").option("path", paths.table).option("checkpointLocation", paths.checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(paths.table).select("messageId", "publishTime")


@register(
    "parse_failure_limit",
    O.with_ctes(O.FX, O.TXT, O.ENV, O.cls())
    + f"""SELECT (SELECT count(*) FROM cls WHERE publishTime < '{CUT}') AS rows, (SELECT count(*) FROM env WHERE publishTime < '{CUT}') AS acks, true AS refused""",
)
def q_parse_failure_limit(spark, sf_dir):
    """As many failures allowed as the first half holds: the second half passes the
    limit, and nothing of it is in the table or the ledger."""
    env = fx.envelopes(spark, sf_dir)
    halves = env.filter(_publish_before(CUT)), env.filter(~_publish_before(CUT))
    allowed = M.failures(ingest(halves[0], events_spec()).rows).count()
    spec, paths, refused = events_spec().with_tuning(max_parse_exceptions=allowed), _table(spark, "limit"), False
    process_batch(halves[0], 0, spec, paths)
    try:
        process_batch(halves[1], 1, spec, paths)
    except M.ParseFailureLimitExceeded:
        refused = True
    rows = S.read_rows(spark, paths.table, spec).agg(F.count(F.lit(1)).alias("rows"))
    acks = S.read_ledger(spark, paths.ledger).agg(F.count(F.lit(1)).alias("acks"))
    return rows.crossJoin(acks).withColumn("refused", F.lit(refused))  # one row each


# ---------------------------------------------------------------- public


def queries() -> dict[str, QueryFn]:
    return {name: q.fn for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}


def headline() -> dict[str, QueryFn]:
    return {name: q.fn for name, q in REGISTRY.items() if q.headline}
