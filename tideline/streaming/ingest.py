"""Ingest of landing folders as batch jobs or a stream, then the rollup.

Query 1 (``start_ingest``: a stream with admission control, ``foreachBatch``;
``ingest_landing``: batch jobs over what is new) does per batch

1. one narrow pass over ids and publish times: how many messages came, a digest
   of them, and the bound of the dedup;
2. dedup inside the batch (partial ``min_by``) and against messages acked by
   earlier batches within ``dedup_horizon`` of publish time (anti-join on the
   ledger, pruned by publish time; replay-safe: only ``batch_id < N``);
3. decode .. classify (one narrow stage);
4. one write of the rows to the hidden staging folder of ``batch_id = N``, which
   observes the meters as it goes;
5. the failure limit: over it the staging folder is dropped and nothing is
   published or acknowledged;
6. the commit record with the batch's input, meters and the last failures of the
   job, then the publish.  The number of a committed batch cannot be used for
   other messages; the same messages again leave the rows as they are;
7. the ledger of *all* received copies, after the commit, and a mark that it is
   written;
8. the meters row (and the last ``maxSavedParseExceptions`` failures).

Query 2 (``start_rollup``): ``readStream`` of the processed rows, event-time
watermark, tumbling ``window`` aggregation.  Two queries because the dedup
and the rollup need watermarks on different columns.
"""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.operators.dedup import dedup_messages
from tideline.operators.ledger import ack_ledger
from tideline.operators.meters import ParseFailureLimitExceeded, check_failure_limit, failure_sample, failures, last_failures, last_of, meter_columns
from tideline.functions.timefns import bucket_end, truncate
from tideline.operators.rollup import merge_aggs, rollup_aggs
from tideline.operators.rows import PROCESSED, UNPARSEABLE, rows_from_envelopes
from tideline.sinks.merge import register_rollup, rollup_drained
from tideline.sinks.segments import (
    TOGETHER,
    delete_path,
    discard_staged,
    committed,
    commit_ids,
    finish_publish,
    finish_publishes,
    list_files,
    path_exists,
    publish_staged,
    read_batch,
    read_generation,
    read_ledger,
    read_staged,
    read_text,
    read_together,
    rows_schema,
    split_staged,
    stage_batches,
    stage_rows,
    staging_path,
    write_ledger,
    write_record,
    write_text,
)
from tideline.sources import manifest
from tideline.sources.landing import stream_envelopes, stream_pull_responses, union_subscriptions
from tideline.sources.manifest import Landing
from tideline.spec import FIXED_GRANULARITIES, IngestSpec, SpecError

#: Granularities that a tumbling window gives, as it counts from the epoch.
WINDOW_OF = {g: f"1 {g}" for g in ("second", "minute", "hour", "day")} | {g: f"{s} seconds" for g, s in FIXED_GRANULARITIES.items()}

LOG = logging.getLogger("tideline.ingest")


@dataclass
class StreamPaths:
    landing: str
    table: str
    ledger: str
    meters: str
    checkpoint: str


def _prior_messages(spark: SparkSession, ledger: str, batch_id: int, lo: str | None) -> DataFrame:
    """Messages acked by earlier batches within the dedup horizon, read from the
    folders of the publish days in it; those without a publish time are always
    compared."""
    prior = read_ledger(spark, ledger, None if lo is None else date.fromisoformat(lo[:10]), before=batch_id)
    if lo is not None:
        prior = prior.filter((F.col("publishTime") >= F.lit(lo)) | F.col("publishTime").isNull())
    return prior.select("messageId", "subscription")


class StagingError(RuntimeError):
    """The rows of several commits could not be written together."""


class BatchIdentityError(RuntimeError):
    """The number of a committed batch was used for other messages."""


@dataclass(frozen=True)
class _Input:
    """What came: messages and a digest of them, and how far back to dedup."""

    messages: int
    digest: list[int]
    since: str | None


def _received(env: DataFrame, spec: IngestSpec) -> _Input:
    """One pass over ids and publish times (Parquet prunes the payload).  The
    digest does not depend on the order of messages; the bound is formatted by
    Spark, in the session's UTC."""
    got = env.agg(*_input_columns(env, spec)).first()
    return _Input(got["n"], [got["x"], got["s"]], got["since"])


def _input_columns(env: DataFrame, spec: IngestSpec) -> list[Column]:
    label = ["subscription"] if "subscription" in env.columns else []
    h = F.xxhash64("ackId", "messageId", "publishTime", *label)
    lo = F.min(F.try_to_timestamp("publishTime")) - F.expr(f"INTERVAL '{spec.tuning.dedup_horizon.total_seconds():f}' SECOND")
    return [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bit_xor(h), F.lit(0)).alias("x"),
        F.coalesce(F.sum(F.pmod(h, F.lit(1 << 31))), F.lit(0)).alias("s"),
        F.date_format(lo, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("since"),
    ]


def process_batch(env: DataFrame, batch_id: int, spec: IngestSpec, paths: StreamPaths, polls: list | None = None, clock=None) -> dict:
    """One micro-batch (or one batch job) of query 1; returns its meters.

    Nothing is persisted.  ``polls`` (the slices of landed files that ``env`` was
    read from) goes into the commit record; ``clock`` gives the reference time of
    late and early rejection where the spec leaves it to the batch.  A number that
    is committed already takes only the messages it was committed with
    (``BatchIdentityError`` otherwise, and nothing is acknowledged).
    """
    spark, came = env.sparkSession, _received(env, spec)
    done = committed(spark, paths.table, batch_id)
    if done:
        if done.get("input", {"messages": came.messages, "digest": came.digest}) != {"messages": came.messages, "digest": came.digest}:
            raise BatchIdentityError(f"batch {batch_id} of {paths.table} is committed with other messages")
        finish_publish(spark, paths.table, batch_id)
        meters = done["meters"]
    else:
        meters = _commit_rows(env, batch_id, batch_spec(spark, spec, paths.table, batch_id, clock), paths, came, polls)
    if not done or not path_exists(spark, _acked(paths, batch_id)):
        _report_failures(spark, batch_id, spec, paths, meters)
        # acknowledge only after the data commit
        write_ledger(ack_ledger(env, batch_id), paths.ledger)
        write_text(spark, _acked(paths, batch_id), "")
    # one small record per batch, through the file system (no Spark job)
    record = {"data_source": spec.data_source, **meters}
    write_text(spark, f"{paths.meters}/batch_id={int(batch_id)}/meters.json", json.dumps(record))
    return meters


def _report_failures(spark: SparkSession, batch_id: int, spec: IngestSpec, paths: StreamPaths, meters: dict) -> None:
    """Log the failures of a committed batch and keep its last ones, as the spec asks."""
    saved = spec.tuning.saved_parse_exceptions
    if meters["unparseable"] == 0 or not (spec.tuning.log_parse_exceptions or saved > 0):
        return
    failed = read_batch(spark, paths.table, spec, batch_id).filter(F.col("disposition") == UNPARSEABLE)
    if spec.tuning.log_parse_exceptions:
        for reason, n in failed.groupBy("reason").count().collect():  # one row for each reason
            LOG.warning("%s batch %d: %d unparseable rows, %s", spec.data_source, batch_id, n, reason)
    if saved > 0:
        failure_sample(failed, saved).withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")).write.mode(
            "overwrite"
        ).option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(paths.meters + "_failures")


def _acked(paths: StreamPaths, batch_id: int) -> str:
    """The mark that a batch's ledger is written."""
    return f"{paths.table}/_acked/{int(batch_id)}"


def batch_spec(spark: SparkSession, spec: IngestSpec, table: str, batch_id: int, clock=None) -> IngestSpec:
    """The spec with the reference time of a batch.

    Where the spec says ``"referenceTime": "batch"``, the time is taken when the
    batch is first tried and recorded before it runs, so that a replay classifies
    every row as the first try did.
    """
    if not spec.io_config.batch_clock:
        return spec
    path = f"{table}/_clock/{int(batch_id)}.json"
    text = read_text(spark, path)
    if text is None:
        now = clock() if clock else datetime.now(timezone.utc).replace(tzinfo=None)
        write_record(spark, path, {"reference_time": now.isoformat()})
    else:
        now = datetime.fromisoformat(json.loads(text)["reference_time"])
    return spec.with_io(reference_time=now, batch_clock=False)


def _commit_rows(env: DataFrame, batch_id: int, spec: IngestSpec, paths: StreamPaths, came: _Input, polls: list | None) -> dict:
    """Stage, check and publish the rows of a batch that is not committed yet.

    The failure limit and the last failures are those of the whole job: the
    record of the batch before has what came until then.
    """
    spark = env.sparkSession
    unique = dedup_messages(env, keep_key=True)
    if path_exists(spark, paths.ledger):
        # joined by the key of the dedup, which is the id where there is one: no second shuffle
        u, p = unique.alias("u"), _prior_messages(spark, paths.ledger, batch_id, came.since).alias("p")
        same = (F.col("u._key") == F.col("p.messageId")) & F.col("u.messageId").isNotNull()
        if "subscription" in unique.columns:
            same &= F.col("u.subscription").eqNullSafe(F.col("p.subscription"))
        unique = u.join(p, same, "left_anti")
    rows = rows_from_envelopes(unique, spec, batch_id)
    seen = stage_rows(rows, paths.table, spec, batch_id, meter_columns(), came.messages)
    meters = _meters(seen)
    before = last_record(spark, paths.table, batch_id)
    failed = (before["failures_so_far"] if before else 0) + meters["unparseable"]
    try:
        check_failure_limit(failed, spec)
    except Exception:
        discard_staged(spark, paths.table, batch_id)  # nothing of this batch is published
        raise
    saved = spec.tuning.saved_parse_exceptions
    own = last_failures(read_staged(spark, paths.table, spec, batch_id), saved) if saved > 0 and meters["unparseable"] else []
    publish_staged(spark, paths.table, spec, batch_id, _record(spec, meters, came, before, own, polls))
    return meters


def _meters(seen: dict) -> dict:
    return {k: int(seen.get(k) or 0) for k in ("processed", "unparseable", "thrown_away")}


def _record(spec: IngestSpec, meters: dict, came: _Input, before: dict | None, own: list[dict], polls: list | None) -> dict:
    """The commit record of a batch after the record ``before`` it."""
    failed = (before["failures_so_far"] if before else 0) + meters["unparseable"]
    record = {"meters": meters, "failures_so_far": failed, "input": {"messages": came.messages, "digest": came.digest}}
    saved = spec.tuning.saved_parse_exceptions
    if saved > 0:
        record["last_failures"] = last_of([*(before or {}).get("last_failures", []), *own], saved)
    if spec.io_config.reference_time is not None:
        record["reference_time"] = spec.io_config.reference_time.isoformat()
    if polls is not None:
        record["polls"] = manifest.as_record(polls)
    return record


# -- several commits in one pass --------------------------------------------------------


#: Commits of a batch job that one pass takes at most.
COMMITS_AT_ONCE = 256


def process_batches(spark: SparkSession, landing: Landing, numbered: dict[int, list], spec: IngestSpec, paths: StreamPaths) -> dict[int, dict]:
    """``process_batch`` for commits with consecutive new numbers (and the polls of
    each) in one pass: read, dedup, write and acknowledgement are one job for all,
    with the number of the commit as a column.

    Each commit is what it would be alone: its own dedup, against the earlier
    commits of the pass too, its record, meters and files; they are published in
    order, and the failure limit stops at the commit that passes it.
    """
    env = manifest.read_commits(spark, landing, numbered)
    found = {r["_batch"]: _Input(r["n"], [r["x"], r["s"]], r["since"]) for r in env.groupBy("_batch").agg(*_input_columns(env, spec)).collect()}
    came = {n: found.get(n, _Input(0, [0, 0], None)) for n in numbered}
    rows = rows_from_envelopes(_unseen(env, came, paths.ledger), spec, F.col("_batch"))
    try:
        seen = stage_batches(rows, paths.table, spec, sum(c.messages for c in came.values()), meter_columns())
    except PySparkException as e:
        delete_path(spark, f"{paths.table}/{TOGETHER}")
        raise StagingError(str(e)) from e
    own, saved = {}, spec.tuning.saved_parse_exceptions
    if saved > 0 and any(_meters(s)["unparseable"] for s in seen.values()):
        order = Window.partitionBy("batch_id").orderBy(F.col("publishTime").desc(), F.col("messageId").desc(), F.col("pos").desc())
        last = failures(read_together(spark, paths.table, spec)).select("batch_id", "messageId", "pos", "publishTime", "reason")
        for r in last.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= saved).drop("_place").collect():  # at most ``saved`` a batch
            own.setdefault(r["batch_id"], []).append({k: v for k, v in r.asDict().items() if k != "batch_id"})
    out, before, over = {}, last_record(spark, paths.table, min(numbered)), None
    for n, polls in sorted(numbered.items()):
        meters = _meters(seen.get(n, {}))
        record = _record(spec, meters, came[n], before, own.get(n, []), polls)
        try:
            check_failure_limit(record["failures_so_far"], spec)
        except ParseFailureLimitExceeded as e:
            over = e  # nothing of this commit and the later ones is published
            break
        split_staged(spark, paths.table, n)
        publish_staged(spark, paths.table, spec, n, record)
        out[n], before = meters, record
    delete_path(spark, f"{paths.table}/{TOGETHER}")
    if out:
        for n, meters in out.items():
            _report_failures(spark, n, spec, paths, meters)
        write_ledger(ack_ledger(env.filter(F.col("_batch") <= max(out)), F.col("_batch")), paths.ledger)
    for n, meters in out.items():
        write_text(spark, _acked(paths, n), "")
        write_text(spark, f"{paths.meters}/batch_id={n}/meters.json", json.dumps({"data_source": spec.data_source, **meters}))
    if over:
        raise over
    return out


def _unseen(env: DataFrame, came: dict[int, _Input], ledger: str) -> DataFrame:
    """One copy of each message of a commit that no earlier commit has acknowledged
    within the horizon of this one (``_prior_messages`` for many commits)."""
    spark, first = env.sparkSession, min(came)
    label = ["subscription"] if "subscription" in env.columns else []
    day = F.try_to_timestamp("publishTime").cast("date")
    # a commit has no copy of its own messages here, only those of the others count
    prior = env.filter(F.col("messageId").isNotNull()).select("messageId", *label, "publishTime", day.alias("publish_day"), F.col("_batch").alias("batch_id")).distinct()
    if path_exists(spark, ledger):
        bounds = [c.since for c in came.values() if c.messages]
        lo = None if None in bounds or not bounds else min(bounds)
        acked = read_ledger(spark, ledger, None if lo is None else date.fromisoformat(lo[:10]), before=first)
        if lo is not None:
            acked = acked.filter((F.col("publishTime") >= F.lit(lo)) | F.col("publishTime").isNull())
        prior = prior.unionByName(acked.select(*prior.columns))
    since = F.get(F.array(*[F.lit(came[n].since).cast("string") for n in range(first, max(came) + 1)]), (F.col("_batch") - first).cast("int"))
    unique = dedup_messages(env, ("_batch",), keep_key=True).withColumn("_since", since)
    u, p = unique.alias("u"), prior.alias("p")
    same = (F.col("u._key") == F.col("p.messageId")) & F.col("u.messageId").isNotNull() & (F.col("p.batch_id") < F.col("u._batch"))
    late = F.col("p.publishTime").isNull() | (F.col("p.publishTime") >= F.col("u._since"))
    dated = F.col("p.publish_day").isNull() | (F.col("p.publish_day") >= F.substring("u._since", 1, 10).cast("date"))
    same &= F.col("u._since").isNull() | (late & dated)
    if label:
        same &= F.col("u.subscription").eqNullSafe(F.col("p.subscription"))
    return u.join(p, same, "left_anti").drop("_key", "_since")


def _passes(spark: SparkSession, commits: list, first: int, spec: IngestSpec, table: str, clock=None):
    """(spec, commits by number) of the passes over new commits: as many at once as
    ``COMMITS_AT_ONCE``, all of one reference time, taken when the pass begins."""
    at = 0
    while at < len(commits):
        now: list[datetime] = []

        def once() -> datetime:
            if not now:
                now.append(clock() if clock else datetime.now(timezone.utc).replace(tzinfo=None))
            return now[0]

        own = batch_spec(spark, spec, table, first + at, once)
        end = at + 1
        while end < min(len(commits), at + COMMITS_AT_ONCE) and batch_spec(spark, spec, table, first + end, once) == own:
            end += 1
        yield own, {first + n: commits[n] for n in range(at, end)}
        at = end


def last_record(spark: SparkSession, table: str, batch_id: int | None = None) -> dict | None:
    """The commit record before ``batch_id`` (the last one of all)."""
    if batch_id is not None and batch_id > 0 and (found := committed(spark, table, batch_id - 1)):
        return found
    earlier = [n for n in commit_ids(spark, table) if batch_id is None or n < batch_id]
    return committed(spark, table, earlier[-1]) if earlier else None


def read_last_failures(spark: SparkSession, table: str) -> DataFrame:
    """The last ``maxSavedParseExceptions`` failures of the whole job."""
    kept = (last_record(spark, table) or {}).get("last_failures", [])
    rows = [(r["messageId"], r["pos"], r["publishTime"], r["reason"]) for r in kept]
    return spark.createDataFrame(rows, "messageId string, pos int, publishTime string, reason string")


def ingest_landing(spark: SparkSession, spec: IngestSpec, paths: StreamPaths, landing: Landing | None = None, clock=None) -> dict[int, dict]:
    """Batch jobs over what is new in the landing folders; meters by batch number.

    What committed batches took is in their records.  The rest is cut into polls
    and commits (``sources/manifest.py``), each committed under the next number,
    so running the job again over a landing that has grown takes just what came
    since.  Many commits run in one pass (``process_batches``); if rows cannot be
    staged, they run one by one, up to the one that fails.  A batch that was committed but not acknowledged, because the job was
    cut off in between, is acknowledged first, from the files in its record.
    """
    if spec.suspended:
        return {}
    landing = landing or Landing({None: paths.landing})
    finish_publishes(spark, paths.table)
    done = commit_ids(spark, paths.table)
    acked = {name for name, _ in list_files(spark, f"{paths.table}/_acked")}
    for number in (n for n in done if str(n) not in acked):
        record = committed(spark, paths.table, number)
        if record.get("polls"):
            process_batch(manifest.read_polls(spark, landing, manifest.from_record(record["polls"])), number, spec, paths)
    out, number = {}, done[-1] + 1 if done else 0
    slices = manifest.new_slices(spark, landing, paths.table, spec)
    cut = manifest.commits(manifest.polls(slices, spec, landing.splits), spec)
    for own, numbered in _passes(spark, cut, number, spec, paths.table, clock):
        done = {}
        if len(numbered) > 1:
            try:
                done = process_batches(spark, landing, numbered, own, paths)
            except StagingError as e:
                LOG.warning("%s: commits %d to %d run one by one: %s", spec.data_source, min(numbered), max(numbered), e)
        for n in (n for n in numbered if n not in done):
            done[n] = process_batch(manifest.read_polls(spark, landing, numbered[n]), n, own, paths, numbered[n])
        out |= done
    return out


METERS_SCHEMA = "data_source string, processed bigint, unparseable bigint, thrown_away bigint, batch_id bigint"


def read_meters(spark: SparkSession, path: str) -> DataFrame:
    """Per-batch meters of a running ingest (one row per committed batch)."""
    return spark.read.schema(METERS_SCHEMA).json(path)


def start_ingest(
    spark: SparkSession,
    spec: IngestSpec,
    paths: StreamPaths,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    available_now: bool = True,
    source: str = "envelopes",
    multi_line: bool = False,
    subscriptions: dict[str, str] | None = None,
    clock=None,
) -> StreamingQuery | None:
    """Start query 1.  A suspended spec starts nothing.

    ``source="pulls"`` reads raw pull-response JSON files (with ``multi_line`` one
    response or array of them a file) from the landing folder instead of flat
    envelopes.  ``subscriptions`` (label -> landing folder) feeds one table from
    several: one query over the union of their file streams, each with its own
    offsets and admission, every row and ack labelled.

    The file source takes one bound, files or bytes; a spec that bounds polls by
    messages and by bytes is refused here and runs with ``ingest_landing``, which
    keeps both.
    """
    if spec.suspended:
        return None
    io = spec.io_config
    if max_files_per_trigger is None and max_bytes_per_trigger is None and io.max_messages_per_poll > 0 and io.max_message_size_per_poll > 0:
        raise SpecError("a stream takes maxMessagesPerPoll or maxMessageSizePerPoll; ingest_landing takes both")
    if max_files_per_trigger is None and max_bytes_per_trigger is None and io.max_messages_per_poll > 0:
        # landing files hold <= maxMessagesPerPoll messages (one poll each); a
        # commit takes polls until maxTotalRows is reached, as a push would
        max_files_per_trigger = max(1, spec.tuning.max_total_rows // io.max_messages_per_poll)
    if max_bytes_per_trigger is None and max_files_per_trigger is None and io.max_message_size_per_poll > 0:
        max_bytes_per_trigger = io.max_message_size_per_poll

    def stream(path: str) -> DataFrame:
        if source == "pulls":
            return stream_pull_responses(spark, path, max_files_per_trigger, max_bytes_per_trigger, multi_line)
        return stream_envelopes(spark, path, fmt, max_files_per_trigger, max_bytes_per_trigger)

    if subscriptions:
        src = union_subscriptions({name: stream(path) for name, path in subscriptions.items()})
    else:
        src = stream(paths.landing)
    writer = (
        src.writeStream.foreachBatch(lambda df, bid: process_batch(df, bid, spec, paths, clock=clock))
        .option("checkpointLocation", paths.checkpoint)
        .queryName(f"ingest_{spec.data_source}")
    )
    writer = writer.trigger(**trigger_for(spec, available_now))
    return writer.start()


def trigger_for(spec: IngestSpec, available_now: bool = True) -> dict:
    """``availableNow`` drains the landing folder and stops; otherwise publish
    at least every ``intermediateHandoffPeriod`` (processing-time trigger)."""
    if available_now:
        return {"availableNow": True}
    period = spec.tuning.intermediate_handoff_period
    secs = int(period.total_seconds()) if period else 60
    return {"processingTime": f"{secs} seconds"}


def rollup_stream(rows: DataFrame, spec: IngestSpec, window: str | None, dims, late: str) -> DataFrame:
    """Streaming rollup of processed rows with the buckets of the batch rollup.

    ``window`` is a width such as ``1 day``; without one, the spec's query
    granularity holds.  The watermark follows the event time.  Weeks, months,
    quarters and years have no window form that starts where ``truncate`` does;
    their bucket end is marked as a column of event time, as ``window`` marks its
    own, so a bucket is finished when the watermark reaches its end.
    """
    ev = rows.filter(F.col("disposition") == PROCESSED).withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", late)
    g = spec.data_schema.query_granularity
    window = window or WINDOW_OF.get(g)
    if window:
        buckets = ev.groupBy(F.window("event_time", window).alias("w"), *dims)
        start = F.col("w.start")
    else:
        start = truncate(F.col("event_time"), g)
        end = start if g == "none" else bucket_end(start, g)
        end = end.alias("_end", metadata=ev.schema["event_time"].metadata)
        buckets = ev.select("*", start.alias("_start"), end).drop("event_time").groupBy("_end", "_start", *dims)
        start = F.col("_start")
    rolled = buckets.agg(*rollup_aggs(spec.data_schema))
    names = [c for c in rolled.columns if c not in ("w", "_start", "_end", *dims)]
    return rolled.select(start.cast("timestamp_ntz").alias("t"), *dims, *names)


def start_rollup(
    spark: SparkSession,
    spec: IngestSpec,
    table: str,
    out: str,
    checkpoint: str,
    window: str | None = None,
    dims=None,
    late: str = "1 day",
    mode: str = "update",
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start query 2 over the rows table, once (``available_now``) or for good.

    ``update`` writes the groups changed by a batch under its ``batch_id`` and
    lets the watermark evict finished buckets from state (read with
    ``read_rollup_updates``); ``append`` emits a bucket once the watermark
    passes it; ``complete`` rewrites the rollup table each batch (state keeps
    every bucket).  A purge rewrites files that a rollup has counted, so a
    checkpoint from before it is refused: start again with a new one.
    """
    now, seen = read_generation(spark, table), read_text(spark, f"{checkpoint}_generation")
    if seen is None:
        write_text(spark, f"{checkpoint}_generation", str(now))
    elif int(seen) != now:
        raise SpecError(f"{table} was purged since {checkpoint} was started; use a new checkpoint and output")
    dims = list(spec.data_schema.dimensions if dims is None else dims)
    reader = spark.readStream.schema(rows_schema(spec))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    # files merged since this rollup began hold rows that it has read, or will read, elsewhere
    old = register_rollup(spark, table, checkpoint)
    rows = reader.parquet(table).filter(F.col("batch_id") >= -old)
    agg = rollup_stream(rows, spec, window, dims, late)

    def sink(df: DataFrame, bid: int) -> None:
        if mode == "complete":
            df.write.mode("overwrite").parquet(out)
        else:
            df.withColumn("batch_id", F.lit(bid).cast("bigint")).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("batch_id").parquet(out)

    return (
        agg.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_for(spec, available_now))
        .start()
    )


def drain_rollup(spark: SparkSession, spec: IngestSpec, table: str, out: str, checkpoint: str, *args, **kw) -> None:
    """Run query 2 over all that is committed and wait for it; the batches it has
    read may be merged from then on.  Arguments as for ``start_rollup``."""
    finish_publishes(spark, table)
    done = commit_ids(spark, table)
    q = start_rollup(spark, spec, table, out, checkpoint, *args, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    if done:
        rollup_drained(spark, table, checkpoint, done[-1])


def read_rollup_updates(spark: SparkSession, out: str, dims) -> DataFrame:
    """Current rollup from an ``update``-mode output: the latest version of each group.

    One partial aggregation keyed by the group; ``max_by`` over ``batch_id``
    picks the newest row, so the change log never has to be sorted.
    """
    changes = spark.read.parquet(out)
    keys = ["t", *dims]
    values = [c for c in changes.columns if c not in (*keys, "batch_id")]
    latest = F.max_by(F.struct(*values), F.col("batch_id")).alias("v")
    return changes.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"v.{c}").alias(c) for c in values])


# -- rollup with its late rows ----------------------------------------------------------


def start_rollup_log(
    spark: SparkSession,
    spec: IngestSpec,
    table: str,
    out: str,
    checkpoint: str,
    late: str = "1 day",
    dims=None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Query 2 as a log of partial rollups that keeps the rows it is too late for.

    Each micro-batch splits the processed rows by the watermark that the record of
    the micro-batch before has (newest event time - ``late``): rows whose bucket
    ended by then go to ``<out>_late`` as they are, the others are rolled up once
    and written to ``<out>`` under the number of the micro-batch.  A replay
    finds the same watermark and writes the same rows again in place of the first.
    No state is held in memory: the partial rollups of a bucket are merged on
    reading (``read_rollup_log``).
    """
    dims = list(spec.data_schema.dimensions if dims is None else dims)
    g = spec.data_schema.query_granularity
    reader = spark.readStream.schema(rows_schema(spec))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    old = register_rollup(spark, table, checkpoint)
    rows = reader.parquet(table).filter((F.col("batch_id") >= -old) & (F.col("disposition") == PROCESSED))

    def by_batch(df: DataFrame, path: str, bid: int) -> None:
        df.withColumn("batch_id", F.lit(bid).cast("bigint")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    def sink(df: DataFrame, bid: int) -> None:
        before = json.loads(read_text(spark, f"{out}_progress/{bid - 1}.json") or "{}") if bid else {}
        mark = before.get("watermark")
        event = F.col("ts").cast("timestamp")
        start = truncate(event, g)
        end = start if g == "none" else bucket_end(start, g)
        behind = F.lit(False) if mark is None else F.coalesce(end <= F.lit(mark).cast("timestamp"), F.lit(False))
        seen = df.agg(
            F.date_format(F.max(event) - F.expr(f"INTERVAL {late}"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("mark"),
            F.count_if(behind).alias("late"),
            F.count(F.lit(1)).alias("n"),
        ).first()
        rolled = df.filter(~behind).withColumn("t", start.cast("timestamp_ntz")).groupBy("t", *dims).agg(*rollup_aggs(spec.data_schema))
        by_batch(rolled, out, bid)
        if seen["late"]:
            by_batch(df.filter(behind).drop("batch_id", "from_batch"), f"{out}_late", bid)
        record = {"watermark": max(filter(None, [mark, seen["mark"]]), default=None), "late": seen["late"], "rows": seen["n"]}
        write_record(spark, f"{out}_progress/{bid}.json", record)

    return rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**trigger_for(spec, available_now)).start()


def read_rollup_log(spark: SparkSession, out: str, spec: IngestSpec, dims=None) -> DataFrame:
    """Current rollup from the partial ones: counts and sums are summed up, minima
    and maxima taken again (one partial aggregation by group)."""
    dims = list(spec.data_schema.dimensions if dims is None else dims)
    return spark.read.parquet(out).groupBy("t", *dims).agg(*merge_aggs(spec.data_schema))
