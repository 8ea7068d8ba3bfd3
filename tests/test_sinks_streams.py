"""Sinks, ledger, replay, limits, file bounds, purge, batch = stream."""

import os
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tideline.operators.meters import ParseFailureLimitExceeded
from tideline.plans.ingest import events_spec, ingest
from tideline.session import scratch_path
from tideline.sinks import segments as S
from tideline.sources import fixtures as fx
from tideline.spec import SpecError
from tideline.streaming.ingest import StreamPaths, process_batch, read_meters, start_ingest, trigger_for

SF = "/root/testdata/sf0.001"
TS = '"ts":"2024-01-10T00:00:00Z"'


def _paths(spark, name):
    root = scratch_path(spark, name)
    return StreamPaths(f"{root}/landing", f"{root}/rows", f"{root}/ledger", f"{root}/meters", f"{root}/ckpt")


def _snapshot(spark, paths, spec):
    return sorted(
        tuple(r) for r in S.read_rows(spark, paths.table, spec).select("messageId", "pos", "disposition", "batch_id").collect()
    )


def test_same_message_in_two_batches(spark, envelopes):
    spec = events_spec(minimum_message_time=None, maximum_message_time=None)
    paths = _paths(spark, "two-batches")
    data = "{" + TS + ',"value":1}'
    process_batch(envelopes([{"ackId": "a1", "messageId": "m", "data": data}]), 0, spec, paths)
    process_batch(envelopes([{"ackId": "a2", "messageId": "m", "data": data}]), 1, spec, paths)
    assert [r["messageId"] for r in S.read_rows(spark, paths.table, spec).collect()] == ["m"]
    assert sorted(r["ackId"] for r in S.read_ledger(spark, paths.ledger).collect()) == ["a1", "a2"]


def test_replayed_batch_leaves_table_unchanged(spark):
    spec = events_spec()
    paths = _paths(spark, "replay")
    env = fx.envelopes(spark, SF)
    process_batch(env, 0, spec, paths)
    before = _snapshot(spark, paths, spec)
    process_batch(env, 0, spec, paths)
    assert _snapshot(spark, paths, spec) == before


def test_failure_limit_fails_before_write(spark):
    spec = events_spec().with_tuning(max_parse_exceptions=3)
    paths = _paths(spark, "limit")
    with pytest.raises(ParseFailureLimitExceeded):
        process_batch(fx.envelopes(spark, SF), 0, spec, paths)
    assert not [d for d in S.list_dirs(spark, paths.table) if d.startswith("batch_id=")]  # nothing published
    assert not S.path_exists(spark, S.staging_path(paths.table, 0))  # staging discarded
    assert not S.path_exists(spark, paths.ledger)  # nothing acknowledged
    strict = events_spec().with_tuning(report_parse_exceptions=True)
    with pytest.raises(ParseFailureLimitExceeded):
        process_batch(fx.envelopes(spark, SF), 0, strict, _paths(spark, "limit2"))


def test_max_rows_per_segment_bounds_files(spark):
    spec = events_spec().with_tuning(max_rows_per_segment=10)
    paths = _paths(spark, "bounded")
    process_batch(fx.envelopes(spark, SF), 0, spec, paths)
    per_file = S.read_rows(spark, paths.table, spec).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in per_file) <= 10
    unbounded = _paths(spark, "unbounded")
    process_batch(fx.envelopes(spark, SF), 0, events_spec(), unbounded)
    assert _snapshot(spark, paths, spec) == _snapshot(spark, unbounded, spec)


def test_metadata_mismatch_refused(spark):
    spec = events_spec()
    paths = _paths(spark, "mismatch")
    env = fx.envelopes(spark, SF)
    process_batch(env, 0, spec, paths)
    other = spec.with_schema(fields=spec.data_schema.fields[:-2])
    with pytest.raises(SpecError):
        process_batch(env, 1, other, paths)


def test_purge_and_partition_pruning(spark):
    spec = events_spec()
    paths = _paths(spark, "purge")
    process_batch(fx.envelopes(spark, SF), 0, spec, paths)
    S.purge_interval(spark, paths.table, spec, datetime(2024, 1, 10, 12), datetime(2024, 1, 15))
    left = S.read_segments(spark, paths.table, spec)
    assert left.filter((F.col("ts") >= "2024-01-10 12:00:00") & (F.col("ts") < "2024-01-15")).isEmpty()
    assert not left.filter(F.col("ts") < "2024-01-10 12:00:00").isEmpty()
    pruned = S.read_segments(spark, paths.table, spec, datetime(2024, 1, 20), datetime(2024, 1, 21))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(segment_start" in plan or "PartitionFilters: [" in plan
    assert "PartitionFilters: []" not in plan
    assert pruned.count() > 0


def test_batch_equals_stream(spark):
    spec = events_spec()
    batch = _paths(spark, "as-batch")
    process_batch(fx.envelopes(spark, SF), 0, spec, batch)
    stream = _paths(spark, "as-stream")
    fx.envelopes(spark, SF).repartition(6).write.parquet(stream.landing)
    q = start_ingest(spark, spec, stream, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    cols = ["messageId", "pos", "disposition", "reason", "ts", "value"]
    b = S.read_rows(spark, batch.table, spec).select(cols)
    s = S.read_rows(spark, stream.table, spec).select(cols)
    assert b.exceptAll(s).isEmpty() and s.exceptAll(b).isEmpty()
    # one file per trigger: several micro-batches, and the meters add up
    m = read_meters(spark, stream.meters)
    assert m.count() >= 2
    tot = m.agg(*[F.sum(c).alias(c) for c in ("processed", "unparseable", "thrown_away")]).first()
    assert sum(tot) == s.count()
    # every received copy is in the ledger
    assert S.read_ledger(spark, stream.ledger).count() == fx.envelopes(spark, SF).count()


def test_suspended_stream_starts_nothing(spark):
    spec = replace(events_spec(), suspended=True)
    assert start_ingest(spark, spec, _paths(spark, "suspended")) is None


def test_periodic_publish_trigger():
    spec = events_spec().with_tuning(intermediate_handoff_period=timedelta(minutes=10))
    assert trigger_for(spec, available_now=False) == {"processingTime": "600 seconds"}
    assert trigger_for(spec) == {"availableNow": True}


def test_stream_dedup_within_watermark(spark):
    from tideline.operators.dedup import dedup_stream
    from tideline.sources.landing import stream_envelopes

    paths = _paths(spark, "stream-dedup")
    fx.envelopes(spark, SF).repartition(4).write.parquet(paths.landing)
    out = paths.table
    q = (
        dedup_stream(stream_envelopes(spark, paths.landing, max_files_per_trigger=1), "60 days")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", paths.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == got.select("messageId").distinct().count() == spark.read.parquet(f"{SF}/events.parquet").count()


def test_stream_pull_responses_equal_batch(spark):
    from tideline.sources.landing import read_pull_responses, stream_pull_responses

    paths = _paths(spark, "stream-pulls")
    pulls = fx.pull_responses(fx.envelopes(spark, SF, keep_event_id=True))
    pulls.select(F.to_json(F.struct("receivedMessages")).alias("value")).repartition(3).write.text(paths.landing)
    q = (
        stream_pull_responses(spark, paths.landing, max_files_per_trigger=1)
        .writeStream.format("parquet")
        .option("path", paths.table)
        .option("checkpointLocation", paths.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    s = spark.read.parquet(paths.table).select("ackId", "messageId", "data")
    b = read_pull_responses(spark, paths.landing).select("ackId", "messageId", "data")
    assert s.exceptAll(b).isEmpty() and b.exceptAll(s).isEmpty()
    assert b.count() == fx.envelopes(spark, SF).count()


def test_poll_limits_bound_micro_batches(spark):
    from tideline.sources.landing import land_envelopes

    # polls of <= 200 messages, commits of <= 400 rows: two landing files per trigger
    spec = events_spec().with_io(max_messages_per_poll=200).with_tuning(max_total_rows=400)
    paths = _paths(spark, "poll-limit")
    env = fx.envelopes(spark, SF)
    land_envelopes(env.repartition(1), paths.landing, spec.io_config.max_messages_per_poll)
    q = start_ingest(spark, spec, paths)
    q.awaitTermination()
    ledger = S.read_ledger(spark, paths.ledger)
    per_batch = [r["count"] for r in ledger.groupBy("batch_id").count().collect()]
    assert max(per_batch) <= 400 and sum(per_batch) == env.count()
    assert len(per_batch) >= 3
    assert spec.landing_path("/shared") == "/shared/fixtures/events-sub"


def test_saved_parse_failures_per_batch(spark):
    spec = events_spec().with_tuning(max_saved_parse_exceptions=5)
    paths = _paths(spark, "saved-failures")
    process_batch(fx.envelopes(spark, SF), 3, spec, paths)
    saved = spark.read.parquet(paths.meters + "_failures").collect()
    assert len(saved) == 5 and {r["batch_id"] for r in saved} == {3}
    everything = S.read_rows(spark, paths.table, spec).filter(F.col("disposition") == "unparseable")
    top = sorted((r["publishTime"], r["messageId"]) for r in everything.collect())[-5:]
    assert sorted((r["publishTime"], r["messageId"]) for r in saved) == top


def test_hot_message_and_hot_segment(spark, envelopes):
    """One message delivered 3000 times and one segment holding most rows."""
    from tideline.sources.schema import ENVELOPE

    data = "{" + TS + ',"value":1}'
    hot = [(f"a{i}", "hot", "2024-01-10T00:00:00.000000Z", data, None) for i in range(3000)]
    cold = [(f"b{i}", f"c{i}", "2024-01-10T00:00:00.000000Z", data, None) for i in range(2000)]
    env = spark.createDataFrame(hot + cold, ENVELOPE).repartition(8)
    spec = events_spec(minimum_message_time=None, maximum_message_time=None).with_tuning(max_rows_per_segment=300)
    paths = _paths(spark, "hot")
    process_batch(env, 0, spec, paths)
    rows = S.read_rows(spark, paths.table, spec)
    assert rows.count() == 2001
    assert rows.filter(F.col("messageId") == "hot").count() == 1
    assert S.read_ledger(spark, paths.ledger).count() == 5000
    per_file = rows.groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in per_file) <= 300


def test_json_and_gzipped_json_landing(spark):
    from tideline.sources.landing import read_envelopes

    env = fx.envelopes(spark, SF)
    root = scratch_path(spark, "json-landing")
    env.write.json(f"{root}/plain")
    env.write.option("compression", "gzip").json(f"{root}/gz")
    cols = ["ackId", "messageId", "publishTime", "data"]
    for sub in ("plain", "gz"):
        got = read_envelopes(spark, f"{root}/{sub}", fmt="json").select(cols)
        assert got.exceptAll(env.select(cols)).isEmpty() and env.select(cols).exceptAll(got).isEmpty()
    rows = ingest(read_envelopes(spark, f"{root}/gz", fmt="json"), events_spec()).rows
    assert rows.filter(F.col("disposition") == "processed").count() > 0


def test_update_mode_rollup_equals_complete(spark):
    from tideline.streaming.ingest import read_rollup_updates, start_rollup

    spec = events_spec()
    paths = _paths(spark, "rollup-modes")
    fx.envelopes(spark, SF).repartition(4).write.parquet(paths.landing)
    q = start_ingest(spark, spec, paths, max_files_per_trigger=1)
    q.awaitTermination()
    outs = {}
    for mode in ("complete", "update"):
        out = f"{paths.table}_{mode}"
        r = start_rollup(
            spark, spec, paths.table, out, f"{paths.checkpoint}_{mode}", "1 day", ["event_type"], "30 days", mode, 25
        )
        r.awaitTermination()
        assert len(r.recentProgress) >= 2
        outs[mode] = out
    complete = spark.read.parquet(outs["complete"]).select("t", "event_type", "rows")
    update = read_rollup_updates(spark, outs["update"], ["event_type"]).select("t", "event_type", "rows")
    assert complete.count() > 0
    assert complete.exceptAll(update).isEmpty() and update.exceptAll(complete).isEmpty()


@pytest.mark.parametrize("mode", ["update", "append"])
@pytest.mark.parametrize("granularity,first,border", [("week", "2024-01-01", "2024-01-08"), ("month", "2024-01-01", "2024-02-01")])
def test_rollup_keeps_rows_late_over_the_end_of_a_bucket(spark, granularity, first, border, mode):
    from tideline.streaming.ingest import rollup_stream

    spec = events_spec().with_schema(query_granularity=granularity)
    root = scratch_path(spark, f"late-{granularity}-{mode}")
    schema = "ts timestamp, event_type string, value double, disposition string"
    got, after = {}, datetime.fromisoformat(border)
    hours = [[-4, 1], [-1, 2], [-20, 26], [24 * 40], [24 * 40 + 1]]  # from the border
    for batch in hours:
        rows = [(after + timedelta(hours=h), "a", 1.0, "processed") for h in batch]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/rows")
        src = spark.readStream.schema(schema).parquet(f"{root}/rows")
        agg = rollup_stream(src, spec, None, ["event_type"], "1 day")
        sink = lambda df, _: got.update({str(r["t"])[:10]: r["rows"] for r in df.collect()})
        agg.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert got[first] == 3 and got[border] == 3


def test_two_subscriptions_one_table(spark):
    from tideline.sources.landing import read_envelopes, union_subscriptions

    env = fx.envelopes(spark, SF, keep_event_id=True)
    root = scratch_path(spark, "two-subs")
    for name, parity in (("sub-a", 0), ("sub-b", 1)):
        env.filter(F.col("event_id") % 2 == parity).drop("event_id", "delivery").write.parquet(f"{root}/{name}")
    both = union_subscriptions({n: read_envelopes(spark, f"{root}/{n}") for n in ("sub-a", "sub-b")})
    paths = _paths(spark, "two-subs-table")
    process_batch(both, 0, events_spec(), paths)
    ledger = S.read_ledger(spark, paths.ledger)
    assert ledger.filter(F.col("subscription").isNull()).isEmpty()
    assert ledger.count() == env.count()
    rows = S.read_rows(spark, paths.table, events_spec())
    assert rows.groupBy("subscription").count().count() == 2
    assert rows.count() == env.select("messageId").distinct().count()


def test_stream_ingest_from_pull_responses(spark):
    spec = events_spec()
    paths = _paths(spark, "pull-ingest")
    pulls = fx.pull_responses(fx.envelopes(spark, SF, keep_event_id=True))
    pulls.select(F.to_json(F.struct("receivedMessages")).alias("value")).repartition(3).write.text(paths.landing)
    q = start_ingest(spark, spec, paths, source="pulls", max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    batch = _paths(spark, "pull-ingest-batch")
    process_batch(fx.envelopes(spark, SF), 0, spec, batch)
    cols = ["messageId", "pos", "disposition", "reason", "ts", "value"]
    a = S.read_rows(spark, paths.table, spec).select(cols)
    b = S.read_rows(spark, batch.table, spec).select(cols)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_crash_after_publish_then_restart(spark, monkeypatch):
    """A crash between the data publish and the ledger write: the restarted
    query replays that batch from its checkpoint and the result is unchanged."""
    import tideline.streaming.ingest as SI

    spec = events_spec()
    paths = _paths(spark, "crash")
    fx.envelopes(spark, SF).repartition(3).write.parquet(paths.landing)
    real = SI.write_ledger
    calls = {"n": 0}

    def flaky(ledger, path):
        calls["n"] += 1
        if calls["n"] == 2:  # second micro-batch: rows published, ledger not yet
            raise RuntimeError("simulated crash")
        real(ledger, path)

    monkeypatch.setattr(SI, "write_ledger", flaky)
    q = start_ingest(spark, spec, paths, max_files_per_trigger=1)
    with pytest.raises(Exception):
        q.awaitTermination()
    monkeypatch.setattr(SI, "write_ledger", real)
    q = start_ingest(spark, spec, paths, max_files_per_trigger=1)  # same checkpoint
    q.awaitTermination()
    assert q.exception() is None

    clean = _paths(spark, "crash-clean")
    process_batch(fx.envelopes(spark, SF), 0, spec, clean)
    cols = ["messageId", "pos", "disposition", "reason", "ts", "value"]
    a = S.read_rows(spark, paths.table, spec).select(cols)
    b = S.read_rows(spark, clean.table, spec).select(cols)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert S.read_ledger(spark, paths.ledger).count() == fx.envelopes(spark, SF).count()
