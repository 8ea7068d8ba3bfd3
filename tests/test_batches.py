"""Batch identity, manifests, polls, clocks, sources and crashes of the commit."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests_support import SF

from tideline.plans.ingest import events_spec
from tideline.session import scratch_path
from tideline.sinks import segments as S
from tideline.sources import fixtures as fx
from tideline.sources.landing import land_envelopes
from tideline.sources.manifest import Landing, Slice, commits, new_slices, polls
from tideline.spec import IngestSpec, SpecError
from tideline.streaming import ingest as SI
from tideline.streaming.ingest import BatchIdentityError, StreamPaths, ingest_landing, process_batch, read_last_failures, read_rollup_updates, start_ingest, start_rollup


def _paths(spark, name):
    root = scratch_path(spark, name)
    return StreamPaths(*(f"{root}/{p}" for p in ("landing", "rows", "ledger", "meters", "checkpoint")))


def _ids(spark, paths, spec):
    return sorted(r["messageId"] for r in S.read_rows(spark, paths.table, spec).select("messageId").collect())


def _half(env, first):
    cut = F.col("publishTime") < "2024-01-15T00:00:00.000000Z"
    return env.filter(cut if first else ~cut)


def test_a_used_number_refuses_other_messages(spark):
    spec, paths, env = events_spec(), _paths(spark, "identity"), fx.envelopes(spark, SF)
    process_batch(_half(env, True), 0, spec, paths)
    before, acked = _ids(spark, paths, spec), S.read_ledger(spark, paths.ledger).count()
    with pytest.raises(BatchIdentityError):
        process_batch(env, 0, spec, paths)
    assert _ids(spark, paths, spec) == before and S.read_ledger(spark, paths.ledger).count() == acked
    process_batch(_half(env, True).repartition(3), 0, spec, paths)  # the same messages in another order


def test_batch_jobs_take_what_is_new(spark):
    spec, paths, env = events_spec(), _paths(spark, "growing"), fx.envelopes(spark, SF)
    assert ingest_landing(spark, spec, paths) == {}
    land_envelopes(_half(env, True), paths.landing)
    assert list(ingest_landing(spark, spec, paths)) == [0]
    assert ingest_landing(spark, spec, paths) == {}
    land_envelopes(_half(env, False), paths.landing)
    assert list(ingest_landing(spark, spec, paths)) == [1]
    whole = _paths(spark, "growing-whole")
    process_batch(env, 0, spec, whole)
    assert _ids(spark, paths, spec) == _ids(spark, whole, spec)
    assert S.read_ledger(spark, paths.ledger).count() == env.count()


def test_a_job_cut_off_before_the_ledger_acknowledges_later(spark, monkeypatch):
    spec, paths, env = events_spec(), _paths(spark, "no-ack"), fx.envelopes(spark, SF)
    land_envelopes(_half(env, True), paths.landing)
    real = SI.write_ledger

    def dies(*a):
        raise OSError("lost")

    monkeypatch.setattr(SI, "write_ledger", dies)
    with pytest.raises(OSError):
        ingest_landing(spark, spec, paths)
    monkeypatch.setattr(SI, "write_ledger", real)
    land_envelopes(_half(env, False), paths.landing)
    assert list(ingest_landing(spark, spec, paths)) == [1]
    assert S.read_ledger(spark, paths.ledger).count() == env.count()
    assert len(_ids(spark, paths, spec)) == env.select("messageId").distinct().count()


@pytest.mark.parametrize("at", ["record", "rename", "file"])
def test_a_publish_that_was_cut_off_goes_on_with_the_same_files(spark, monkeypatch, at):
    """publish, crash, rollup, replay, rollup: nothing doubles, nothing is lost."""
    spec, paths, env = events_spec(), _paths(spark, f"cut-{at}"), fx.envelopes(spark, SF)
    real = S.finish_publish if at != "record" else S.write_record

    def dies(spark, *a, **kw):
        if at == "file":  # a store without an atomic rename: one file has come
            name = next(n for n, _ in S.list_files(spark, S.staging_path(paths.table, 0)) if n.endswith(".parquet"))
            fs, to = S._fs(spark, f"{paths.table}/batch_id=0/{name}")
            fs.mkdirs(to.getParent())
            assert fs.rename(S._fs(spark, f"{S.staging_path(paths.table, 0)}/{name}")[1], to)
        raise OSError("lost")

    monkeypatch.setattr(S, "write_record" if at == "record" else "finish_publish", dies)
    with pytest.raises(OSError):
        process_batch(env, 0, spec, paths)
    monkeypatch.setattr(S, "write_record" if at == "record" else "finish_publish", real)

    def rolled():
        S.write_text(spark, f"{paths.table}/_x", "")  # the folder is there
        start_rollup(spark, spec, paths.table, f"{paths.table}_r", f"{paths.checkpoint}_r", None, ["event_type"], "31 days").awaitTermination()
        return read_rollup_updates(spark, f"{paths.table}_r", ["event_type"]).agg(F.sum("rows")).first()[0] if S.path_exists(spark, f"{paths.table}_r") else 0

    early = rolled() or 0
    process_batch(env, 0, spec, paths)
    want = S.read_segments(spark, paths.table, spec).count()
    assert early <= want and rolled() == want
    assert len(_ids(spark, paths, spec)) == env.select("messageId").distinct().count()
    assert not S.path_exists(spark, S.staging_path(paths.table, 0))


def test_polls_keep_both_bounds():
    spec = events_spec(max_messages_per_poll=10, max_message_size_per_poll=100).with_tuning(max_total_rows=25)
    files = [Slice(None, "a", 4, 40, 4), Slice(None, "b", 0, 5, 0), Slice(None, "c", 33, 66, 33), Slice(None, "d", 3, 290, 3), Slice(None, "e", 1, 500, 1)]
    cut = polls(files, spec, True)
    assert all(sum(s.messages for s in p) <= 10 for p in cut)
    assert all(sum(s.bytes for s in p) <= 100 or sum(s.messages for s in p) == 1 for p in cut)
    for f in files:
        own = [s for p in cut for s in p if s.path == f.path]
        assert sum(s.messages for s in own) == f.messages and own[-1].hi is None
        for x, y in zip(own, own[1:]):
            assert x.hi == y.lo
    groups = commits(cut, spec)
    rows = [sum(s.rows for p in g for s in p) for g in groups]
    assert sum(rows) == 41 and all(n >= 25 for n in rows[:-1]) and all(n < 25 + 10 for n in rows)
    whole = polls(files, spec, False)
    assert all(s.lo is None for p in whole for s in p) and sum(len(p) for p in whole) == 5
    assert [s.path for p in polls([], spec, True) for s in p] == []


def test_jobs_cut_files_between_commits(spark):
    env = fx.envelopes(spark, SF)
    spec = events_spec(max_messages_per_poll=70).with_tuning(max_total_rows=150)
    paths = _paths(spark, "cut-files")
    land_envelopes(env.coalesce(2), paths.landing)
    done = ingest_landing(spark, spec, paths)
    assert len(done) > 5
    whole = _paths(spark, "cut-files-whole")
    process_batch(env, 0, events_spec(), whole)
    assert _ids(spark, paths, spec) == _ids(spark, whole, spec)
    assert S.read_ledger(spark, paths.ledger).count() == env.count()
    assert new_slices(spark, Landing({None: paths.landing}), paths.table, spec) == []


def test_messages_of_several_rows_count_as_rows(spark):
    env = fx.batch_envelopes(spark, SF)
    spec = events_spec(minimum_message_time=None, maximum_message_time=None).with_schema(rows_field="rows").with_tuning(max_total_rows=100)
    paths = _paths(spark, "rows-field")
    land_envelopes(env.coalesce(1), paths.landing, 20)
    done = ingest_landing(spark, spec, paths)
    rows_of_all = S.read_rows(spark, paths.table, spec).count()
    rows = [sum(m.values()) for m in done.values()]
    assert len(rows) > 5 and max(rows) < 200 and sum(rows) == rows_of_all


def test_batch_clock_is_kept_for_a_replay(spark):
    spec = IngestSpec.from_json({
        "dataSchema": {"dataSource": "d", "fields": [{"name": "v", "type": "double", "role": "metric"}]},
        "ioConfig": {"topic": "t", "referenceTime": "batch", "lateMessageRejectionPeriod": "PT1H", "earlyMessageRejectionPeriod": "PT1H"},
    })
    paths = _paths(spark, "clock")
    from tideline.sources.schema import ENVELOPE

    def messages(batch):
        hours = [(f"a{batch}-{h}", f"m{batch}-{h}", "2024-01-01T00:00:00Z", f'{{"ts": "2024-01-01T{h:02d}:30:00Z"}}', None) for h in range(24)]
        return spark.createDataFrame(hours, ENVELOPE)

    for batch, hour in enumerate([3, 10, 20]):
        process_batch(messages(batch), batch, spec, paths, clock=lambda hour=hour: datetime(2024, 1, 1, hour))
    kept = lambda: sorted((r["batch_id"], r["ts"].hour) for r in S.read_segments(spark, paths.table, spec).collect())
    assert kept() == [(0, 2), (0, 3), (1, 9), (1, 10), (2, 19), (2, 20)]
    S.delete_path(spark, S._marker(paths.table, 1))  # as if the second had not been committed
    process_batch(messages(1), 1, spec, paths, clock=lambda: datetime(2024, 1, 1, 23))
    assert kept() == [(0, 2), (0, 3), (1, 9), (1, 10), (2, 19), (2, 20)]


def test_last_failures_of_the_job(spark):
    env = fx.envelopes(spark, SF)
    spec, paths = events_spec().with_tuning(max_saved_parse_exceptions=10), _paths(spark, "last-failures")
    third = F.pmod(F.crc32(F.col("messageId").cast("binary")), F.lit(3))
    for batch in range(3):
        process_batch(env.filter(third == batch), batch, spec, paths)
    failed = S.read_rows(spark, paths.table, spec).filter(F.col("disposition") == "unparseable").collect()
    want = sorted(((r["publishTime"], r["messageId"], r["pos"]) for r in failed), reverse=True)[:10]
    assert [(r["publishTime"], r["messageId"], r["pos"]) for r in read_last_failures(spark, paths.table).collect()] == want
    assert read_last_failures(spark, f"{paths.table}_none").count() == 0


def test_dedup_bound_does_not_depend_on_the_zone_of_the_driver(spark, monkeypatch):
    import time

    spec, env = events_spec().with_tuning(dedup_horizon=timedelta(days=1)), fx.envelopes(spark, SF)
    want = SI._received(env, spec)
    monkeypatch.setenv("TZ", "Asia/Tokyo")
    time.tzset()
    try:
        got = SI._received(env, spec)
    finally:
        monkeypatch.delenv("TZ")
        time.tzset()
    least = env.agg(F.min("publishTime")).first()[0]
    assert got == want and datetime.fromisoformat(got.since) == datetime.fromisoformat(least) - timedelta(days=1)


def test_one_stream_over_several_subscriptions(spark):
    spec, paths, env = events_spec(), _paths(spark, "two-streams"), fx.envelopes(spark, SF, keep_event_id=True)
    folders = {name: f"{paths.landing}/{name}" for name in ("even", "odd")}
    for parity, name in enumerate(folders):  # every id in both: subscriptions have their own messages
        env.drop("event_id", "delivery").repartition(3 + parity).write.parquet(folders[name])
    q = start_ingest(spark, spec, paths, max_files_per_trigger=2, subscriptions=folders)
    q.awaitTermination()
    assert q.exception() is None
    rows = {r["subscription"]: r["count"] for r in S.read_rows(spark, paths.table, spec).groupBy("subscription").count().collect()}
    n = env.select("messageId").distinct().count()
    assert rows == {"even": n, "odd": n}
    acks = {r["subscription"]: r["count"] for r in S.read_ledger(spark, paths.ledger).groupBy("subscription").count().collect()}
    assert acks == {"even": env.count(), "odd": env.count()}


def test_pretty_printed_pulls_in_a_stream_and_a_job(spark):
    pretty = '{\n "receivedMessages": [\n  {"ackId": "a%d", "message": {"messageId": "m%d", "publishTime": "2024-01-10T00:00:00Z", "data": "{\\"ts\\": \\"2024-01-10T00:00:00Z\\"}"}}\n ]\n}'
    spec = events_spec()
    for name in ("stream", "job"):
        paths = _paths(spark, f"pretty-{name}")
        for i in range(3):
            S.write_text(spark, f"{paths.landing}/{i}.json", pretty % (i, i))
        if name == "stream":
            start_ingest(spark, spec, paths, source="pulls", multi_line=True).awaitTermination()
        else:
            ingest_landing(spark, spec, paths, Landing({None: paths.landing}, source="pulls", multi_line=True))
        assert sorted(r["messageId"] for r in S.read_segments(spark, paths.table, spec).collect()) == ["m0", "m1", "m2"]
        assert S.read_ledger(spark, paths.ledger).count() == 3


def test_a_stream_refuses_two_bounds(spark):
    with pytest.raises(SpecError):
        start_ingest(spark, events_spec(max_messages_per_poll=5, max_message_size_per_poll=5), _paths(spark, "two-bounds"))
