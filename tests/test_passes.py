"""Batch jobs that take many commits in one pass, and what each step costs."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests_support import SF

from tideline.functions.timefns import parse_event_time, with_event_time
from tideline.operators.meters import ParseFailureLimitExceeded
from tideline.operators.rows import rows_from_envelopes
from tideline.plans.ingest import events_spec
from tideline.session import scratch_path
from tideline.sinks import merge as G
from tideline.sinks import segments as S
from tideline.sources import fixtures as fx
from tideline.sources.landing import land_envelopes
from tideline.sources.manifest import Landing, commits, new_slices, polls, read_polls
from tideline.sources.schema import ENVELOPE
from tideline.streaming import ingest as SI
from tideline.streaming.ingest import StreamPaths, ingest_landing, process_batch


def _paths(spark, name):
    root = scratch_path(spark, name)
    return StreamPaths(*(f"{root}/{p}" for p in ("landing", "rows", "ledger", "meters", "checkpoint")))


def _rows(spark, paths, spec):
    got = S.read_rows(spark, paths.table, spec).select("subscription", "messageId", "publishTime", "disposition", "reason", "batch_id").collect()
    return sorted(tuple(map(str, r)) for r in got)


def _acks(spark, paths):
    return sorted(tuple(map(str, r)) for r in S.read_ledger(spark, paths.ledger).select("ackId", "messageId", "subscription", "batch_id").collect())


def _odd(spark):
    """Copies minutes to days apart, in no order of time; null ids, times and payloads."""
    rows = []
    for i in range(240):
        m = None if i % 17 == 0 else f"m{i % 40}"
        p = None if i % 23 == 0 else "not a time" if i % 29 == 0 else f"2024-01-{1 + (i * 7) % 28:02d}T{i % 24:02d}:00:00.000000Z"
        d = None if i % 31 == 0 else "no json" if i % 13 == 0 else f'{{"ts":"2024-01-{5 + i % 20:02d}T0{i % 10}:00:00Z","event_id":{i},"value":{i}}}'
        rows.append((f"a{i}", m, p, d, None if i % 3 else {"origin": "o"}))
    return spark.createDataFrame(rows, ENVELOPE)


@pytest.mark.parametrize("labels", [None, ("a", "b")])
def test_many_commits_in_a_pass_are_what_they_are_alone(spark, monkeypatch, labels):
    spec = events_spec(max_messages_per_poll=7).with_tuning(max_total_rows=20, dedup_horizon=timedelta(hours=30), max_saved_parse_exceptions=4)
    folders = {n: scratch_path(spark, f"odd-{n}") for n in labels or (None,)}
    for k, folder in enumerate(folders.values()):
        _odd(spark).filter(F.crc32(F.col("ackId").cast("binary")) % 5 >= k).repartition(2).write.parquet(folder)
    landing, alone, together = Landing(folders), _paths(spark, "alone"), _paths(spark, "together")
    for n, cut in enumerate(commits(polls(new_slices(spark, landing, alone.table, spec), spec, True), spec)):
        process_batch(read_polls(spark, landing, cut), n, spec, alone, cut)
    monkeypatch.setattr(SI, "COMMITS_AT_ONCE", 5)  # several passes: against the ledger and within a pass
    done = ingest_landing(spark, spec, together, landing)
    assert len(done) > 10 and _rows(spark, together, spec) == _rows(spark, alone, spec) and _acks(spark, together) == _acks(spark, alone)
    record = lambda p, n: {k: v for k, v in S.committed(spark, p.table, n).items()}
    assert all(record(together, n) == record(alone, n) for n in done)
    assert not S.list_dirs(spark, f"{together.table}/_staging") and ingest_landing(spark, spec, together, landing) == {}


def test_commits_of_a_pass_share_their_jobs(spark, monkeypatch):
    spec, paths, env, calls = events_spec().with_tuning(max_total_rows=50), _paths(spark, "share"), fx.envelopes(spark, SF), []
    land_envelopes(env.coalesce(2), paths.landing)
    real = SI.write_ledger
    monkeypatch.setattr(SI, "write_ledger", lambda *a: (calls.append(a), real(*a)))
    done = ingest_landing(spark, spec, paths)
    assert len(done) > 15 and len(calls) == 1  # one job a pass, not one a commit
    assert S.read_ledger(spark, paths.ledger).count() == env.count()


def test_a_pass_stops_at_the_commit_over_the_failure_limit(spark):
    spec, paths, alone = events_spec().with_tuning(max_total_rows=50, max_parse_exceptions=12), _paths(spark, "limit"), _paths(spark, "limit-alone")
    land_envelopes(fx.envelopes(spark, SF).coalesce(1), paths.landing)
    landing = Landing({None: paths.landing})
    with pytest.raises(ParseFailureLimitExceeded):
        for n, cut in enumerate(commits(polls(new_slices(spark, landing, alone.table, spec), spec, True), spec)):
            process_batch(read_polls(spark, landing, cut), n, spec, alone, cut)
    with pytest.raises(ParseFailureLimitExceeded):
        ingest_landing(spark, spec, paths)
    assert S.commit_ids(spark, paths.table) == S.commit_ids(spark, alone.table) != []
    assert _rows(spark, paths, spec) == _rows(spark, alone, spec) and _acks(spark, paths) == _acks(spark, alone)


def test_rows_without_a_segment_stop_a_pass_at_their_commit(spark):
    spec = events_spec(minimum_message_time=None, maximum_message_time=None).with_schema(timestamp_format="millis").with_tuning(max_total_rows=20, strict_segments=True)
    paths, body = _paths(spark, "strict"), '{"ts":%s}'
    rows = [(f"a{i}", f"m{i}", "2024-01-10T00:00:00Z", body % (253402300799000 if i == 70 else 1704067200000 + i), None) for i in range(100)]
    land_envelopes(spark.createDataFrame(rows, ENVELOPE).coalesce(1), paths.landing)
    with pytest.raises(Exception, match="cannot allocate a segment for message m70"):
        ingest_landing(spark, spec, paths)
    assert S.commit_ids(spark, paths.table) == [0, 1, 2] and S.read_ledger(spark, paths.ledger).count() == 60


def test_the_time_is_parsed_once_a_row(spark):
    rows = rows_from_envelopes(fx.envelopes(spark, SF), events_spec())
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("as decimal(38,6)") == 1 and plan.count("RLIKE") == 1


@pytest.mark.parametrize("fmt", ["auto", "iso", "millis", "seconds", "yyyy-MM-dd HH:mm:ss"])
def test_time_columns_are_those_of_the_expression(spark, fmt):
    texts = [None, "", "x", "not a time", "12:00", "2024-01-05", "2024-01-05T01:02:03Z", " 2024-01-05 01:02:03 ", "1704067200000", " 17 ", "1e3", "-5", "100000000000000000", "1.5", "+2024-01-05", "1:2", "9" * 45]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    ts, err = parse_event_time(F.col("t"), fmt)
    want = df.select("t", F.unix_micros(ts), err).collect()
    got = with_event_time(df, F.col("t"), fmt).select("t", F.unix_micros("event_time"), "time_error").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_small_files_are_written_by_many_tasks(spark, monkeypatch, request):
    spec, paths, env = events_spec().with_tuning(max_rows_per_segment=5), _paths(spark, "cuts"), fx.envelopes(spark, SF)
    monkeypatch.setattr(S, "FILES_PER_CUT", 10)
    least = "spark.sql.adaptive.coalescePartitions.minPartitionSize"  # tables of a test are below it
    spark.conf.set(least, "1b")
    request.addfinalizer(lambda: spark.conf.unset(least))
    process_batch(env, 0, spec, paths)
    writers = lambda: S.read_rows(spark, paths.table, spec).filter("segment_start IS NULL").select(F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1)).distinct().count()
    assert writers() > 1
    whole = _paths(spark, "cuts-whole")
    process_batch(env, 0, events_spec(), whole)
    assert _rows(spark, paths, spec) == _rows(spark, whole, spec)
    S.purge_interval(spark, paths.table, spec, datetime(2024, 1, 1), datetime(2024, 1, 10, 12))
    S.purge_interval(spark, whole.table, spec, datetime(2024, 1, 1), datetime(2024, 1, 10, 12))
    assert writers() > 1 and _rows(spark, paths, spec) == _rows(spark, whole, spec)
    files = S.read_rows(spark, paths.table, spec).groupBy(F.input_file_name()).count()
    assert files.agg(F.max("count")).first()[0] <= 5


def test_a_merge_deletes_folders_that_go_whole(spark, monkeypatch):
    spec, paths, env = events_spec().with_tuning(max_rows_per_segment=4), _paths(spark, "merge %x"), fx.envelopes(spark, SF)
    part = F.pmod(F.crc32(F.col("messageId").cast("binary")), F.lit(3))
    for n in range(3):
        process_batch(env.filter(part == n), n, spec, paths)
    process_batch(env.limit(0), 3, spec, paths)
    before, journals, real = _rows(spark, paths, spec), [], G.write_record
    monkeypatch.setattr(G, "write_record", lambda s, path, record: (journals.append(record), real(s, path, record)))
    merged = G.merge_segments(spark, paths.table, spec.with_tuning(max_rows_per_segment=20))
    assert 0 < len(journals[0]["delete"]) < merged and not any(d.endswith(".parquet") and d.rpartition("/")[0] in journals[0]["delete"] for d in journals[0]["delete"])
    assert _rows(spark, paths, spec) == before


def test_a_large_landed_file_is_read_by_many_tasks(spark):
    path = scratch_path(spark, "row-groups")
    text = F.concat(*[F.sha2((F.col("id") * 8 + k).cast("string"), 512) for k in range(8)])  # 1 KB that does not compress well
    rows = spark.range(40000, numPartitions=1).select(F.lit("a").alias("ackId"), F.col("id").cast("string").alias("messageId"), F.lit("2024-01-10T00:00:00Z").alias("publishTime"), text.alias("data"), F.lit(None).cast("map<string,string>").alias("attributes"))
    land_envelopes(rows, path)
    env = spark.read.schema(ENVELOPE).parquet(path)
    assert len(env.inputFiles()) == 1
    busy = env.groupBy(F.spark_partition_id()).count().count()
    assert busy > 2
