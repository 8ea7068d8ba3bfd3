"""Commits, purges, submitted specs and unreadable pulls."""

from __future__ import annotations

import logging
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests_support import SF

from tideline.operators.meters import ParseFailureLimitExceeded
from tideline.operators.rows import rows_from_envelopes
from tideline.plans.ingest import events_spec
from tideline.session import scratch_path
from tideline.sinks import segments as S
from tideline.sources import fixtures as fx
from tideline.sources.landing import read_pull_responses
from tideline.spec import IngestSpec, SpecError
from tideline.streaming.ingest import StreamPaths, process_batch, start_rollup


def _paths(spark, name):
    root = scratch_path(spark, name)
    return StreamPaths(*(f"{root}/{p}" for p in ("landing", "rows", "ledger", "meters", "checkpoint")))


def _files(spark, paths, spec):
    return {r[0] for r in S.read_rows(spark, paths.table, spec).select(F.input_file_name()).distinct().collect()}


def test_replay_of_a_committed_batch_keeps_its_files(spark):
    spec, paths, env = events_spec(), _paths(spark, "keep-files"), fx.envelopes(spark, SF)
    first = process_batch(env, 0, spec, paths)
    files = _files(spark, paths, spec)
    assert process_batch(env, 0, spec, paths) == first
    assert _files(spark, paths, spec) == files


def test_a_folder_without_commit_record_is_replaced(spark):
    spec, paths, env = events_spec(), _paths(spark, "cut-off"), fx.envelopes(spark, SF)
    process_batch(env, 0, spec, paths)
    before = S.read_rows(spark, paths.table, spec).count()
    S.delete_path(spark, S._marker(paths.table, 0))
    process_batch(env, 0, spec, paths)
    assert S.read_rows(spark, paths.table, spec).count() == before


def _bad(spark, key):
    return spark.createDataFrame([(f"a{key}", f"m{key}", "2024-01-06T00:00:00Z", "no json", None)], fx.envelopes(spark, SF).schema)


def test_failure_limit_holds_for_the_whole_job(spark):
    spec, paths = events_spec().with_tuning(max_parse_exceptions=1), _paths(spark, "job-limit")
    process_batch(_bad(spark, 1), 0, spec, paths)
    for _ in range(2):  # a retry fails as well, and a replay of the committed batch does not count twice
        process_batch(_bad(spark, 1), 0, spec, paths)
        with pytest.raises(ParseFailureLimitExceeded):
            process_batch(_bad(spark, 2), 1, spec, paths)
    assert S.read_rows(spark, paths.table, spec).count() == 1


def test_parse_failures_are_logged_when_asked(spark, caplog):
    with caplog.at_level(logging.WARNING, logger="tideline.ingest"):
        process_batch(_bad(spark, 1), 0, events_spec(), _paths(spark, "quiet"))
        assert not caplog.records
        process_batch(_bad(spark, 1), 0, events_spec().with_tuning(log_parse_exceptions=True), _paths(spark, "logged"))
    assert "1 unparseable rows, bad_json" in caplog.text


def test_a_purge_goes_on_from_its_journal(spark, monkeypatch):
    spec, paths = events_spec(), _paths(spark, "journal")
    process_batch(fx.envelopes(spark, SF), 0, spec, paths)
    keep = ~F.coalesce((F.col("ts") >= "2024-01-10 12:00:00") & (F.col("ts") < "2024-01-15"), F.lit(False))
    expected = S.read_rows(spark, paths.table, spec).filter(keep).count()
    real, calls = S.delete_path, []

    def dies(spark, path):
        calls.append(path)
        if "segment_start=2024-01-12" in path:
            raise OSError("lost")
        return real(spark, path)

    monkeypatch.setattr(S, "delete_path", dies)
    with pytest.raises(OSError):
        S.purge_interval(spark, paths.table, spec, datetime(2024, 1, 10, 12), datetime(2024, 1, 15))
    monkeypatch.setattr(S, "delete_path", real)
    S.finish_purge(spark, paths.table)
    assert S.read_rows(spark, paths.table, spec).count() == expected
    S.finish_purge(spark, paths.table)
    assert S.read_generation(spark, paths.table) == 1


def test_rollup_refuses_a_checkpoint_from_before_a_purge(spark):
    spec, paths = events_spec(), _paths(spark, "generation")
    process_batch(fx.envelopes(spark, SF), 0, spec, paths)
    start = lambda: start_rollup(spark, spec, paths.table, f"{paths.table}_r", f"{paths.checkpoint}_r", None, ["event_type"], "31 days")
    start().awaitTermination()
    S.purge_interval(spark, paths.table, spec, datetime(2024, 1, 10), datetime(2024, 1, 15))
    with pytest.raises(SpecError):
        start()


def test_ledger_lists_only_the_days_asked_for(spark):
    paths = _paths(spark, "ledger-days")
    process_batch(fx.envelopes(spark, SF), 0, events_spec(), paths)
    since = S.read_ledger(spark, paths.ledger, datetime(2024, 1, 20).date())
    days = {f.split("publish_day=")[1][:10] for f in since.inputFiles() if "__HIVE" not in f}
    assert days and min(days) >= "2024-01-20"
    assert since.count() < S.read_ledger(spark, paths.ledger).count()


def test_submitted_schema(spark):
    base = {"dataSource": "d", "timestampSpec": {"column": "at"}, "dimensionsSpec": {"dimensions": ["x", {"type": "long", "name": "y"}]}}
    io = {"topic": "t"}
    metrics = [{"type": "count", "name": "n"}, {"type": "longSum", "name": "s", "fieldName": "v"}]
    spec = IngestSpec.from_json({"dataSchema": base | {"metricsSpec": metrics}, "ioConfig": io, "tuningConfig": {"dedupHorizon": "P2D", "strictSegments": True}})
    assert spec.data_schema.timestamp_column == "at"
    assert [(f.name, f.type, f.role) for f in spec.data_schema.fields] == [("x", "string", "dimension"), ("y", "bigint", "dimension"), ("v", "bigint", "metric")]
    assert spec.tuning.dedup_horizon.days == 2 and spec.tuning.strict_segments
    for broken in (
        {"dataSource": "d"},
        base | {"metricsSpec": [{"type": "median", "name": "m", "fieldName": "v"}]},
        base | {"metricsSpec": [metrics[1], metrics[1] | {"type": "doubleMax"}]},
        base | {"dimensionsSpec": {"dimensions": ["x", "x"]}},
    ):
        with pytest.raises(SpecError):
            IngestSpec.from_json({"dataSchema": broken, "ioConfig": io})


def test_pretty_printed_and_broken_pulls(spark):
    root = scratch_path(spark, "pulls")
    pretty = '{\n "receivedMessages": [\n  {"ackId": "a1", "message": {"messageId": "m1", "data": "{}"}}\n ]\n}'
    S.write_text(spark, f"{root}/pretty/1.json", pretty)
    S.write_text(spark, f"{root}/pretty/2.json", pretty[:-9])
    got = {(r["messageId"], r["ackId"]) for r in read_pull_responses(spark, f"{root}/pretty", multi_line=True).collect()}
    assert got == {("m1", "a1"), (None, None)}
    S.write_text(spark, f"{root}/lines/1.json", '{"receivedMessages": [{"ackId": "a2", "message": {"messageId": "m2", "data": "{}"}}]}\n{"receivedMess')
    env = read_pull_responses(spark, f"{root}/lines")
    rows = {(r["messageId"], r["disposition"], r["reason"]) for r in rows_from_envelopes(env, events_spec()).collect()}
    assert rows == {("m2", "unparseable", "no_event_time"), (None, "unparseable", "bad_json")}
