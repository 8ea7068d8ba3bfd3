"""Merging of small files, late rows of the rollup log."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests_support import SF

from tideline.operators.rollup import rollup
from tideline.plans.ingest import events_spec
from tideline.session import scratch_path
from tideline.sinks import merge as G
from tideline.sinks import segments as S
from tideline.sources import fixtures as fx
from tideline.streaming import ingest as SI
from tideline.streaming.ingest import StreamPaths, drain_rollup, process_batch, read_rollup_log, read_rollup_updates, start_rollup_log


def _paths(spark, name):
    root = scratch_path(spark, f"{name} %x")  # awkward characters in paths
    return StreamPaths(*(f"{root}/{p}" for p in ("landing", "rows", "ledger", "meters", "checkpoint")))


def _rows(spark, paths, spec):
    return sorted((str(r["messageId"]), r["batch_id"], r["disposition"], str(r["reason"])) for r in S.read_rows(spark, paths.table, spec).collect())


def _filled(spark, name, batches=5, **tuning):
    spec, paths, env = events_spec().with_tuning(**{"max_rows_per_segment": 20} | tuning), _paths(spark, name), fx.envelopes(spark, SF)
    part = F.pmod(F.crc32(F.col("messageId").cast("binary")), F.lit(batches))
    for batch in range(batches):
        process_batch(env.filter(part == batch), batch, spec, paths)
    process_batch(env.limit(0), batches, spec, paths)  # the last batch is never merged
    return spec, paths, env


def test_merge_fills_files_and_keeps_rows(spark):
    spec, paths, env = _filled(spark, "merge")
    before, acks = _rows(spark, paths, spec), S.read_ledger(spark, paths.ledger).count()
    assert G.merge_segments(spark, paths.table, spec) > 20
    assert _rows(spark, paths, spec) == before
    for r in G.files_by_segment(S.read_segments(spark, paths.table, spec)).collect():
        assert r["files"] == -(-r["rows"] // 20)
    files = S.read_rows(spark, paths.table, spec).groupBy(F.input_file_name()).count()
    assert files.agg(F.max("count")).first()[0] <= 20
    assert G.merge_segments(spark, paths.table, spec) == 0  # nothing small is left
    days = len(S.list_dirs(spark, paths.ledger))
    G.merge_ledger(spark, paths.ledger, paths.table)
    ledger = S.read_ledger(spark, paths.ledger)
    assert ledger.count() == acks == ledger.select("ackId").distinct().count() and len(ledger.inputFiles()) <= days
    assert {r[0] for r in ledger.select("batch_id").distinct().collect()} == set(range(5))
    process_batch(env.filter(F.pmod(F.crc32(F.col("messageId").cast("binary")), F.lit(5)) == 1), 1, spec, paths)  # a replay of a merged batch
    assert _rows(spark, paths, spec) == before and S.read_ledger(spark, paths.ledger).count() == acks
    # dedup against merged acks, a purge of merged files, another merge
    process_batch(env, 6, spec, paths)
    assert len(_rows(spark, paths, spec)) == len(before)
    S.purge_interval(spark, paths.table, spec, datetime(2024, 1, 10, 12), datetime(2024, 1, 15))
    kept = S.read_segments(spark, paths.table, spec)
    assert kept.filter((F.col("ts") >= "2024-01-10 12:00:00") & (F.col("ts") < "2024-01-15")).isEmpty() and not kept.isEmpty()
    left = _rows(spark, paths, spec)
    G.merge_segments(spark, paths.table, spec)
    assert _rows(spark, paths, spec) == left


def test_a_merge_goes_on_from_its_journal(spark, monkeypatch):
    spec, paths, _ = _filled(spark, "merge-cut")
    before, real, calls = _rows(spark, paths, spec), S.delete_path, []

    def dies(spark, path):
        calls.append(path)
        if len(calls) > 8:
            raise OSError("lost")
        return real(spark, path)

    monkeypatch.setattr(S, "delete_path", dies)
    with pytest.raises(OSError):
        G.merge_segments(spark, paths.table, spec)
    monkeypatch.setattr(S, "delete_path", real)
    S.finish_purge(spark, paths.table)
    assert _rows(spark, paths, spec) == before and G.merges(spark, paths.table) == 1


def test_rollups_are_unaware_of_merges(spark):
    spec, paths, env = _filled(spark, "merge-rollup")
    args = lambda n: (spark, spec, paths.table, f"{paths.table}_r{n}", f"{paths.checkpoint}_r{n}", None, ["event_type"], "31 days")
    total = lambda n: read_rollup_updates(spark, f"{paths.table}_r{n}", ["event_type"]).agg(F.sum("rows")).first()[0]
    G.register_rollup(spark, paths.table, f"{paths.checkpoint}_r1")
    assert G.mergeable(spark, paths.table) == -1 and G.merge_segments(spark, paths.table, spec) == 0  # it has read nothing yet
    drain_rollup(*args(1))
    assert G.merge_segments(spark, paths.table, spec) > 0
    late = spark.createDataFrame([("a", "new", "2024-01-10T00:00:00Z", '{"ts":"2024-01-10T00:00:00Z"}', None)], env.schema)
    process_batch(late, 6, spec, paths)
    for n in (1, 2):  # one from before the merge, one from after it
        drain_rollup(*args(n))
        assert total(n) == S.read_segments(spark, paths.table, spec).count()
    process_batch(env.limit(0), 7, spec, paths)
    drain_rollup(*args(1))
    drain_rollup(*args(2))
    assert G.merge_segments(spark, paths.table, spec) > 0  # a second merge takes merged files again
    for n in (1, 2, 3):
        drain_rollup(*args(n))
        assert total(n) == S.read_segments(spark, paths.table, spec).count()
    G.register_rollup(spark, paths.table, "gone")
    assert G.mergeable(spark, paths.table) == -1
    G.forget_rollup(spark, paths.table, "gone")
    assert G.mergeable(spark, paths.table) > 0


def test_rollup_log_keeps_late_rows(spark):
    spec, paths, env = events_spec(), _paths(spark, "rollup-log"), fx.envelopes(spark, SF)
    out = f"{paths.table}_log"
    run = lambda: start_rollup_log(spark, spec, paths.table, out, f"{paths.checkpoint}_log", "2 days", ["event_type"]).awaitTermination()
    cuts = ["2024-01-20", "2024-01-15", "2024-01-01"]
    hi = "9"
    for batch, lo in enumerate(cuts):
        process_batch(env.filter((F.col("publishTime") >= lo) & (F.col("publishTime") < hi)), batch, spec, paths)
        run()
        hi = lo
    processed = S.read_segments(spark, paths.table, spec)
    late = spark.read.parquet(f"{out}_late")
    rolled = read_rollup_log(spark, out, spec, ["event_type"])
    assert late.count() > 0 and rolled.agg(F.sum("rows")).first()[0] + late.count() == processed.count()
    on_time = processed.join(late.select("messageId", "pos"), ["messageId", "pos"], "left_anti").withColumn("disposition", F.lit("processed"))
    want = rollup(on_time, spec, dimensions=["event_type"], granularity="day")
    cols = ["t", "event_type", "rows", F.round("value_sum", 2), "value_min", "value_max"]
    assert {tuple(r) for r in rolled.select(cols).collect()} == {tuple(r) for r in want.select(cols).collect()}


def test_a_replayed_micro_batch_of_the_log_changes_nothing(spark, monkeypatch):
    spec, paths, env = events_spec(), _paths(spark, "log-replay"), fx.envelopes(spark, SF)
    out = f"{paths.table}_log"
    run = lambda: start_rollup_log(spark, spec, paths.table, out, f"{paths.checkpoint}_log", "2 days", ["event_type"]).awaitTermination()
    process_batch(env.filter(F.col("publishTime") >= "2024-01-15"), 0, spec, paths)
    run()
    process_batch(env.filter(F.col("publishTime") < "2024-01-15"), 1, spec, paths)
    real, calls = SI.write_record, []

    def dies(spark, path, record):
        calls.append(path)
        if "_progress" in path:
            raise OSError("lost")
        real(spark, path, record)

    monkeypatch.setattr(SI, "write_record", dies)
    with pytest.raises(Exception):
        run()
    monkeypatch.setattr(SI, "write_record", real)
    run()
    n = read_rollup_log(spark, out, spec, ["event_type"]).agg(F.sum("rows")).first()[0] + spark.read.parquet(f"{out}_late").count()
    assert n == S.read_segments(spark, paths.table, spec).count()
