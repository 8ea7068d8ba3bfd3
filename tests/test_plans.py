"""Plan checks: no cartesian products, partial aggregation, no decode in filters."""

import re

import pytest
from pyspark.sql import functions as F

from tideline.plans import registry
from tideline.plans.ingest import events_spec, ingest
from tideline.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
PURE = ["rollup", "row_disposition", "ingest_meters", "typed_rows", "dedup_message_id", "segment_catalog",
        "metadata_columns", "parse_failure_sample", "message_time_bounds", "gunzip_payload"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PURE)
def test_no_cartesian_or_nested_loop(spark, name):
    p = plan(registry.REGISTRY[name].fn(spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_rollup_and_dedup_aggregate_partially(spark):
    p = plan(registry.REGISTRY["rollup"].fn(spark, SF))
    assert "partial_min_by" in p  # dedup: map-side reduction of re-delivered copies
    assert re.search(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_count", p)  # rollup partial agg


def test_disposition_filter_does_not_repeat_decode(spark):
    rows = ingest(fx.envelopes(spark, SF), events_spec()).rows
    p = plan(rows.filter(F.col("disposition") == "processed").select("messageId", "value"))
    filters = [line for line in p.splitlines() if line.strip().lstrip("+- :").startswith("Filter")]
    assert filters, p
    assert not any("from_json" in line for line in filters), filters


def test_scan_reads_only_needed_columns(spark):
    df = spark.read.parquet(f"{SF}/events.parquet")
    p = plan(registry.REGISTRY["dedup_message_id"].fn(spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in p
    # the ledger read of a landing table prunes the payload column
    from tideline.operators.ledger import ack_ledger
    from tideline.session import scratch_path
    from tideline.sources.landing import read_envelopes

    path = scratch_path(spark, "landing-prune")
    fx.envelopes(spark, SF).write.parquet(path)
    lp = plan(ack_ledger(read_envelopes(spark, path)))
    assert "ReadSchema: struct<ackId:string,messageId:string,publishTime:string>" in lp
    assert df.count() > 0


def test_suspended_spec_plans_no_scan(spark):
    from dataclasses import replace

    from tideline.operators.rows import rows_from_envelopes

    rows = rows_from_envelopes(fx.envelopes(spark, SF), replace(events_spec(), suspended=True))
    assert "FileScan" not in plan(rows)


def test_prior_ledger_read_pushes_publish_time_bound(spark):
    from tideline.session import scratch_path
    from tideline.sinks.segments import write_ledger
    from tideline.operators.ledger import ack_ledger
    from tideline.streaming.ingest import _prior_messages

    path = scratch_path(spark, "ledger-pushdown")
    write_ledger(ack_ledger(fx.envelopes(spark, SF), 0), path)
    prior = _prior_messages(spark, path, 1, "2024-01-10T00:00:00.000000Z")
    p = plan(prior)
    assert "PushedFilters: [Or(GreaterThanOrEqual(publishTime,2024-01-10T00:00:00.000000Z),IsNull(publishTime))]" in p, p
    assert "PartitionFilters: [isnotnull(batch_id" in p and "(batch_id" in p
    assert prior.count() > 0
