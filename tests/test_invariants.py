"""Invariants of SURVEY section 5: accounting, order / duplication, ledger."""

from pyspark.sql import functions as F

from tideline.operators.ledger import pending_redelivery
from tideline.operators.meters import ingest_meters
from tideline.plans.ingest import events_spec, ingest
from tideline.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
COLS = ["messageId", "pos", "ts", "event_type", "origin", "value", "disposition", "reason"]


def test_meters_add_up_to_distinct_messages(spark):
    env = fx.envelopes(spark, SF)
    rows = ingest(env, events_spec()).rows
    m = ingest_meters(rows, events_spec()).first()
    assert m["processed"] + m["unparseable"] + m["thrown_away"] == env.select("messageId").distinct().count()


def test_reordering_and_redelivery_change_nothing(spark):
    env = fx.envelopes(spark, SF)
    base = ingest(env, events_spec()).rows.select(COLS)
    # every message delivered once more under a new ackId, input shuffled
    again = env.withColumn("ackId", F.concat(F.col("ackId"), F.lit("-again")))
    noisy = env.unionByName(again).repartition(5).orderBy(F.rand(7))
    got = ingest(noisy, events_spec()).rows.select(COLS)
    assert got.exceptAll(base).isEmpty() and base.exceptAll(got).isEmpty()


def test_ledger_and_pending_cover_the_landing(spark):
    env = fx.envelopes(spark, SF)
    first = env.filter(F.col("publishTime") < "2024-01-15")
    ledger = ingest(first, events_spec()).ledger
    pending = pending_redelivery(env, ledger)
    union = ledger.select("ackId").unionByName(pending.select("ackId"))
    assert union.count() == env.count()
    assert union.exceptAll(env.select("ackId")).isEmpty()
    assert ledger.join(pending, "ackId").isEmpty()


def test_earliest_copy_wins(spark, envelopes):
    data_a = '{"ts":"2024-01-10T00:00:00Z","value":1}'
    data_b = '{"ts":"2024-01-10T00:00:00Z","value":2}'
    env = envelopes(
        [
            {"ackId": "z", "messageId": "m", "publishTime": "2024-01-10T00:00:01.000000Z", "data": data_b},
            {"ackId": "y", "messageId": "m", "publishTime": "2024-01-10T00:00:00.000000Z", "data": data_a},
            {"ackId": "x", "messageId": "m", "publishTime": "2024-01-10T00:00:01.000000Z", "data": data_b},
        ]
    )
    rows = ingest(env, events_spec(minimum_message_time=None, maximum_message_time=None)).rows.collect()
    assert len(rows) == 1 and rows[0]["value"] == 1.0
