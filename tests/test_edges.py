"""Messages that are easily lost: several gzip members, missing ids, ids shared
by subscriptions, times without a date, bounds with offsets."""

import gzip
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tideline.functions import decode as D
from tideline.functions import timefns
from tideline.operators.dedup import dedup_messages
from tideline.operators.ledger import pending_redelivery
from tideline.spec import parse_time


def test_gunzip_reads_all_members_and_refuses_the_rest(spark):
    two = gzip.compress(b'{"a":1,') + gzip.compress(b'"b":2}')
    rows = [(0, two), (1, two[:-3]), (2, two + b"junk"), (3, None), (4, gzip.compress(b""))]
    got = spark.createDataFrame(rows, "i int, b binary").select("i", D.gunzip("b").alias("t")).orderBy("i").collect()
    assert [None if r["t"] is None else bytes(r["t"]) for r in got] == [b'{"a":1,"b":2}', None, None, None, b""]


def test_messages_without_id_are_kept(envelopes):
    env = envelopes([{"messageId": None, "ackId": a, "data": "{}"} for a in ("x", "y", "z")] + [{"messageId": "m", "ackId": "p"}, {"messageId": "m", "ackId": "q"}])
    assert dedup_messages(env).count() == 4


def test_ids_belong_to_their_subscription(envelopes):
    env = envelopes([{"messageId": "1", "ackId": "a"}, {"messageId": "1", "ackId": "b"}])
    two = env.withColumn("subscription", F.col("ackId"))
    assert dedup_messages(two).count() == 2 and dedup_messages(two).columns == two.columns
    assert dedup_messages(two.withColumn("subscription", F.lit("s"))).count() == 1
    ledger = two.select(F.lit("a").alias("ackId"), F.lit("b").alias("subscription")).limit(1)
    assert pending_redelivery(two, ledger).count() == 2


@pytest.mark.parametrize("text", ["12:30:00", "T05:00"])
def test_time_without_a_date_is_no_event_time(spark, text):
    ts, err = timefns.parse_event_time(F.col("t"), "auto")
    row = spark.createDataFrame([(text,)], "t string").select(ts.alias("ts"), err.alias("err")).first()
    assert row["ts"] is None and row["err"] == "bad_event_time"


def test_offsets_of_bounds_are_applied():
    assert parse_time("2024-01-05T00:00:00+02:00") == datetime(2024, 1, 4, 22)
    assert parse_time("2024-01-05T00:00:00Z") == parse_time("2024-01-05T00:00:00") == datetime(2024, 1, 5)
