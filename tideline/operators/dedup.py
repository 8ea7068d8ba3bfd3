"""Remove re-delivered copies of a message (at-least-once delivery).

Batch form: one aggregation keyed by ``messageId`` that keeps the copy with
the smallest ``(publishTime, ackId)``, an explicit and deterministic
tie-break.  ``min_by`` is aggregated partially on the map side, so a message
delivered millions of times is first reduced to one copy per input task
before the shuffle: a hot message id cannot pile up in one reducer.

Stream form: ``dropDuplicatesWithinWatermark`` on the publish time, which is
the same on every copy, so the state is bounded by the watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.sources.schema import ENVELOPE_COLUMNS


def dedup_messages(env: DataFrame, within: tuple[str, ...] = (), keep_key: bool = False) -> DataFrame:
    """One envelope per ``messageId`` (batch), within its ``subscription`` where
    there is such a label: ids of different subscriptions are unrelated.  With
    ``within`` (columns), one for each of their values.  ``keep_key`` keeps the
    key ``_key`` that the result is shuffled by: the id where there is one.

    A message without an id is a message of its own, told apart by its ackId
    (or, without one, by its content).  Other labels travel with the winner.
    """
    scope = [*(["subscription"] if "subscription" in env.columns else []), *within]
    other = [c for c in [*ENVELOPE_COLUMNS, *env.columns] if c not in scope]
    other = list(dict.fromkeys(other))
    winner = F.min_by(F.struct(*other), F.struct("publishTime", "ackId")).alias("w")
    # one key: the id, or what stands for it behind a character that no id begins with
    key = F.coalesce("messageId", F.concat(F.lit("\u0000"), without_id(env)))
    out = env.groupBy(*scope, key.alias("_key")).agg(winner)
    labels = [c for c in env.columns if c not in ENVELOPE_COLUMNS]
    cols = {c: F.col(f"w.{c}").alias(c) for c in other} | {c: F.col(c) for c in scope}
    return out.select(*(cols[c] for c in [*ENVELOPE_COLUMNS, *labels]), *(["_key"] if keep_key else []))


def without_id(env: DataFrame) -> Column:
    """What tells messages without an id apart; NULL where there is an id."""
    content = F.sha2(F.concat_ws("|", F.col("publishTime"), F.col("data").cast("string")), 256)
    return F.when(F.col("messageId").isNull(), F.coalesce(F.col("ackId"), content))


def publish_ts(env: DataFrame) -> DataFrame:
    """Add ``publish_ts`` (TIMESTAMP) parsed from the envelope's ISO text."""
    return env.withColumn("publish_ts", F.try_to_timestamp(F.col("publishTime")))


def dedup_stream(env: DataFrame, delay: str = "1 day") -> DataFrame:
    """Streaming dedup by ``messageId`` with state bounded by a publish-time watermark."""
    scope = ["subscription"] if "subscription" in env.columns else []
    return (
        publish_ts(env)
        .withColumn("_without_id", without_id(env))
        .withWatermark("publish_ts", delay)
        .dropDuplicatesWithinWatermark([*scope, "messageId", "_without_id"])
        .drop("publish_ts", "_without_id")
    )
