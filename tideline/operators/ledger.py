"""Acknowledgement ledger and the messages still waiting for one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ack_ledger(env: DataFrame, batch_id: int | Column = 0) -> DataFrame:
    """Every received copy (its own ackId) of a batch; narrow, no shuffle.

    Ack ids belong to a subscription, so a ``subscription`` label is kept
    when several subscriptions feed one table.
    """
    b = batch_id if isinstance(batch_id, Column) else F.lit(int(batch_id))
    label = ["subscription"] if "subscription" in env.columns else []
    return env.select("ackId", "messageId", "publishTime", *label, b.cast("bigint").alias("batch_id"))


def pending_redelivery(landing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Landed copies whose ackId is not in the ledger: they will come back.  Ack
    ids are compared within their subscription where both sides name it."""
    both = "subscription" in landing.columns and "subscription" in ledger.columns
    key = ["subscription", "ackId"] if both else ["ackId"]
    return landing.join(ledger.select(*key), key, "left_anti").select(*landing.columns)
