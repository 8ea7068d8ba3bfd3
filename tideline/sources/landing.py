"""Landing readers: pull responses and envelope tables, batch or stream.

The message log has no offsets, so messages are landed as files first; the
file source then gives Spark replayable offsets (file names) and admission
control (``maxFilesPerTrigger`` / ``maxBytesPerTrigger``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.sources.schema import ENVELOPE, ENVELOPE_COLUMNS, PULL


def unnest_pull(pulls: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Pull responses -> one envelope per received message (and the ``labels``
    columns of its response).

    A response without ``receivedMessages`` gives zero rows.  The outer
    ``ackId`` is copied onto the message when the message has none.  A response
    that is no JSON (column ``_unreadable``, see ``read_pull_responses``) gives
    one message without id whose payload is its text, which is then counted as a
    parse failure.
    """
    received, broken = F.col("receivedMessages"), F.lit(None).cast("string")
    if UNREADABLE in pulls.columns:
        broken = F.col(UNREADABLE)
        none = F.array(F.lit(None).cast(PULL["receivedMessages"].dataType.elementType))
        received = F.when(broken.isNotNull(), none).otherwise(received)
    r = pulls.select(broken.alias("broken"), *(labels or []), F.explode(received).alias("r"))
    return r.select(
        F.coalesce(F.col("r.message.ackId"), F.col("r.ackId")).alias("ackId"),
        F.col("r.message.messageId").alias("messageId"),
        F.col("r.message.publishTime").alias("publishTime"),
        F.coalesce(F.col("broken"), F.col("r.message.data")).alias("data"),
        F.col("r.message.attributes").alias("attributes"),
        *(labels or []),
    )


UNREADABLE = "_unreadable"


def pull_reader(reader, multi_line: bool):
    schema = T.StructType([*PULL.fields, T.StructField(UNREADABLE, T.StringType())])
    return reader.schema(schema).option("columnNameOfCorruptRecord", UNREADABLE).option("multiLine", multi_line)


def read_pull_responses(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Batch read of pull responses, flattened to envelopes: one response a line,
    or with ``multi_line`` one (pretty-printed) response or array of them a file."""
    return unnest_pull(pull_reader(spark.read, multi_line).json(path))


def read_envelopes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Batch read of a flat envelope landing table (Parquet or JSON lines)."""
    return spark.read.schema(ENVELOPE).format(fmt).load(path).select(*ENVELOPE_COLUMNS)


def stream_envelopes(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming read of an envelope landing folder with admission control.

    ``max_files_per_trigger`` bounds messages per micro-batch when every
    landing file holds at most ``maxMessagesPerPoll`` messages;
    ``max_bytes_per_trigger`` is the byte-size bound.
    """
    reader = spark.readStream.schema(ENVELOPE).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    return reader.load(path).select(*ENVELOPE_COLUMNS)


def stream_pull_responses(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    reader = pull_reader(spark.readStream, multi_line).format("json")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    return unnest_pull(reader.load(path))


#: Bytes of a row group of a landed Parquet file: a poll may be one file, and a
#: file is read by as many tasks as it has row groups.
ROW_GROUP_BYTES = 8 << 20


def land_envelopes(env: DataFrame, path: str, max_messages_per_file: int = 0, fmt: str = "parquet") -> None:
    """Append envelopes to a landing folder; files hold at most
    ``max_messages_per_file`` messages (``maxMessagesPerPoll``), so one file
    per trigger bounds a micro-batch by messages."""
    w = env.select(*ENVELOPE_COLUMNS).write.mode("append").option("parquet.block.size", ROW_GROUP_BYTES).format(fmt)
    if max_messages_per_file:
        w = w.option("maxRecordsPerFile", int(max_messages_per_file))
    w.save(path)


def union_subscriptions(sources: dict[str, DataFrame]) -> DataFrame:
    """Several subscriptions feeding one table: label each, union by name."""
    labelled = [df.withColumn("subscription", F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b), labelled)
