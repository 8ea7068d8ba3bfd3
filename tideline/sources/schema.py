"""Declared schemas of the landing formats (no inference anywhere)."""

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [
        T.StructField("data", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("messageId", T.StringType()),
        T.StructField("publishTime", T.StringType()),
        T.StructField("ackId", T.StringType()),
    ]
)

RECEIVED = T.StructType([T.StructField("ackId", T.StringType()), T.StructField("message", MESSAGE)])

# One pull response per JSON line: {"receivedMessages": [{ackId, message}, ...]}
PULL = T.StructType([T.StructField("receivedMessages", T.ArrayType(RECEIVED))])

# Flat envelope: the landing-table layout every reader produces.
ENVELOPE = T.StructType(
    [
        T.StructField("ackId", T.StringType()),
        T.StructField("messageId", T.StringType()),
        T.StructField("publishTime", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ]
)

ENVELOPE_COLUMNS = [f.name for f in ENVELOPE.fields]
