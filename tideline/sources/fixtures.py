"""Message envelopes derived from the ``events`` table by fixed rules.

Every rule is plain arithmetic on ``event_id`` (FIXTURES.md section 3), so an
SQL oracle can state the expected answer straight from ``events``.  The
derivation is narrow (project + explode), so it scales with ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import decode as D
from tideline.sources.schema import ENVELOPE_COLUMNS

# The envelope rules (divisors of event_id) and their order.
BAD_JSON_EVERY = 97  # JSON text cut in half
NOT_OBJECT_EVERY = 101  # payload is the array [1,2]
NO_EVENT_TIME_EVERY = 89  # object without "ts"
BAD_EVENT_TIME_EVERY = 83  # "ts" is "not a time"
REDELIVERED_EVERY = 10  # a second copy (delivery 1)
NO_ATTRIBUTES_EVERY = 13  # attributes NULL
RAW_TYPE_EVERY = 4  # payload event_type "raw"
ORIGINS = 5  # origin 'o' || (e % 5)
PUBLISH_DELAY_SECONDS = 7  # publishTime = ts + (e % 7) seconds
BATCH_SIZE = 3  # batch messages: rows of events e with e div 3 = g
NULL_ROW_EVERY = 7  # batch g with g % 7 = 0 carries a trailing null row

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table, in the splits that its files give."""
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _num(c: Column) -> Column:
    return c.cast("string")


def payload_text(ev: DataFrame, with_ts: Column | None = None, event_type: Column | None = None) -> Column:
    """JSON text of one event's payload (key order fixed, value with 2 decimals)."""
    ts_part = F.concat(F.lit('{"ts":"'), with_ts, F.lit('",')) if with_ts is not None else F.lit("{")
    return F.concat(
        ts_part,
        F.lit('"event_id":'),
        _num(F.col("event_id")),
        F.lit(',"user_id":'),
        _num(F.col("user_id")),
        F.lit(',"event_type":"'),
        event_type if event_type is not None else F.col("event_type"),
        F.lit('","value":'),
        F.col("value").cast("decimal(18,2)").cast("string"),
        F.lit(',"props":'),
        F.col("props"),
        F.lit("}"),
    )


def envelope_columns(ev: DataFrame) -> DataFrame:
    """events -> one plain-text envelope per event (delivery 0)."""
    e = F.col("event_id")
    iso = F.date_format(F.col("ts"), ISO_MICROS)
    ptype = F.when(e % RAW_TYPE_EVERY == 0, F.lit("raw")).otherwise(F.col("event_type"))
    full = payload_text(ev, iso, ptype)
    data = (
        F.when(e % BAD_JSON_EVERY == 0, F.substring(full, 1, F.floor(F.length(full) / 2).cast("int")))
        .when(e % NOT_OBJECT_EVERY == 0, F.lit("[1,2]"))
        .when(e % NO_EVENT_TIME_EVERY == 0, payload_text(ev, None, ptype))
        .when(e % BAD_EVENT_TIME_EVERY == 0, payload_text(ev, F.lit("not a time"), ptype))
        .otherwise(full)
    )
    attrs = F.when(
        e % NO_ATTRIBUTES_EVERY != 0,
        F.create_map(
            F.lit("origin"), F.concat(F.lit("o"), _num(e % ORIGINS)), F.lit("event_type"), F.col("event_type")
        ),
    )
    publish = F.date_format(
        F.col("ts") + F.make_dt_interval(secs=(e % PUBLISH_DELAY_SECONDS).cast("decimal(18,6)")), ISO_MICROS
    )
    return ev.select(
        e.alias("event_id"),
        F.concat(F.lit("m"), _num(e)).alias("messageId"),
        publish.alias("publishTime"),
        data.alias("data"),
        attrs.alias("attributes"),
    )


UNREPRESENTABLE_EVERY = 71  # epoch variant: ts = 10^17 ms, beyond any timestamp
UNREPRESENTABLE_MS = "100000000000000000"
LAST_DAY_MS = "253402300799000"  # 9999-12-31T23:59:59Z


def epoch_envelopes(spark: SparkSession, sf_dir: str, last_day_every: int = 0) -> DataFrame:
    """One envelope per event whose payload time is epoch milliseconds.

    ``messageId = 't' || e``; every 71st event carries 10^17 ms, and with
    ``last_day_every`` every so many a time on the last day a timestamp holds.
    """
    ev = read_events(spark, sf_dir)
    e = F.col("event_id")
    ms = F.when(e % UNREPRESENTABLE_EVERY == 0, F.lit(UNREPRESENTABLE_MS))
    if last_day_every:
        ms = ms.when(e % last_day_every == 0, F.lit(LAST_DAY_MS))
    ms = ms.otherwise(_num(F.unix_millis(F.col("ts").cast("timestamp"))))
    body = payload_text(ev, None, F.col("event_type"))
    return ev.select(
        F.concat(F.lit("at"), _num(e)).alias("ackId"),
        F.concat(F.lit("t"), _num(e)).alias("messageId"),
        F.date_format(F.col("ts"), ISO_MICROS).alias("publishTime"),
        F.concat(F.lit('{"ts":'), ms, F.lit(","), F.substring(body, 2, 1 << 30)).alias("data"),
        F.lit(None).cast("map<string,string>").alias("attributes"),
    )


def with_redeliveries(env: DataFrame) -> DataFrame:
    """Add delivery 1 copies for every tenth event; copies differ only in ackId."""
    e = F.col("event_id")
    deliveries = F.when(e % REDELIVERED_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return env.withColumn("delivery", F.explode(deliveries)).withColumn(
        "ackId", F.concat(F.lit("a"), _num(e), F.lit("-"), _num(F.col("delivery")))
    )


def encode_data(env: DataFrame, variant: str) -> DataFrame:
    """plain | base64 | gzip (base64 of gzip) payload variants of the same text."""
    if variant == "plain":
        return env
    raw = F.encode(F.col("data"), "UTF-8")
    if variant == "base64":
        return env.withColumn("data", D.to_base64(raw))
    if variant == "gzip":
        return env.withColumn("data", D.to_base64(D.gzip_bytes(raw)))
    raise ValueError(f"unknown variant {variant!r}")


def envelopes(spark: SparkSession, sf_dir: str, variant: str = "plain", keep_event_id: bool = False) -> DataFrame:
    """All received copies (with redeliveries) as flat envelopes."""
    env = encode_data(with_redeliveries(envelope_columns(read_events(spark, sf_dir))), variant)
    cols = ENVELOPE_COLUMNS + (["event_id", "delivery"] if keep_event_id else [])
    return env.select(*cols)


def _by_k(a: Column, b: Column) -> Column:
    return F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)


def pull_responses(env: DataFrame, per_pull: int = 100, inner_ack_every: int = 3) -> DataFrame:
    """Group envelopes (with ``event_id`` and ``delivery``) into pull responses.

    A pull holds the deliveries of up to ``per_pull`` consecutive events
    (bounded groups).  Every ``inner_ack_every``-th message also carries its
    ackId inside the message; the others only outside.  One extra response
    has no ``receivedMessages`` (an empty pull).
    """
    e = F.col("event_id")
    msg = F.struct(
        F.col("data"),
        F.col("attributes"),
        F.col("messageId"),
        F.col("publishTime"),
        F.when(e % inner_ack_every == 0, F.col("ackId")).alias("ackId"),
    )
    received = F.struct(F.col("ackId"), msg.alias("message"))
    pulls = (
        env.groupBy(F.floor(e / per_pull).alias("pull"), F.col("delivery"))
        .agg(F.array_sort(F.collect_list(F.struct(e.alias("k"), received.alias("r"))), _by_k).alias("items"))
        .select("pull", "delivery", F.transform("items", lambda x: x["r"]).alias("receivedMessages"))
    )
    empty = env.sparkSession.range(1).select(
        F.lit(-1).cast("bigint").alias("pull"),
        F.lit(-1).alias("delivery"),
        F.lit(None).cast(pulls.schema["receivedMessages"].dataType).alias("receivedMessages"),
    )
    return pulls.unionByName(empty)


def batch_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that carry several rows: ``{"rows": [row, row, row(, null)]}``.

    Batch ``g`` holds the events with ``event_id div 3 = g``, in event order;
    batches with ``g % 7 = 0`` end with a null element.  Attributes:
    ``origin = 'o' || (g % 5)``.  Groups are bounded (3 events each).
    """
    ev = read_events(spark, sf_dir)
    e = F.col("event_id")
    row = payload_text(ev, F.date_format(F.col("ts"), ISO_MICROS), F.col("event_type"))
    g = F.floor(e / BATCH_SIZE)
    grouped = ev.groupBy(g.alias("g")).agg(
        F.sort_array(F.collect_list(F.struct(e.alias("k"), row.alias("row"), F.col("ts").alias("ts")))).alias("items"),
    )
    rows_text = F.concat_ws(",", F.transform("items", lambda x: x["row"]))
    rows_text = F.when(F.col("g") % NULL_ROW_EVERY == 0, F.concat(rows_text, F.lit(",null"))).otherwise(rows_text)
    first_ts = F.col("items")[0]["ts"]
    return grouped.select(
        F.concat(F.lit("b"), _num(F.col("g"))).alias("messageId"),
        F.date_format(first_ts, ISO_MICROS).alias("publishTime"),
        F.concat(F.lit('{"rows":['), rows_text, F.lit("]}")).alias("data"),
        F.create_map(F.lit("origin"), F.concat(F.lit("o"), _num(F.col("g") % ORIGINS))).alias("attributes"),
        F.concat(F.lit("ab"), _num(F.col("g"))).alias("ackId"),
    ).select(*ENVELOPE_COLUMNS)
