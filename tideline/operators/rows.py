"""Envelope -> typed rows with a disposition (processed / unparseable / thrown away).

``decode`` to ``classify`` is one narrow stage: no shuffle, all built-in
expressions except the optional gunzip.  Reasons are evaluated in the fixed
order of SURVEY 2.9; the first match wins.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import decode as D
from tideline.functions.timefns import MAX_REPRESENTABLE_US, bucket_end, ntz, truncate, with_event_time
from tideline.spec import IngestSpec, SpecError

PROCESSED = "processed"
UNPARSEABLE = "unparseable"
THROWN_AWAY = "thrown_away"

ROW_MAP = "_row"  # merged map of one row (internal column)


def decode_payload(env: DataFrame, spec: IngestSpec) -> DataFrame:
    """Add ``payload`` (text) and ``decode_error`` to an envelope frame.

    base64 (public REST format) -> optional gunzip -> UTF-8 check.
    """
    io = spec.io_config
    data = F.col("data")
    err = F.when(data.isNull(), F.lit("missing_payload"))
    if io.payload_encoding == "base64":
        raw = D.from_base64(data)
        err = err.when(raw.isNull(), F.lit("bad_base64"))
    elif io.decompress_data:
        raw = F.encode(data, "UTF-8")
    else:
        raw = None
    if io.decompress_data:
        raw = D.gunzip(raw)
        err = err.when(raw.isNull(), F.lit("bad_gzip"))
    text = data if raw is None else D.utf8_text(raw)
    if raw is not None:
        err = err.when(text.isNull(), F.lit("bad_utf8"))
    return env.withColumn("payload", text).withColumn("decode_error", err)


def parse_payload(df: DataFrame) -> DataFrame:
    """Add ``payload_map`` (object as map) and ``parse_error``."""
    return (
        df.withColumn("_json", D.json_map(F.col("payload")))  # a column of its own: parsed once
        .withColumn("payload_map", D.last_wins(F.col("_json")))
        .drop("_json")
        .withColumn(
            "parse_error",
            F.when(F.col("payload").isNotNull(), D.parse_error(F.col("payload"), F.col("payload_map"))),
        )
    )


def merge(df: DataFrame) -> DataFrame:
    """Add ``merged``: payload ∪ attributes, attributes win."""
    return df.withColumn("merged", D.merge_attributes(F.col("payload_map"), F.col("attributes")))


def _field_value(row: Column, path: str, type_: str) -> tuple[Column, Column]:
    """Value of a declared field from the row map, plus the raw text."""
    head, _, rest = path.partition(".")
    raw = row[head]
    if rest:
        raw = F.get_json_object(raw, "$." + rest)
    return raw.try_cast(type_), raw


def _row_struct(row: Column, spec: IngestSpec, elem_error: Column | None = None, null_row: Column | None = None) -> Column:
    """One row before the generator: its map, event time and row error.

    Event time (``with_event_time``) and the row error are computed below the
    generator, so every later filter on the disposition reads plain generated
    columns instead of re-parsing the time inside its condition.
    """
    ds = spec.data_schema
    err = F.col("time_error")
    for f in ds.fields:
        if f.role == "metric":
            value, raw = _field_value(row, f.source, f.type)
            err = F.coalesce(err, F.when(raw.isNotNull() & value.isNull(), F.lit("bad_metric")))
    return F.struct(
        row.alias(ROW_MAP),
        F.col("event_time"),
        F.when(row.isNotNull(), err).alias("row_error"),
        (elem_error if elem_error is not None else F.lit(None).cast("string")).alias("elem_error"),
        (null_row if null_row is not None else F.lit(False)).alias("null_row"),
    )


def explode_rows(df: DataFrame, spec: IngestSpec) -> DataFrame:
    """One message -> one or more rows, keyed by ``(messageId, pos)``.

    With ``rows_field`` set, the merged object carries an array of row
    objects; every element is merged with the attributes (attributes win).
    A NULL element is a null row (thrown away); a message whose rows field is
    missing or not an array keeps one row with ``rows_error``.

    Single-row messages go through the generator as well.  A filter on the
    disposition stops at the Generate node, so the JSON decode and the time
    parse below it run once per row, never again inside the filter.
    """
    rows_field, time_column, time_format = spec.data_schema.rows_field, spec.data_schema.timestamp_column, spec.data_schema.timestamp_format
    if not rows_field:
        elems = F.array(_row_struct(F.col("merged"), spec))
        msg_error = F.lit(None).cast("string")
        out = with_event_time(df, F.col("merged")[time_column], time_format).select("*", F.posexplode(elems).alias("pos", "_e"))
    else:
        arr = F.from_json(F.col("merged")[rows_field], "array<string>")
        attrs = F.col("attributes")

        # Elements are exploded as text and parsed below the generator, once
        # a row; an empty array has no row.
        with_arr = df.withColumn("_rows", arr)
        msg_error = F.when(F.col("merged").isNotNull() & F.col("_rows").isNull(), F.lit("bad_rows_field"))
        elements = (
            with_arr.withColumn("_msg_error", msg_error)
            .filter(F.col("_rows").isNull() | (F.size("_rows") > 0))
            .select("*", F.posexplode_outer("_rows").alias("pos", "_text"))
            .drop("_rows")
            .select("*", F.explode(F.array(D.parse_object(F.col("_text")))).alias("_parsed"))
        )
        text, parsed = F.col("_text"), F.col("_parsed")
        elements = with_event_time(elements.withColumn("_element", D.merge_attributes(parsed, attrs)), F.col("_element")[time_column], time_format)
        row = _row_struct(
            F.col("_element"),
            spec,
            elem_error=F.when(text.isNotNull() & parsed.isNull(), F.lit("not_object")),
            null_row=text.isNull(),
        )
        out = elements.select("*", F.explode(F.array(F.when(F.col("pos").isNotNull(), row))).alias("_e")).drop("_text", "_parsed", "_element")
        msg_error = F.col("_msg_error")
    return (
        out.withColumn("pos", F.coalesce(F.col("pos"), F.lit(0)))
        .withColumn(ROW_MAP, F.col("_e")[ROW_MAP])
        .withColumn("event_time", F.col("_e.event_time"))
        .withColumn("row_error", F.col("_e.row_error"))
        .withColumn("rows_error", F.coalesce(msg_error, F.col("_e.elem_error")))
        .withColumn("null_row", F.coalesce(F.col("_e.null_row"), F.lit(False)))
        .drop("_e", "_msg_error", "time_error")
    )


def typed_rows(df: DataFrame, spec: IngestSpec) -> DataFrame:
    """Add the declared columns (typed with ``try_cast``) from the row map."""
    row = F.col(ROW_MAP)
    out = df
    for f in spec.data_schema.fields:
        out = out.withColumn(f.name, _field_value(row, f.source, f.type)[0])
    return out


def _lit_ts(t: datetime) -> Column:
    return F.lit(t.isoformat(sep=" ")).cast("timestamp")


def time_filter_reason(spec: IngestSpec, ts: Column) -> Column:
    """Why a parsed row is thrown away by time, or NULL to keep it.

    Bounds are inclusive at both ends and each optional; late / early
    rejection is relative to an explicit reference time.
    """
    io = spec.io_config
    reason = F.lit(None).cast("string")
    cases = []
    if io.batch_clock and (io.late_message_rejection_period or io.early_message_rejection_period):
        raise SpecError("the reference time of a batch is set by process_batch")
    if io.minimum_message_time is not None:
        cases.append((ts < _lit_ts(io.minimum_message_time), "before_minimum_time"))
    if io.maximum_message_time is not None:
        cases.append((ts > _lit_ts(io.maximum_message_time), "after_maximum_time"))
    if io.late_message_rejection_period is not None:
        cases.append((ts < _lit_ts(io.reference_time - io.late_message_rejection_period), "too_late"))
    if io.early_message_rejection_period is not None:
        cases.append((ts > _lit_ts(io.reference_time + io.early_message_rejection_period), "too_early"))
    if cases:
        expr = F.when(cases[0][0], F.lit(cases[0][1]))
        for cond, name in cases[1:]:
            expr = expr.when(cond, F.lit(name))
        reason = expr
    return reason


def classify(df: DataFrame, spec: IngestSpec) -> DataFrame:
    """Add ``disposition`` and ``reason`` (first match wins), plus the segment."""
    unparseable = F.coalesce(
        F.col("decode_error"), F.col("parse_error"), F.col("rows_error"), F.col("row_error")
    )
    ts = F.col("event_time")
    thrown = F.when(F.col("null_row"), F.lit("null_row")).otherwise(time_filter_reason(spec, ts))
    seg_start = truncate(ts, spec.data_schema.segment_granularity)
    out = (
        df.withColumn(
            "disposition",
            F.when(unparseable.isNotNull(), F.lit(UNPARSEABLE))
            .when(thrown.isNotNull(), F.lit(THROWN_AWAY))
            .otherwise(F.lit(PROCESSED)),
        )
        .withColumn("reason", F.coalesce(unparseable, thrown))
        .withColumn("segment_start", F.when(F.col("disposition") == PROCESSED, seg_start))
    )
    # A processed row must land in a segment whose both ends a timestamp can hold;
    # without one it is an error naming its time (strict) or an unparseable row.
    out = out.withColumn("_segment_end", bucket_end(F.col("segment_start"), spec.data_schema.segment_granularity))
    beyond = F.unix_micros(F.col("_segment_end")) > MAX_REPRESENTABLE_US
    no_segment = (F.col("disposition") == PROCESSED) & (F.col("segment_start").isNull() | beyond)
    if spec.tuning.strict_segments:
        out = out.withColumn(
            "segment_start",
            F.when(
                no_segment,
                F.raise_error(
                    F.concat(
                        F.lit("cannot allocate a segment for message "),
                        F.coalesce(F.col("messageId"), F.lit("without id")),
                        F.lit(" with timestamp "),
                        F.coalesce(ts.cast("string"), F.lit("null")),
                    )
                ),
            ).otherwise(F.col("segment_start")),
        )
    else:
        out = out.withColumn("reason", F.when(no_segment, F.lit("unallocatable")).otherwise(F.col("reason")))
        out = out.withColumn("disposition", F.when(no_segment, F.lit(UNPARSEABLE)).otherwise(F.col("disposition")))
        out = out.withColumn("segment_start", F.when(F.col("disposition") == PROCESSED, F.col("segment_start")))
    return out


def rows_from_envelopes(env: DataFrame, spec: IngestSpec, batch_id: int | Column = 0) -> DataFrame:
    """Deduplicated envelopes -> classified, typed rows (one narrow stage).

    Output: ``messageId, pos, publishTime, ts (timestamp_ntz), <declared
    fields>, disposition, reason, segment_start, segment_end, batch_id`` and
    ``data`` (kept for unparseable rows only, for the quarantine).
    """
    if spec.suspended:
        # Catalyst folds this into an empty relation: nothing is read.
        env = env.filter(F.lit(False))
    df = decode_payload(env, spec)
    df = parse_payload(df)
    df = merge(df)
    df = explode_rows(df, spec)
    df = typed_rows(df, spec)
    df = classify(df, spec)
    ds = spec.data_schema
    seg = F.col("segment_start")
    label = ["subscription"] if "subscription" in env.columns else []
    return df.select(
        *label,
        "messageId",
        F.col("pos").cast("int").alias("pos"),
        "publishTime",
        ntz(F.col("event_time")).alias("ts"),
        *[F.col(f.name) for f in ds.fields],
        "disposition",
        "reason",
        ntz(seg).alias("segment_start"),
        ntz(F.when(seg.isNotNull(), F.col("_segment_end"))).alias("segment_end"),
        (batch_id if isinstance(batch_id, Column) else F.lit(int(batch_id))).cast("bigint").alias("batch_id"),
        F.when(F.col("disposition") == UNPARSEABLE, F.col("data")).alias("data"),
    )
