"""Event-time parsing and bucketing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.spec import CALENDAR_GRANULARITIES, FIXED_GRANULARITIES, SpecError

# The instants a Spark timestamp can hold, as epoch microseconds
# (0001-01-01T00:00:00Z and 9999-12-31T23:59:59.999999Z).
MIN_REPRESENTABLE_US = -62135596800000000
MAX_REPRESENTABLE_US = 253402300799999999

# Microseconds per unit of each numeric time format.
MICROS_PER_UNIT = {"millis": 1000, "seconds": 1000000, "posix": 1000000, "micros": 1}

NUMERIC_FORMATS = ("auto", "millis", "seconds", "posix", "micros")


def parse_event_time(raw: Column, fmt: str = "auto") -> tuple[Column, Column]:
    """Event-time text -> (timestamp, error reason).

    ``auto``: ISO-8601 text, or a bare number read as epoch milliseconds.
    ``iso`` / ``millis`` / ``seconds`` / ``posix`` / ``micros``, or a datetime
    pattern.  A numeric time outside what a timestamp can hold is
    ``unrepresentable_time``; text that does not parse is ``bad_event_time``.
    """
    num = _number(raw)
    ts = _time(raw, num, fmt)
    return ts, _time_error(raw, num, ts, fmt)


def with_event_time(df: DataFrame, raw: Column, fmt: str = "auto") -> DataFrame:
    """Add ``event_time`` and ``time_error`` as ``parse_event_time`` gives them.  The
    number and the time are columns of their own, so each is parsed once a row."""
    num, ts = F.col("_time_number"), F.col("event_time")
    out = df.withColumn("_time_text", raw)
    out = out.withColumn("_time_number", _number(F.col("_time_text")))
    out = out.withColumn("event_time", _time(F.col("_time_text"), num, fmt))
    out = out.withColumn("time_error", _time_error(F.col("_time_text"), num, ts, fmt))
    return out.drop("_time_text", "_time_number")


def _numeric(fmt: str) -> str | None:
    key = fmt.lower() if fmt else "auto"
    return key if key in NUMERIC_FORMATS else None


def _number(raw: Column) -> Column:
    """The number that a text is, or NULL.  Text with a colon is none, and need not
    fail as a number first (the cast pays for an exception)."""
    return F.when(~F.contains(raw, F.lit(":")), raw.try_cast("decimal(38,6)"))


def _micros(num: Column, key: str) -> tuple[Column, Column]:
    """Epoch microseconds of a number, and whether a timestamp holds them."""
    us = F.floor(F.try_multiply(num, F.lit(MICROS_PER_UNIT["millis" if key == "auto" else key])))
    return us, us.between(F.lit(MIN_REPRESENTABLE_US), F.lit(MAX_REPRESENTABLE_US))


def _time(raw: Column, num: Column, fmt: str) -> Column:
    key = _numeric(fmt)
    if key is None:
        return _dated(raw) if fmt.lower() == "iso" else F.try_to_timestamp(raw, F.lit(fmt))
    us, in_range = _micros(num, key)
    ts = F.when(in_range, F.timestamp_micros(us.try_cast("bigint")))
    return F.when(num.isNull(), _dated(raw)).otherwise(ts) if key == "auto" else ts


def _time_error(raw: Column, num: Column, ts: Column, fmt: str) -> Column:
    err, key = F.when(raw.isNull(), F.lit("no_event_time")), _numeric(fmt)
    if key is not None:
        in_range = _micros(num, key)[1]
        err = err.when(num.isNotNull() & ~F.coalesce(in_range, F.lit(False)), F.lit("unrepresentable_time"))
    return err.when(ts.isNull(), F.lit("bad_event_time"))


def _dated(raw: Column) -> Column:
    """ISO text -> TIMESTAMP; NULL for a time without a date, which the cast
    would place on the current day."""
    return F.when(raw.rlike(r"^\s*[+-]?\d{4,}"), F.try_to_timestamp(raw))


def truncate(ts: Column, granularity: str) -> Column:
    """Floor an event time (TIMESTAMP) to a granularity; ``none`` keeps it."""
    g = granularity.lower()
    if g == "none":
        return ts
    if g in CALENDAR_GRANULARITIES:
        return F.date_trunc(g, ts)
    if g in FIXED_GRANULARITIES:
        step = FIXED_GRANULARITIES[g] * 1_000_000
        return F.timestamp_micros(F.floor(F.unix_micros(ts) / step) * step)
    raise SpecError(f"unknown granularity {granularity!r}")


def bucket_end(start: Column, granularity: str) -> Column:
    """Exclusive end of the bucket starting at ``start``."""
    g = granularity.lower()
    if g in FIXED_GRANULARITIES:
        return start + F.make_dt_interval(secs=F.lit(FIXED_GRANULARITIES[g]))
    one = {
        "second": "INTERVAL 1 SECOND",
        "minute": "INTERVAL 1 MINUTE",
        "hour": "INTERVAL 1 HOUR",
        "day": "INTERVAL 1 DAY",
        "week": "INTERVAL 7 DAYS",
        "month": "INTERVAL 1 MONTH",
        "quarter": "INTERVAL 3 MONTHS",
        "year": "INTERVAL 1 YEAR",
    }
    if g not in one:
        raise SpecError(f"unknown granularity {granularity!r}")
    return start + F.expr(one[g])


def ntz(ts: Column) -> Column:
    """TIMESTAMP (UTC session) -> TIMESTAMP_NTZ, the type of the source tables."""
    return ts.cast("timestamp_ntz")


def bucket_end_value(start, granularity: str):
    """Python twin of ``bucket_end`` for driver-side segment bookkeeping."""
    from datetime import timedelta

    g = granularity.lower()
    if g in FIXED_GRANULARITIES:
        return start + timedelta(seconds=FIXED_GRANULARITIES[g])
    fixed = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400}
    if g in fixed:
        return start + timedelta(seconds=fixed[g])
    months = {"month": 1, "quarter": 3, "year": 12}[g]
    m = start.month - 1 + months
    return start.replace(year=start.year + m // 12, month=m % 12 + 1)
