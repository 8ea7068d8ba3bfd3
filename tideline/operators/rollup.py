"""Rollup to (truncated time, dimensions) and the segment catalog.

Both are hash aggregations: Spark plans a partial aggregation per input
task and a final one after the shuffle, so only one row per group and task
crosses the network, whatever the skew of a single group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.timefns import bucket_end, ntz, truncate
from tideline.operators.rows import PROCESSED
from tideline.spec import DataSchema, IngestSpec


def processed(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("disposition") == PROCESSED)


def with_query_time(rows: DataFrame, granularity: str, name: str = "t") -> DataFrame:
    """Add the event time truncated to the query granularity (TIMESTAMP_NTZ)."""
    return rows.withColumn(name, ntz(truncate(F.col("ts").cast("timestamp"), granularity)))


def metric_aggs(metrics) -> list:
    aggs = [F.count(F.lit(1)).alias("rows")]
    for m in metrics:
        prefix = m
        aggs += [
            F.sum(m).alias(f"{prefix}_sum"),
            F.min(m).alias(f"{prefix}_min"),
            F.max(m).alias(f"{prefix}_max"),
        ]
    return aggs


#: What the last part of a submitted aggregator's type computes.
AGGREGATES = {"sum": F.sum, "min": F.min, "max": F.max}


def rollup_aggs(ds: DataSchema) -> list:
    """The aggregators of the spec's ``metricsSpec``; without one, the row count
    and the sum, minimum and maximum of every metric."""
    if not ds.aggregators:
        return metric_aggs(ds.metrics)
    return [F.count(F.lit(1)).alias(a.name) if a.kind == "count" else AGGREGATES[a.kind](a.field).alias(a.name) for a in ds.aggregators]


def merge_aggs(ds: DataSchema) -> list:
    """Aggregates of partial rollups that give those of all their rows."""
    if not ds.aggregators:
        names = [("rows", F.sum)] + [(f"{m}_{kind}", AGGREGATES[kind]) for m in ds.metrics for kind in ("sum", "min", "max")]
    else:
        names = [(a.name, F.sum if a.kind == "count" else AGGREGATES[a.kind]) for a in ds.aggregators]
    return [f(name).alias(name) for name, f in names]


def rollup(rows: DataFrame, spec: IngestSpec, dimensions=None, granularity: str | None = None) -> DataFrame:
    """``groupBy(t, *dims)`` with the spec's aggregators, processed rows only;
    granularity ``none`` keeps the event time as it is."""
    ds = spec.data_schema
    dims = list(ds.dimensions if dimensions is None else dimensions)
    g = granularity or ds.query_granularity
    return with_query_time(processed(rows), g).groupBy("t", *dims).agg(*rollup_aggs(ds))


def segment_catalog(rows: DataFrame, spec: IngestSpec) -> DataFrame:
    """One row per segment: bounds, row count, event-time range, files expected."""
    limit = spec.tuning.max_rows_per_segment
    g = spec.data_schema.segment_granularity
    return (
        processed(rows)
        .groupBy("segment_start")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"))
        .select(
            "segment_start",
            ntz(bucket_end(F.col("segment_start").cast("timestamp"), g)).alias("segment_end"),
            "rows",
            "min_ts",
            "max_ts",
            F.ceil(F.col("rows") / F.lit(limit)).cast("bigint").alias("files_expected"),
        )
    )


def tumbling_windows(rows: DataFrame, size: str = "1 day") -> DataFrame:
    """Fixed event-time buckets with ``window()`` (rows with NULL time are not processed rows)."""
    w = F.window(F.col("ts").cast("timestamp"), size)
    return (
        processed(rows)
        .groupBy(w.alias("w"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(ntz(F.col("w.start")).alias("window_start"), ntz(F.col("w.end")).alias("window_end"), "rows")
    )
