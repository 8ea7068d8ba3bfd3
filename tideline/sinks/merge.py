"""Merging of small files: every micro-batch writes files of its own, so a segment
(and a day of the ledger) gathers many small ones.

A merge takes the files of a group (segment and disposition, or publish day) that
hold fewer than ``limit`` rows and writes their rows anew in files of exactly
``limit`` rows and one rest.  A row's file follows from its place: the rows of the
files before it (prefix sums of file statistics) and its number in its own file.
Groups of ``limit`` rows are dealt out, so a hot segment is written by many tasks.

Merged files lie under ``batch_id=-K`` of the ``K``-th merge, and each row keeps
the number of its batch (``from_batch``); readers see that one.  The swap goes
through the journal of the purge, so a merge that was cut off goes on.  Between
its steps a reader may miss rows that are about to come back, as in a purge.

Streamed rollups are unaware: they take merged files only of merges older than
their checkpoint, and a merge leaves the batches alone that a registered rollup
has not drained (``rollup_drained``) and the last one, which may be replayed.
"""

from __future__ import annotations

import hashlib
import json
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.sinks.segments import (
    LEDGER_SCHEMA,
    PURGE_JOURNAL,
    STAGING,
    commit_ids,
    delete_path,
    finish_publishes,
    finish_purge,
    list_files,
    path_exists,
    plain_path,
    read_generation,
    read_text,
    rows_schema,
    write_record,
    write_text,
)
from tideline.spec import IngestSpec


def merges(spark: SparkSession, root: str) -> int:
    """How many merges a table has had."""
    return int(read_text(spark, f"{root}/_merges") or 0)


# -- rollups that read the table as a stream ---------------------------------------


def _reader(table: str, checkpoint: str) -> str:
    return f"{table}/_readers/{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}.json"


def register_rollup(spark: SparkSession, table: str, checkpoint: str) -> int:
    """Note a streamed rollup of the table; the merges that it starts from."""
    text = read_text(spark, _reader(table, checkpoint))
    if text is None:
        record = {"checkpoint": checkpoint, "merges": merges(spark, table), "drained": -1}
        write_record(spark, _reader(table, checkpoint), record)
        return record["merges"]
    return json.loads(text)["merges"]


def rollup_drained(spark: SparkSession, table: str, checkpoint: str, batch_id: int) -> None:
    """Note that a rollup has read all batches up to this one."""
    record = json.loads(read_text(spark, _reader(table, checkpoint)))
    write_record(spark, _reader(table, checkpoint), record | {"drained": max(int(batch_id), record["drained"])})


def forget_rollup(spark: SparkSession, table: str, checkpoint: str) -> None:
    """A rollup that will not go on no longer holds merges back."""
    delete_path(spark, _reader(table, checkpoint))


def mergeable(spark: SparkSession, table: str) -> int:
    """The last batch that may be merged (-1: none)."""
    done = commit_ids(spark, table)
    drained = [json.loads(read_text(spark, f"{table}/_readers/{name}"))["drained"] for name, _ in list_files(spark, f"{table}/_readers")]
    return min([done[-2] if len(done) > 1 else -1, *drained])


# -- merging -------------------------------------------------------------------------


def _merge(spark: SparkSession, root: str, schema, group: list[str], layout: list[str], limit: int, upto: int) -> int:
    """Merge the small files of ``root`` by ``group``; how many files went."""
    raw = spark.read.schema(schema).parquet(root).filter(F.col("batch_id") <= upto)
    path = F.col("_metadata.file_path")
    sizes = raw.groupBy(path.alias("path"), *group).agg(F.count(F.lit(1)).alias("n"))
    folder = F.expr("left(path, length(path) - length(substring_index(path, '/', -1)) - 1)")
    sizes = sizes.withColumn("full", F.count_if(F.col("n") >= limit).over(Window.partitionBy(folder)))
    own = Window.partitionBy(*group).orderBy("path")
    small = sizes.filter(F.col("n") < limit).withColumn("first", F.sum("n").over(own) - F.col("n")).withColumn("files", F.count(F.lit(1)).over(Window.partitionBy(*group)))
    todo = small.filter(F.col("files") > 1).select("path", "first", "full").toPandas()  # file statistics, a row a file
    if not len(todo):
        return 0
    whole = sorted({uri.rpartition("/")[0] for uri in todo["path"][todo["full"] == 0]})  # folders that go with all their files
    gone = [plain_path(spark, uri) for uri in [*whole, *todo["path"][todo["full"] > 0]]]
    files = _plain_paths(spark, todo["path"])
    todo = todo[["path", "first"]]
    number = merges(spark, root) + 1
    staging = f"{root}/{STAGING}/purge"
    delete_path(spark, staging)
    rows = spark.read.schema(schema).option("basePath", root).parquet(*files).select("*", path.alias("_path"), F.col("_metadata.row_index").alias("_row"))
    place = rows.join(spark.createDataFrame(todo).withColumnsRenamed({"path": "_path"}), "_path")
    place = place.withColumn("_file", F.floor((F.col("first") + F.col("_row")) / limit))
    merged = place.withColumn("from_batch", F.coalesce("from_batch", "batch_id")).withColumn("batch_id", F.lit(-number).cast("bigint")).drop("_path", "_row", "first")
    dealt = merged.repartition(*group, "_file").drop("_file")
    dealt.write.mode("overwrite").option("maxRecordsPerFile", limit).partitionBy(*layout).parquet(staging)
    base = _base(spark, root)
    journal = {"delete": [f[len(base) + 1 :] for f in gone], "generation": read_generation(spark, root), "merges": number}
    write_record(spark, f"{root}/{PURGE_JOURNAL}", journal)
    finish_purge(spark, root)
    return len(todo)


def _plain_paths(spark: SparkSession, uris) -> list[str]:
    """``plain_path`` of many files; each folder is asked for once."""
    folders: dict[str, str] = {}
    out = []
    for uri in uris:
        folder, _, name = uri.rpartition("/")
        if folder not in folders:
            folders[folder] = plain_path(spark, folder)
        out.append(f"{folders[folder]}/{unquote(name)}")
    return out


def _base(spark: SparkSession, root: str) -> str:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/")


def merge_segments(spark: SparkSession, table: str, spec: IngestSpec) -> int:
    """Merge the rows table to files of ``maxRowsPerSegment`` rows by segment and
    disposition; returns how many files were merged."""
    finish_purge(spark, table)
    finish_publishes(spark, table)
    upto = mergeable(spark, table)
    if upto < 0:
        return 0
    return _merge(spark, table, rows_schema(spec), ["segment_start", "disposition"], ["batch_id", "segment_start", "disposition"], spec.tuning.max_rows_per_segment, upto)


def merge_ledger(spark: SparkSession, ledger: str, table: str, rows_per_file: int = 5_000_000) -> int:
    """Merge the acknowledgement ledger by publish day."""
    if not path_exists(spark, ledger):
        return 0
    finish_purge(spark, ledger)
    done = commit_ids(spark, table)
    if len(done) < 2:
        return 0
    return _merge(spark, ledger, LEDGER_SCHEMA, ["publish_day"], ["publish_day", "batch_id"], rows_per_file, done[-2])


def files_by_segment(rows: DataFrame) -> DataFrame:
    """(segment_start, files, rows) of processed rows read from a table."""
    per_file = rows.groupBy("segment_start", F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("segment_start").agg(F.count(F.lit(1)).alias("files"), F.sum("n").cast("bigint").alias("rows"))
