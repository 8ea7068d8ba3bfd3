"""Time-segmented, size-bounded table of classified rows (+ ledger, purge).

Layout: ``<table>/batch_id=N/segment_start=S/disposition=D/part-*.parquet``.
One write per batch carries every disposition (quarantine included), so
the batch is scanned once.

A batch is first written under ``<table>/_staging/batch_id=N`` (hidden from
readers by the leading underscore) and checked there.  Then its commit record is
written, and only then its files are moved into the table.  So a file in the
table always belongs to a committed batch; a publish that was cut off goes on
with the same files, and whoever has read some of them reads none twice.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.timefns import bucket_end_value, ntz, truncate
from tideline.operators.metadata import require_match
from tideline.operators.rows import PROCESSED
from tideline.spec import DatasetMetadata, IngestSpec

PARTITIONS = ["batch_id", "segment_start", "disposition"]
ROLES_FILE = "_roles.json"  # hidden from Parquet readers (leading underscore)


# -- file-system helpers (Hadoop FS of the session: works on any store) ------


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def glob_dirs(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Directories under ``root`` matching ``pattern``, relative to ``root`` (one glob call)."""
    fs, p = _fs(spark, f"{root}/{pattern}")
    found = fs.globStatus(p) or []
    base = fs.makeQualified(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)).toString().rstrip("/")
    return [st.getPath().toString()[len(base) + 1 :] for st in found if st.isDirectory()]


# -- roles sidecar -------------------------------------------------------------


def read_text(spark: SparkSession, path: str) -> str | None:
    """Small text file through the Hadoop FS API (no Spark job)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        reader.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_record(spark: SparkSession, path: str, record: dict) -> None:
    """A small JSON file that is there as a whole or not at all (written aside,
    then renamed)."""
    aside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    write_text(spark, aside, json.dumps(record))
    fs, dst = _fs(spark, path)
    if fs.exists(dst):
        fs.delete(dst, False)
    if not fs.rename(_fs(spark, aside)[1], dst):
        raise OSError(f"could not write {path}")


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path below ``path``, length) of all files."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    base, found, out = fs.makeQualified(p).toString().rstrip("/"), fs.listFiles(p, True), []
    while found.hasNext():
        f = found.next()
        out.append((f.getPath().toString()[len(base) + 1 :], f.getLen()))
    return out


def plain_path(spark: SparkSession, uri: str) -> str:
    """The path that a URI (as in ``_metadata.file_path``) stands for, as readers
    take it."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def read_roles(spark: SparkSession, table: str) -> DatasetMetadata | None:
    text = read_text(spark, f"{table}/{ROLES_FILE}")
    return None if text is None else DatasetMetadata.from_json(text)


def write_roles(spark: SparkSession, table: str, meta: DatasetMetadata) -> None:
    write_text(spark, f"{table}/{ROLES_FILE}", meta.to_json())


# -- rows table ------------------------------------------------------------------


def rows_schema(spec: IngestSpec) -> T.StructType:
    fields = [
        T.StructField("subscription", T.StringType()),  # NULL unless several subscriptions feed the table
        T.StructField("messageId", T.StringType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("publishTime", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
    ]
    fields += [T.StructField(f.name, T._parse_datatype_string(f.type)) for f in spec.data_schema.fields]
    fields += [
        T.StructField("reason", T.StringType()),
        T.StructField("segment_end", T.TimestampNTZType()),
        T.StructField("data", T.StringType()),
        T.StructField("from_batch", T.LongType()),  # the batch of a merged row, NULL elsewhere
        T.StructField("segment_start", T.TimestampNTZType()),
        T.StructField("disposition", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
    return T.StructType(fields)


STAGING = "_staging"


def staging_path(table: str, batch_id: int) -> str:
    return f"{table}/{STAGING}/batch_id={int(batch_id)}"


def stage_rows(rows: DataFrame, table: str, spec: IngestSpec, batch_id: int, counted: list[Column], expected: int = 0) -> dict:
    """Write one batch of classified rows (``expected``: about how many) to its
    hidden staging folder and return the ``counted`` aggregates of what was written,
    observed by the write itself.

    * roles of the table are checked against the spec first (as sets);
    * ``rebalance`` on ``segment_start``: AQE cuts a hot segment into
      advisory-sized partitions and merges small ones, so one busy interval
      never lands in one task and files come out evenly sized;
    * ``maxRecordsPerFile`` bounds every file by ``maxRowsPerSegment``;
    * partitioned by segment and disposition (the batch id is the folder).
    """
    spark = rows.sparkSession
    finish_purge(spark, table)
    require_match(read_roles(spark, table), spec)
    path = staging_path(table, batch_id)
    delete_path(spark, path)  # leftovers of a failed attempt
    return write_segments(rows.drop("batch_id"), path, spec, ["segment_start", "disposition"], counted, expected)


#: Full files that one cut of the segments writes.
FILES_PER_CUT = 256


def write_segments(
    rows: DataFrame, path: str, spec: IngestSpec, partitions: list[str], counted: list[Column] | None = None, expected: int = 0
) -> dict:
    """Rows by segment, a hot segment over several tasks, in files of at most
    ``maxRowsPerSegment`` rows.

    AQE cuts segments by bytes; where files are small, the work is in their number.
    So the ``expected`` rows give a number of cuts by files, and each segment is
    dealt to as many.  Few files (the usual) are one cut.

    The counts are observed above the shuffle, in the tasks that write: a map
    task that runs again after a loss is not counted twice.
    """
    keys = [c for c in ("batch_id", "segment_start") if c in partitions]
    cuts, seen = expected // spec.tuning.max_rows_per_segment // FILES_PER_CUT, None
    if cuts > 1:
        place = F.pmod(F.xxhash64("messageId", "publishTime", "pos"), F.lit(cuts))
        dealt = rows.withColumn("_cut", place).hint("rebalance", *keys, "_cut").drop("_cut")
    else:
        dealt = rows.hint("rebalance", *keys)
    if counted:
        seen = Observation(f"written-{uuid.uuid4().hex}")
        dealt = dealt.observe(seen, *counted)
    dealt.write.mode("overwrite").option("maxRecordsPerFile", spec.tuning.max_rows_per_segment).partitionBy(*partitions).parquet(path)
    return seen.get if seen else {}


def stage_batches(rows: DataFrame, table: str, spec: IngestSpec, expected: int, counted: list[Column]) -> dict[int, dict]:
    """``stage_rows`` for the rows of several batches (by ``batch_id``) in one write,
    to the folder ``_staging/together``; the counts are read from what was written,
    by batch."""
    spark = rows.sparkSession
    finish_purge(spark, table)
    require_match(read_roles(spark, table), spec)
    delete_path(spark, f"{table}/{TOGETHER}")
    write_segments(rows, f"{table}/{TOGETHER}", spec, PARTITIONS, None, expected)
    seen = read_together(spark, table, spec).groupBy("batch_id").agg(*counted).collect()  # a row a batch
    return {r["batch_id"]: r.asDict() for r in seen}


TOGETHER = f"{STAGING}/together"


def read_together(spark: SparkSession, table: str, spec: IngestSpec) -> DataFrame:
    return spark.read.schema(rows_schema(spec)).parquet(f"{table}/{TOGETHER}")


def split_staged(spark: SparkSession, table: str, batch_id: int) -> None:
    """Give a batch that was staged with others the staging folder of its own, from
    which it is published."""
    discard_staged(spark, table, batch_id)  # leftovers of a failed attempt
    (fs, src), (_, dst) = _fs(spark, f"{table}/{TOGETHER}/batch_id={int(batch_id)}"), _fs(spark, staging_path(table, batch_id))
    if fs.exists(src) and not fs.rename(src, dst):
        raise OSError(f"could not stage {src} as {dst}")


def read_staged(spark: SparkSession, table: str, spec: IngestSpec, batch_id: int) -> DataFrame:
    """Rows of a staged batch, without its number."""
    return spark.read.schema(rows_schema(spec)).parquet(staging_path(table, batch_id))


def discard_staged(spark: SparkSession, table: str, batch_id: int) -> None:
    delete_path(spark, staging_path(table, batch_id))


def _marker(table: str, batch_id: int) -> str:
    return f"{table}/_commits/{int(batch_id)}.json"


def committed(spark: SparkSession, table: str, batch_id: int) -> dict | None:
    """The commit record of a batch, or None if it is not committed."""
    text = read_text(spark, _marker(table, batch_id))
    return None if text is None else json.loads(text)


def commit_ids(spark: SparkSession, table: str) -> list[int]:
    """Numbers of all committed batches, ascending (file names only)."""
    return sorted(int(name[:-5]) for name, _ in list_files(spark, f"{table}/_commits") if name.endswith(".json"))


def publish_staged(spark: SparkSession, table: str, spec: IngestSpec, batch_id: int, record: dict) -> None:
    """Commit a staged batch: write its record, then move its files in.

    A folder of the table without a record was not written by this library's
    publish and goes first.  From the record on the batch counts as committed;
    ``finish_publish`` moves whatever is still staged.
    """
    fs, dst = _fs(spark, f"{table}/batch_id={int(batch_id)}")
    if fs.exists(dst):
        fs.delete(dst, True)
    if read_roles(spark, table) is None:
        write_roles(spark, table, require_match(None, spec))
    write_record(spark, _marker(table, batch_id), record)
    finish_publish(spark, table, batch_id)


def finish_publish(spark: SparkSession, table: str, batch_id: int) -> None:
    """Move the staged files of a committed batch into the table: the whole folder
    by one rename, or one by one what an earlier try has left.  Staged files are
    never written anew once the record is there, so their names stay."""
    staging = staging_path(table, batch_id)
    (fs, src), (_, dst) = _fs(spark, staging), _fs(spark, f"{table}/batch_id={int(batch_id)}")
    if not fs.exists(src):
        return
    if not fs.exists(dst):
        if not fs.rename(src, dst):
            raise OSError(f"could not publish {src} as {dst}")
        return
    for name, length in list_files(spark, staging):
        to = _fs(spark, f"{table}/batch_id={int(batch_id)}/{name}")[1]
        if fs.exists(to) and fs.getFileStatus(to).getLen() == length:
            continue
        fs.delete(to, False)
        fs.mkdirs(to.getParent())
        if not fs.rename(_fs(spark, f"{staging}/{name}")[1], to):
            raise OSError(f"could not publish {name} of batch {batch_id}")
    fs.delete(src, True)


def finish_publishes(spark: SparkSession, table: str) -> None:
    """``finish_publish`` of every committed batch that still has staged files."""
    for name in list_dirs(spark, f"{table}/{STAGING}"):
        key, _, number = name.partition("=")
        if key == "batch_id" and committed(spark, table, int(number)) is not None:
            finish_publish(spark, table, int(number))


def read_rows(spark: SparkSession, table: str, spec: IngestSpec) -> DataFrame:
    return as_written(spark.read.schema(rows_schema(spec)).parquet(table))


def as_written(rows: DataFrame) -> DataFrame:
    """Rows with the number of the batch that wrote them, merged or not."""
    return rows.withColumn("batch_id", F.coalesce("from_batch", "batch_id")).drop("from_batch")


def read_segments(
    spark: SparkSession,
    table: str,
    spec: IngestSpec,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Processed rows with event time in ``[start, end)``.

    A predicate on ``ts`` alone cannot prune ``segment_start`` directories;
    the helper adds the matching segment predicate so the scan lists only
    the segments that can hold such rows.
    """
    df = read_rows(spark, table, spec).filter(F.col("disposition") == PROCESSED)
    g = spec.data_schema.segment_granularity
    if start is not None:
        s = F.lit(start.isoformat(sep=" ")).cast("timestamp")
        df = df.filter((F.col("segment_start") >= ntz(truncate(s, g))) & (F.col("ts") >= s.cast("timestamp_ntz")))
    if end is not None:
        e = F.lit(end.isoformat(sep=" ")).cast("timestamp")
        df = df.filter((F.col("segment_start") < e.cast("timestamp_ntz")) & (F.col("ts") < e.cast("timestamp_ntz")))
    return df


def write_ledger(ledger: DataFrame, path: str) -> None:
    """Ack ledger of one batch by publish day; written after the rows of that batch."""
    day = F.try_to_timestamp("publishTime").cast("date")
    dated = ledger.withColumn("publish_day", day).hint("rebalance", "publish_day", "batch_id")
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("publish_day", "batch_id").parquet(path)


LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("ackId", T.StringType()),
        T.StructField("messageId", T.StringType()),
        T.StructField("publishTime", T.StringType()),
        T.StructField("subscription", T.StringType()),
        T.StructField("from_batch", T.LongType()),  # the batch of a merged copy, NULL elsewhere
        T.StructField("publish_day", T.DateType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def read_ledger(spark: SparkSession, path: str, since: date | None = None, before: int | None = None) -> DataFrame:
    """The ledger; with ``since``, only the folders of that publish day and later
    ones, and of copies without a publish time, are listed; with ``before``, only
    copies of earlier batches (by folder: merged ones are all of earlier batches)."""
    reader = spark.read.schema(LEDGER_SCHEMA)
    if since is None:
        found = reader.parquet(path)
    else:
        days = [d for d in list_dirs(spark, path) if d.startswith("publish_day=")]
        kept = [d for d in days if d.endswith("__HIVE_DEFAULT_PARTITION__") or d >= f"publish_day={since.isoformat()}"]
        if not kept:
            return as_written(spark.createDataFrame([], LEDGER_SCHEMA))
        found = reader.option("basePath", path).parquet(*[f"{path}/{d}" for d in kept])
    return as_written(found if before is None else found.filter(F.col("batch_id") < before))


# -- interval purge ----------------------------------------------------------------


def _segment_dir_value(name: str) -> datetime | None:
    key, _, value = name.partition("=")
    if key != "segment_start" or value == "__HIVE_DEFAULT_PARTITION__":
        return None
    return datetime.fromisoformat(unquote(value))


def read_generation(spark: SparkSession, table: str) -> int:
    """How many purges have rewritten the table."""
    return int(read_text(spark, f"{table}/_generation") or 0)


def purge_interval(spark: SparkSession, table: str, spec: IngestSpec, start: datetime, end: datetime) -> None:
    """Drop the rows with event time in ``[start, end)``, of every disposition;
    rows without an event time stay.

    A directory of a segment wholly inside the interval goes; one that straddles
    an end, or holds thrown-away rows of the interval, is written anew without
    them.  Nothing is deleted before all kept rows are staged and a journal
    names the directories; ``finish_purge`` goes on from the journal after a
    crash.  The driver deletes and renames directories, so its work grows with
    the segments of the interval, not with their rows.
    """
    finish_purge(spark, table)
    finish_publishes(spark, table)
    g = spec.data_schema.segment_granularity
    whole, partial, starts = [], [], set()
    for rel in glob_dirs(spark, table, "batch_id=*/segment_start=*"):
        seg = _segment_dir_value(rel.rsplit("/", 1)[-1])
        if seg is None:
            continue
        seg_end = bucket_end_value(seg, g)
        if seg >= start and seg_end <= end:
            whole.append(rel)
        elif seg < end and seg_end > start:
            partial.append(rel)
            starts.add(seg)
    lo, hi = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in (start, end))
    inside = F.coalesce((F.col("ts") >= lo) & (F.col("ts") < hi), F.lit(False))
    no_segment = F.col("segment_start").isNull()
    in_partial = F.col("segment_start").isin([F.lit(s.isoformat(sep=" ")).cast("timestamp_ntz") for s in sorted(starts)]) if starts else F.lit(False)
    raw = spark.read.schema(rows_schema(spec)).parquet(table)
    # a row for each straddling segment, and for the rows without one, of a batch
    found = raw.filter(no_segment | in_partial).groupBy("batch_id", no_segment.alias("none")).agg(F.count(F.lit(1)).alias("n"), F.count_if(inside).alias("gone")).collect()
    folders = [r["batch_id"] for r in found if r["none"] and r["gone"]]
    kept = sum(r["n"] - r["gone"] for r in found if not r["none"] or r["gone"])
    partial += [f"batch_id={b}/segment_start=__HIVE_DEFAULT_PARTITION__" for b in folders]
    if not whole and not partial:
        return
    touched = (no_segment & F.col("batch_id").isin(folders)) | in_partial
    staging = f"{table}/{STAGING}/purge"
    delete_path(spark, staging)
    if partial:
        write_segments(raw.filter(touched & ~inside), staging, spec, PARTITIONS, None, kept)
    journal = {"delete": whole + partial, "generation": read_generation(spark, table) + 1}
    write_record(spark, f"{table}/{PURGE_JOURNAL}", journal)
    finish_purge(spark, table)


PURGE_JOURNAL = "_purge.json"


def finish_purge(spark: SparkSession, table: str) -> None:
    """Carry out the journal of a purge or a merge: delete, then move the staged
    directories in.  Each step can be done again; without a journal nothing happens."""
    text = read_text(spark, f"{table}/{PURGE_JOURNAL}")
    if text is None:
        return
    journal, staging = json.loads(text), f"{table}/{STAGING}/purge"
    write_text(spark, f"{table}/_generation", str(journal["generation"]))
    if "merges" in journal:
        write_text(spark, f"{table}/_merges", str(journal["merges"]))
    for rel in journal["delete"]:
        delete_path(spark, f"{table}/{rel}")
    # from here on the directories of the journal may be new ones
    write_record(spark, f"{table}/{PURGE_JOURNAL}", journal | {"delete": []})
    for rel in glob_dirs(spark, staging, "*=*/*=*"):
        fs, dst = _fs(spark, f"{table}/{rel}")
        fs.mkdirs(dst.getParent())
        if not fs.rename(_fs(spark, f"{staging}/{rel}")[1], dst):
            raise OSError(f"could not move {rel} of the purge into {table}")
    delete_path(spark, staging)
    delete_path(spark, f"{table}/{PURGE_JOURNAL}")


def read_batch(spark: SparkSession, table: str, spec: IngestSpec, batch_id: int) -> DataFrame:
    """Rows of one committed batch that is not merged: lists only its folder."""
    return as_written(spark.read.schema(rows_schema(spec)).option("basePath", table).parquet(f"{table}/batch_id={int(batch_id)}"))
