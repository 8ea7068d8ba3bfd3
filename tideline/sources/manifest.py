"""What lies in the landing folders, and how it is cut into polls and commits.

Batch jobs take files by name: a commit record lists the files (or, of Parquet
files, row ranges of them) that the batch took, so the next job knows what is
new.  A poll holds at most ``maxMessagesPerPoll`` messages and at most
``maxMessageSizePerPoll`` bytes of file (one message at least); a commit takes
polls until it has ``maxTotalRows`` rows.

Only file statistics reach the driver (name, length, messages, rows), as file
listings do anyway.  Messages are counted without reading a column; rows are
counted from the payload only where a message may hold several
(``rowsField``).
"""

from __future__ import annotations

from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.rows import decode_payload, merge, parse_payload
from tideline.sinks.segments import path_exists, plain_path
from tideline.sources.landing import UNREADABLE, pull_reader, unnest_pull
from tideline.sources.schema import ENVELOPE, ENVELOPE_COLUMNS
from tideline.spec import IngestSpec

#: The part of a commit record that names its input.
POLLS = "polls array<array<struct<subscription string, path string, lo bigint, hi bigint, messages bigint, bytes bigint, rows bigint>>>"


@dataclass(frozen=True)
class Landing:
    """Where messages are landed: folders by subscription (one folder without a
    label is ``{None: path}``) and how their files are read."""

    paths: dict[str | None, str]
    fmt: str = "parquet"  # of envelopes
    source: str = "envelopes"  # or "pulls": pull responses in JSON
    multi_line: bool = False

    @property
    def splits(self) -> bool:
        """Whether rows of a file have numbers to cut it by."""
        return self.source == "envelopes" and self.fmt == "parquet"


@dataclass(frozen=True)
class Slice:
    """A landed file, or the rows ``lo <= number < hi`` of one."""

    subscription: str | None
    path: str
    messages: int
    bytes: int
    rows: int
    lo: int | None = None
    hi: int | None = None


def _raw(spark: SparkSession, landing: Landing, paths: list[str]) -> DataFrame:
    """Landed messages with the file and (Parquet) the number of the row they come
    from: ``_path, _bytes, _landed, _row``."""
    paths = [plain_path(spark, p) for p in paths]
    meta = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_bytes"), F.col("_metadata.file_modification_time").alias("_landed")]
    if landing.source == "pulls":
        return unnest_pull(pull_reader(spark.read, landing.multi_line).json(paths).select("receivedMessages", UNREADABLE, *meta), ["_path", "_bytes", "_landed"])
    row = F.col("_metadata.row_index") if landing.splits else F.lit(None).cast("bigint")
    return spark.read.schema(ENVELOPE).format(landing.fmt).load(paths).select(*ENVELOPE_COLUMNS, *meta, row.alias("_row"))


def landed(spark: SparkSession, landing: Landing) -> DataFrame:
    """(subscription, path, bytes, landed_at) of every landed file; contents are
    not read."""
    out = spark.createDataFrame([], "subscription string, path string, bytes bigint, landed_at timestamp")
    for name, path in landing.paths.items():
        if path_exists(spark, path):
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            own = [F.lit(name).cast("string"), F.col("_metadata.file_path"), F.col("_metadata.file_size"), F.col("_metadata.file_modification_time")]
            out = out.unionByName(files.select(*(c.alias(n) for c, n in zip(own, out.columns))))
    return out


def taken(spark: SparkSession, table: str) -> DataFrame:
    """(subscription, path, hi) of what committed batches took: ``hi`` is the end
    of the rows taken of a file, null where all of it was."""
    none = spark.createDataFrame([], "subscription string, path string, hi bigint")
    if not path_exists(spark, f"{table}/_commits"):
        return none
    polls = spark.read.schema(POLLS).json(f"{table}/_commits").select(F.explode(F.flatten("polls")).alias("s"))
    whole = F.max(F.col("s.hi").isNull()).alias("whole")
    ends = polls.groupBy("s.subscription", "s.path").agg(F.max("s.hi").alias("hi"), whole)
    return ends.select("subscription", "path", F.when(~F.col("whole"), F.col("hi")).alias("hi"))


def new_slices(spark: SparkSession, landing: Landing, table: str, spec: IngestSpec) -> list[Slice]:
    """What no committed batch has taken, in the order of landing."""
    all_files = landed(spark, landing)
    left = all_files.alias("f").join(
        taken(spark, table).alias("t"), F.col("f.subscription").eqNullSafe(F.col("t.subscription")) & (F.col("f.path") == F.col("t.path")), "left"
    )
    files = left.filter(F.col("t.path").isNull() | F.col("t.hi").isNotNull()).select("f.*", F.col("t.hi").alias("from"))
    found = files.orderBy("landed_at", "path", "subscription").collect()
    if not found:
        return []
    raw = _raw(spark, landing, sorted({r["path"] for r in found}))
    rows = F.lit(1)
    if spec.data_schema.rows_field:
        parsed = merge(parse_payload(decode_payload(raw, spec)))
        array = F.from_json(F.col("merged")[spec.data_schema.rows_field], "array<string>")
        raw, rows = parsed.withColumn("_n", F.when(array.isNull(), 1).otherwise(F.size(array))), F.col("_n")
    counted = raw.groupBy("_path").agg(F.count(F.lit(1)).alias("messages"), F.sum(rows).cast("bigint").alias("rows")).collect()
    sizes = {r["_path"]: (r["messages"], r["rows"]) for r in counted}
    out = []
    for r in found:
        messages, n = sizes.get(r["path"], (0, 0))
        whole = Slice(r["subscription"], r["path"], messages, r["bytes"], n or 0)
        out.append(whole if r["from"] is None else _part(whole, r["from"], messages))
    return out


def _part(s: Slice, lo: int, hi: int) -> Slice:
    """The messages ``lo <= i < hi`` of a slice; bytes and rows are its share.  The
    part that ends the file has no upper bound, which tells that the file is done."""
    if lo == 0 and hi == s.messages:
        return s
    first, n = s.lo or 0, max(s.messages, 1)
    end = s.hi if hi == s.messages else first + hi
    return Slice(s.subscription, s.path, hi - lo, s.bytes * (hi - lo) // n, -(-s.rows * (hi - lo) // n), first + lo, end)


def polls(slices: list[Slice], spec: IngestSpec, splits: bool) -> list[list[Slice]]:
    """Consecutive slices cut so that no poll passes a bound, nor the rows of a
    commit; a file whose rows have no numbers is not cut and may be a poll of its
    own beyond it."""
    most, size, limit = spec.io_config.max_messages_per_poll or 1 << 62, spec.io_config.max_message_size_per_poll or 1 << 62, spec.tuning.max_total_rows
    out: list[list[Slice]] = [[]]
    messages = used = rows = 0
    for s in slices:
        at = 0
        while True:
            left = s.messages - at
            by_size = (size - used) * s.messages // s.bytes if s.bytes else left
            by_rows = (limit - rows) * s.messages // s.rows if s.rows else left
            room = max(0, min(most - messages, by_size, by_rows))
            take = left if left <= room else room if splits else 0
            if not take and left:
                if out[-1]:  # full: the next poll begins
                    out.append([])
                    messages = used = rows = 0
                    continue
                take = min(1, left) if splits else left
            part = _part(s, at, at + take)
            out[-1].append(part)
            messages, used, rows, at = messages + take, used + part.bytes, rows + part.rows, at + take
            if at >= s.messages:
                break
    return [p for p in out if p]


def commits(polled: list[list[Slice]], spec: IngestSpec) -> list[list[list[Slice]]]:
    """Polls by commit: each takes polls until it has ``maxTotalRows`` rows."""
    out: list[list[list[Slice]]] = []
    rows = None
    for p in polled:
        if rows is None or rows >= spec.tuning.max_total_rows:
            out.append([])
            rows = 0
        out[-1].append(p)
        rows += sum(s.rows for s in p)
    return out


def read_polls(spark: SparkSession, landing: Landing, polled: list[list[Slice]]) -> DataFrame:
    """Envelopes of the slices, labelled where their folder has a label."""
    by_name: dict[str | None, list[Slice]] = {}
    for s in (s for p in polled for s in p):
        by_name.setdefault(s.subscription, []).append(s)
    frames = []
    for name, own in by_name.items():
        raw = _raw(spark, landing, sorted({s.path for s in own}))
        cuts: dict[str, list[Slice]] = {}
        for s in own:
            if s.lo is not None:
                cuts.setdefault(s.path, []).append(s)
        # neighbouring parts are one, so at most the first and last file of a commit are cut
        for path, parts in cuts.items():
            inside = F.col("_row") >= min(s.lo for s in parts)
            if all(s.hi is not None for s in parts):
                inside &= F.col("_row") < max(s.hi for s in parts)
            raw = raw.filter((F.col("_path") != path) | inside)
        frames.append(raw.select(*ENVELOPE_COLUMNS).withColumn("subscription", F.lit(name).cast("string")))
    env = reduce(lambda a, b: a.unionByName(b), frames)
    return env if any(n is not None for n in by_name) else env.drop("subscription")


def read_commits(spark: SparkSession, landing: Landing, numbered: dict[int, list[list[Slice]]]) -> DataFrame:
    """Envelopes of several commits in one scan of their files, each with the number
    of its commit (``_batch``).

    A file is cut into disjoint ranges of rows.  They are looked up by file and
    block of rows, a few entries a commit, which go to all tasks.
    """
    ranges: dict[tuple[str | None, str, int], list[int]] = {}
    for number, polled in numbered.items():
        for s in (s for p in polled for s in p if s.messages):
            lo, hi = s.lo or 0, (s.lo or 0) + s.messages
            # neighbouring parts of a file are one within a commit
            own = ranges.setdefault((s.subscription, s.path, number), [lo, hi])
            own[:] = min(own[0], lo), max(own[1], hi)
    block = max(1, sum(hi - lo for lo, hi in ranges.values()) // (4 * len(numbered)))
    entries: dict[str | None, list[tuple]] = {s.subscription: [] for polled in numbered.values() for p in polled for s in p}
    for (name, path, number), (lo, hi) in ranges.items():
        entries[name] += [(path, b, lo, hi, number) for b in (range(lo // block, (hi - 1) // block + 1) if landing.splits else [0])]
    frames = []
    for name, own in entries.items():
        cuts = F.broadcast(spark.createDataFrame(own, "path string, block bigint, lo bigint, hi bigint, _batch bigint"))
        paths = sorted({s.path for polled in numbered.values() for p in polled for s in p if s.subscription == name})
        raw, inside = _raw(spark, landing, paths), F.col("_path") == F.col("path")
        if landing.splits:
            inside &= (F.floor(F.col("_row") / F.lit(block)) == F.col("block")) & (F.col("_row") >= F.col("lo")) & (F.col("_row") < F.col("hi"))
        frames.append(raw.join(cuts, inside).select(*ENVELOPE_COLUMNS, F.lit(name).cast("string").alias("subscription"), "_batch"))
    env = reduce(lambda a, b: a.unionByName(b), frames)
    return env if any(n is not None for n in entries) else env.drop("subscription")


def as_record(polled: list[list[Slice]]) -> list[list[dict]]:
    return [[asdict(s) for s in p] for p in polled]


def from_record(polled: list[list[dict]]) -> list[list[Slice]]:
    return [[Slice(**s) for s in p] for p in polled]
