"""Line dedup by a sharded minimal perfect hash.

1. Every line of every text becomes a key (white space stripped at both ends,
   A-Z lower-cased) and a 128-bit hash of it.  Distinct hashes of a document
   are counted over all documents with map-side partial aggregation.
2. Keys held by ``min_docs`` documents or more are dealt into shards of a
   bounded size.  One task builds a shard: a minimal perfect hash, and at each
   slot a fingerprint, the number of documents and the largest doc_id.
3. Documents probe the arrays: their line hashes travel in blocks of a bounded
   size to copies of the shard they fall in (a hot line is only a hot shard,
   whose arrays are copied to as many blocks as its own lines need).  What comes
   back is the list of dropped hashes of a text and doc_id, which the text is
   filtered by: rows that share a doc_id, or have none, do not share their lists.

A false match needs equal slots and equal 64-bit fingerprints of different
lines.  Nulls: a null text is one empty line.  A null doc_id counts as smaller
than any id, and each row without one counts as a document.  Rows that share a
doc_id count as one document, and each keeps a line for which that doc_id is the
largest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tideline.llm.common import U64, mix, slices, staged
from tideline.llm.perfect_hash import Probe, build, pack

STRIP = " \t\n\u000b\f\r"
SHARD_KEYS = 50_000  # repeated keys a shard holds, on average
BLOCK_LINES = 65_536  # line hashes a block holds, on average
TEXT_ROWS = 512  # texts that a task decodes at a time to hash their lines
NO_ID = -(1 << 63)


def key_hash(line: str, min_chars: int) -> bytes | None:
    """128-bit hash of the line's key, none where the key is short."""
    if len(line) < min_chars or len(key := line.strip(STRIP)) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key.encode("utf-8", "replace").lower())  # of bytes: A-Z only


def _halves(keys: list[bytes]) -> tuple[pa.Array, pa.Array]:
    both = np.frombuffer(b"".join(keys), dtype=np.int64).reshape(-1, 2)
    return pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1]))


def _hasher(min_chars: int):
    """Line hashes of the rows; ``deal`` numbers the rows of a task, so equal
    rows can be dealt to different blocks."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal = TaskContext.get().partitionId() << 32
        for part in slices(parts):
            ids, rows, deals, keys = [], [], [], []
            for i, row, text in zip(part.column("id").to_pylist(), part.column("row").to_pylist(), part.column("text")):
                deal += 1
                if len(line := text.as_py() or "") >= min_chars:
                    own = {key_hash(x, min_chars) for x in line.split("\n")} - {None}
                    keys += own
                    ids += [i] * len(own)
                    rows += [row] * len(own)
                    deals += [deal] * len(own)
            if keys:
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (ids, rows, deals)), *_halves(keys)], names=["id", "row", "deal", "h1", "h2"])

    return run


def _dropper(min_chars: int, names: list[str]):
    """Rows with text rewritten; the last three columns are drops (in), lines
    and dropped (out)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            texts, n_lines, n_dropped = [], [], []
            for text, drops in zip(part.column("text"), part.column("__tl_drops")):
                text, drops = text.as_py(), drops.as_py()
                lines = (text or "").split("\n")
                n_lines.append(len(lines))
                if drops:
                    gone = set(drops)
                    kept = [x for x in lines if key_hash(x, min_chars) not in gone]
                    n_dropped.append(len(lines) - len(kept))
                    text = "\n".join(kept)
                else:
                    n_dropped.append(0)
                texts.append(text)
            new = {"text": pa.array(texts, pa.string()), "__tl_lines": pa.array(n_lines, pa.int64()), "__tl_dropped": pa.array(n_dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays([new[c] if c in new else part.column(c) for c in names], names=names)

    return run


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = rows["h1"].to_numpy().astype(np.int64).view(U64), rows["h2"].to_numpy().astype(np.int64).view(U64)
    levels, slot = build(h1, h2)
    data, sizes = pack(levels)
    prints, counts, last = np.zeros(len(h1), U64), np.zeros(len(h1), np.uint32), np.zeros(len(h1), np.int64)
    prints[slot] = _fingerprint(h1, h2)
    counts[slot] = np.minimum(rows["n_docs"].to_numpy(), 0xFFFFFFFF)
    last[slot] = rows["last_id"].to_numpy()
    return pd.DataFrame(
        {
            "shard": [rows["shard"].iloc[0]],
            "bits": [data],
            "sizes": [np.array(sizes, dtype=np.int64)],
            "prints": [prints.tobytes()],
            "counts": [counts.tobytes()],
            "last": [last.tobytes()],
        }
    )


SHARD = "shard long, bits binary, sizes array<long>, prints binary, counts binary, last binary"


def _fingerprint(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(h1 ^ mix(h2 + U64(5)))


def _prober(min_docs: int):
    def probe(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                h1 = np.array(row["h1s"], dtype=np.int64)
                h2 = np.array(row["h2s"], dtype=np.int64)
                ids = np.array(row["ids"], dtype=np.int64)
                rows = np.array(row["rows"], dtype=np.int64)
                prints = np.frombuffer(row["prints"], dtype=U64)
                counts = np.frombuffer(row["counts"], dtype=np.uint32)
                last = np.frombuffer(row["last"], dtype=np.int64)
                slot = Probe(row["bits"], row["sizes"]).slots(h1.view(U64), h2.view(U64))
                hit = slot >= 0
                hit[hit] = prints[slot[hit]] == _fingerprint(h1.view(U64), h2.view(U64))[hit]
                hit[hit] = (counts[slot[hit]] >= min_docs) & (last[slot[hit]] != ids[hit])
                if hit.any():
                    keys = pa.array([x.tobytes() for x in np.stack([h1[hit], h2[hit]], 1)], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(rows[hit]), keys], names=["id", "row", "key"])

    return probe


def _row(docs: DataFrame) -> list[Column]:
    """What rows are known by.  Which lines a row loses depends on its doc_id and
    the lines alone, so texts of one doc_id whose hashes meet lose the right ones."""
    return [F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)), F.xxhash64(docs["text"])]


def _blocks(held: DataFrame, shards: int) -> DataFrame:
    """The line hashes of each shard in blocks of about ``BLOCK_LINES``."""
    shard = F.pmod("h2", F.lit(shards)).alias("shard")
    sizes = staged(held.groupBy(shard).agg(F.ceil(F.count("*") / F.lit(BLOCK_LINES)).alias("copies")), "line-shard-sizes")
    return (
        held.select("*", shard)
        .join(sizes, "shard")
        .withColumn("copy", F.pmod(F.xxhash64("deal", "h1"), F.col("copies")))
        .groupBy("shard", "copy")
        .agg(F.collect_list(F.struct("h1", "h2", "id", "row")).alias("lines"))
        .select("shard", F.col("lines.h1").alias("h1s"), F.col("lines.h2").alias("h2s"), F.col("lines.id").alias("ids"), F.col("lines.row").alias("rows"))
    )


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``(id, row, drops)``: the line hashes a row loses; only rows that lose
    some.  Equal rows have one list."""
    own, row = _row(docs)
    held = staged(
        docs.select(own.alias("id"), row.alias("row"), "text").mapInArrow(_hasher(min_chars), "id long, row long, deal long, h1 long, h2 long"),
        "line-hashes",
        read_rows=TEXT_ROWS,
    )
    # rows of one doc_id are one document; each row without an id is one
    by_doc = held.groupBy("h1", "h2", "id").agg(F.count("*").alias("n"))
    repeated = staged(
        by_doc.groupBy("h1", "h2")
        .agg(F.sum(F.when(F.col("id") == NO_ID, F.col("n")).otherwise(1)).alias("n_docs"), F.max("id").alias("last_id"))
        .filter(F.col("n_docs") >= min_docs),
        "repeated-lines",
    )
    shards = max(1, -(-repeated.count() // SHARD_KEYS))
    shard = F.pmod("h2", F.lit(shards)).alias("shard")
    arrays = staged(repeated.select(shard, "*").groupBy("shard").applyInPandas(_build_shard, SHARD), "line-shards")
    hits = _blocks(held, shards).join(arrays, "shard").mapInArrow(_prober(min_docs), "id long, row long, key binary")
    return hits.groupBy("id", "row").agg(F.collect_set("key").alias("drops"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with ``text`` rewritten, and ``__tl_lines``, ``__tl_dropped``
    (counts before and of dropping).  A text that loses nothing stays as it is
    (null included); one that loses all its lines becomes empty."""
    drops = dropped_lines(docs, min_chars, min_docs).withColumnsRenamed({"id": "__tl_id", "row": "__tl_row", "drops": "__tl_drops"})
    own, row = _row(docs)
    joined = docs.withColumns({"__tl_id": own, "__tl_row": row}).join(drops, ["__tl_id", "__tl_row"], "left")
    schema = StructType([*docs.schema.fields, StructField("__tl_lines", LongType()), StructField("__tl_dropped", LongType())])
    return joined.drop("__tl_id", "__tl_row").mapInArrow(_dropper(min_chars, schema.names), schema)
