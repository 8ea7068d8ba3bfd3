"""Vector code compression: product codes whose codebooks ball k-means trains.

A vector becomes integers ``floor(scale * x)`` and is cut into equal consecutive
parts; every part position has a codebook of its own.  All distances are exact
integers.  A codebook starts as that part of the vectors with the smallest ids;
a round assigns every part to the nearest entry (ties: the lower index) and
moves each entry to the floor of its parts' mean; an entry without parts stays.

Ball k-means: the parts of an entry lie in a ball around it.  After an entry has
moved, its ball's radius is at most the old radius plus the way it went, so only
entries within twice that are its neighbours.  A part at distance ``s`` of its
entry can only go to an entry at most ``2 s`` from that one.  So parts nearer
than half the way to the closest neighbour (the stable core) are left alone, and
the others are compared with the neighbours up to their ring, no further.  The
test is inclusive, so ties with a lower index are found too.

What reaches the driver are the first vectors and, each round, one row for each
entry: ``parts * entries`` rows, whatever the number of vectors.  The state of a
round (integers and codes) is a staged table.

Defined results: rows whose vector is null or holds null or non-finite
components are dropped.  Null ids come last in the order of ids; rows of equal
ids are ordered by their integers and each counts.  The length of the first
vector that the parts divide holds for all; vectors of another length, and those
with integers so large that a squared distance might not fit 64 bits, get a null
code and error and take no part.  Fewer vectors than entries give as many
entries; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import slices, staged

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
PAIRS = 1 << 19  # (part, entry) distances that a task holds at a time


@dataclass
class Codebooks:
    """``entries[part, entry, position]``; of each entry, the neighbours by
    distance (``order``, ``apart`` squared) that its ball can give parts to."""

    entries: np.ndarray
    order: np.ndarray | None = None
    apart: np.ndarray | None = None

    @property
    def dim(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def text(self) -> str:
        return ",".join(map(str, self.entries.ravel().tolist()))

    def sha256(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, ints): ``floor(scale * x)``; null where an integer is too
    large for exact distances."""
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("__tl_v"))
    sound = F.col("__tl_v").isNotNull() & F.forall("__tl_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    size = F.greatest(F.size("__tl_v"), F.lit(1))
    most = F.pow(F.lit(2.0), F.lit(30)) / F.sqrt(size)  # size * (2 most)^2 = 2^62
    fits = F.forall("__tl_v", lambda x: F.abs(x * scale) < most)
    return rows.filter(sound).select("vec_id", "label", F.when(fits, F.transform("__tl_v", lambda x: F.floor(x * scale))).alias("ints"))


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The parts of the ``entries`` vectors with the smallest ids."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("ints")]
    whole = rows.filter((F.size("ints") > 0) & (F.size("ints") % parts == 0))
    head = whole.orderBy(*order).select(F.size("ints").alias("n")).first()
    if head is None:
        return Codebooks(np.zeros((parts, 0, 0), dtype=np.int64))
    first = whole.filter(F.size("ints") == head["n"]).orderBy(*order).limit(entries).select("ints").collect()
    table = np.array([r["ints"] for r in first], dtype=np.int64).reshape(len(first), parts, -1)
    return Codebooks(np.ascontiguousarray(table.transpose(1, 0, 2)))


def with_balls(entries: np.ndarray, radius: np.ndarray) -> Codebooks:
    """Neighbour tables of the entries for balls of these radii (at least)."""
    apart = ((entries[:, :, None, :] - entries[:, None, :, :]) ** 2).sum(axis=3)
    own = np.arange(entries.shape[1])
    apart[:, own, own] = np.iinfo(np.int64).max  # an entry is no neighbour of its own
    far = 4.0 * (radius + 1.0) ** 2 * (1 + 1e-9)
    apart[apart > far[:, :, None]] = np.iinfo(np.int64).max
    order = np.argsort(apart, axis=2, kind="stable")
    apart = np.take_along_axis(apart, order, axis=2)
    most = int((apart < np.iinfo(np.int64).max).sum(axis=2).max(initial=0))
    return Codebooks(entries, order[:, :, :most].astype(np.int64), apart[:, :, :most])


def _nearest(books: Codebooks, x: np.ndarray) -> np.ndarray:
    """Codes of ``x[row, part, position]``: every entry is compared."""
    codes = np.empty(x.shape[:2], dtype=np.int64)
    step = max(1, PAIRS // books.entries.shape[1])
    for p, book in enumerate(books.entries):
        for at in range(0, len(x), step):
            codes[at : at + step, p] = ((x[at : at + step, p, None, :] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
    return codes


def _distances(books: Codebooks, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    own = books.entries[np.arange(x.shape[1])[None, :], codes]
    return ((x - own) ** 2).sum(axis=2)


def _ringed(books: Codebooks, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Codes of ``x`` given the entries that it was last assigned to."""
    parts, k, width = books.entries.shape
    if not books.order.shape[2]:
        return codes
    flat, entries = (codes + np.arange(parts) * k).ravel(), books.entries.reshape(parts * k, width)
    order, apart = books.order.reshape(parts * k, -1), books.apart.reshape(parts * k, -1)
    reach, items = 4 * _distances(books, x, codes).ravel(), x.reshape(-1, width)
    out = codes.ravel().copy()
    moving = np.flatnonzero(apart[flat, 0] <= reach)  # all others lie in a stable core
    rings = (apart[flat[moving]] <= reach[moving, None]).sum(axis=1)
    ends = np.cumsum(rings)
    at = 0
    while at < len(moving):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        rows, sizes = moving[at:to], rings[at:to]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        item = np.repeat(rows, sizes)
        entry = order[flat[item], np.arange(len(item)) - np.repeat(starts, sizes)]
        d = ((items[item] - entries[flat[item] // k * k + entry]) ** 2).sum(axis=1)
        least = np.minimum.reduceat(d, starts)
        best = np.minimum.reduceat(np.where(d == np.repeat(least, sizes), entry, k), starts)
        now, own = codes.ravel()[rows], reach[rows] // 4
        better = (least < own) | ((least == own) & (best < now))
        out[rows] = np.where(better, best, now)
        at = to
    return out.reshape(codes.shape)


STATE = "vec_id {id}, label {label}, ints array<bigint>, codes binary"


def _cut(part: pa.RecordBatch, books: Codebooks) -> np.ndarray:
    return part.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, books.entries.shape[0], -1)


def _codes(part: pa.RecordBatch, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(part.column("codes").to_pylist()), dtype=np.uint8).reshape(-1, parts).astype(np.int64)


def _assign(rows: DataFrame, books: Codebooks, name: str) -> DataFrame:
    """The rows with the codes under ``books``, staged; where they have codes,
    those tell which ball a part is in."""
    parts = books.entries.shape[0]
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            if part.num_rows:
                x = _cut(part, books)
                codes = _nearest(books, x) if books.order is None else _ringed(books, x, _codes(part, parts))
                raw = pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), part.column("ints"), raw], names=["vec_id", "label", "ints", "codes"])

    return staged(rows.mapInArrow(run, STATE.format(id=kinds["vec_id"], label=kinds["label"])), name)


def _moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Entries at the floor of their parts' means, with the balls they now need."""
    parts, k, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, radius = np.zeros((parts * k, width), dtype=np.int64), np.zeros(parts * k, dtype=np.int64), np.zeros(parts * k, dtype=np.int64)
        for part in slices(batches):
            if part.num_rows:
                x, codes = _cut(part, books), _codes(part, parts)
                flat = (codes + np.arange(parts) * k).ravel()
                np.add.at(sums, flat, x.reshape(-1, width))
                np.add.at(counts, flat, 1)
                np.maximum.at(radius, flat, _distances(books, x, codes).ravel())
        used = np.flatnonzero(counts)
        cols = [pa.array(used), pa.array(counts[used]), pa.array(radius[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(cols, names=["flat", "n", "far", "sums"])

    partial = rows.select("ints", "codes").mapInArrow(run, "flat bigint, n bigint, far bigint, sums array<bigint>")
    # one row for each entry: bounded by the codebooks
    total = partial.groupBy("flat").agg(F.sum("n").alias("n"), F.max("far").alias("far"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums")).collect()
    entries, radius = books.entries.reshape(parts * k, width).copy(), np.zeros(parts * k)
    for r in total:
        entries[r["flat"]] = [s // r["n"] for s in r["sums"]]
        radius[r["flat"]] = math.sqrt(r["far"])
    way = np.sqrt(((entries - books.entries.reshape(parts * k, width)) ** 2).sum(axis=1).astype(np.float64))
    return with_balls(entries.reshape(parts, k, width), (radius + way).reshape(parts, k))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """Codes of ``vectors`` (vec_id, embedding, label) and their codebooks: rows of
    vec_id, label, codes (a byte for each part) and error."""
    rows = staged(integers(vectors, scale), "codes-integers")
    books = first_codebooks(rows, parts, entries)
    fits = (F.col("ints").isNotNull()) & (F.size("ints") == books.dim) & F.lit(books.dim > 0)
    state = rows.filter(fits)
    if books.dim:
        state = _assign(state, books, "codes-0")
        for turn in range(rounds):
            books = _moved(state, books)
            state = _assign(state, books, f"codes-{turn + 1}")
    else:
        state = state.withColumn("codes", F.lit(None).cast("binary"))

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            if part.num_rows:
                far = _distances(books, _cut(part, books), _codes(part, parts)).sum(axis=1)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), part.column("codes"), pa.array(far)], names=["vec_id", "label", "codes", "error"])

    kinds = dict(rows.dtypes)
    coded = state.mapInArrow(errors, f"vec_id {kinds['vec_id']}, label {kinds['label']}, codes binary, error bigint")
    rest = rows.filter(~F.coalesce(fits, F.lit(False))).select("vec_id", "label", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("bigint").alias("error"))
    return staged(coded.unionByName(rest), "codes"), books


def decode(coded: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """The vectors that the codes stand for: vec_id, label, embedding."""
    parts = books.entries.shape[0]
    kinds = dict(coded.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            if part.num_rows:
                x = books.entries[np.arange(parts)[None, :], _codes(part, parts)].reshape(part.num_rows, -1) / scale
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["vec_id", "label", "embedding"])

    return coded.filter(F.col("codes").isNotNull()).select("vec_id", "label", "codes").mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, embedding array<double>")


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the errors of equal labels summed (nulls
    together): one partial aggregation, joined back."""
    sums = coded.groupBy(F.col("label").alias("__tl_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("__tl_label")), "left").drop("__tl_label")
