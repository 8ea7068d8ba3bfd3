"""Helpers shared by the operators: staged tables, fold columns, word hashing."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import scratch_path

U64 = np.uint64
ONE = U64(1)


ARROW_ROWS, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, batch_rows: int = BATCH_ROWS, read_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: cuts the
    lineage with a table that survives lost executors.  Python stages below get
    Arrow batches of ``batch_rows`` rows meanwhile, as rows hold whole texts;
    ``read_rows`` is how many rows of a Parquet file are decoded at a time."""
    path, conf = scratch_path(df.sparkSession, f"llm-{name}"), df.sparkSession.conf
    sizes = {ARROW_ROWS: batch_rows} | ({READ_ROWS: read_rows} if read_rows else {})
    before = {k: conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            conf.set(k, str(v))
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            conf.set(k, v)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, parts: int) -> Column:
    """``crc32(doc_id as text) mod parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def spread(df: DataFrame, name: str = "") -> DataFrame:
    """Deal rows evenly over the session's parallelism before Python work whose
    cost per row is high.  The rows are narrow when this is used."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (xor-shift and multiply), wrapping."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@functools.lru_cache(maxsize=64)
def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words of a seed."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U64) + U64(seed) * U64(1 << 20)) * U64(0x9E3779B97F4A7C15))


PIECE = 1 << 20  # bytes hashed at a time; longer texts are hashed piece by piece
_BASE = U64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(n, dtype=U64)
    out[1:] = base
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=U64)


def white_space_words() -> np.ndarray:
    """Which bytes belong to words ``[^\\x20\\x09-\\x0D]+``."""
    keep = np.ones(256, dtype=bool)
    keep[[0x20, *range(0x09, 0x0E)]] = False
    return keep


def letter_words() -> np.ndarray:
    """Words of ASCII letters and digits and of any character beyond ASCII."""
    keep = np.zeros(256, dtype=bool)
    keep[0x80:] = True
    for lo, hi in (("0", "9"), ("a", "z"), ("A", "Z")):
        keep[ord(lo) : ord(hi) + 1] = True
    return keep


# Blocks of scripts written without spaces between words.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x2E80, 0x2FDF),
    (0x3005, 0x3007), (0x3021, 0x3029), (0x3031, 0x3035), (0x3040, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF),
    (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F),
    (0x16FE0, 0x18DFF), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF),
)


class _Spaced(dict):
    """What each character beyond ASCII becomes, filled as characters come."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        kind = unicodedata.category(c)
        if code < 0x80:
            out = c
        elif kind == "Cf" and code != 0x200B:  # joiners, soft hyphens, marks of direction
            out = ""
        elif kind[0] not in "LMN":
            out = " "
        else:
            out = f" {c} " if any(lo <= code <= hi for lo, hi in UNSPACED) else c
        self[code] = out
        return out


_SPACED = _Spaced()


def spaced(text: str) -> str:
    """The text so that ``letter_words`` finds words of letters, digits and
    marks of any script: other characters become spaces, invisible ones go, and
    each character of a script without spaces is a word."""
    return text if text.isascii() else text.translate(_SPACED)


class WordHasher:
    """64-bit hashes of all words of a text, vectorized over its UTF-8 bytes.

    The hash of bytes ``b[s:e]`` is the sum of ``T[b[i]] * r^(i-s)`` modulo
    2^64, taken from one running sum over the piece, then finalized.  A-Z hash
    as a-z.  ``prefixes`` adds one hash array per byte length (words shorter
    than it get 0).
    """

    def __init__(self, word_bytes: np.ndarray, prefixes: tuple[int, ...] = ()):
        self.keep = word_bytes
        self.prefixes = prefixes
        self.table = stream(7, 256).copy()
        self.table[ord("A") : ord("Z") + 1] = self.table[ord("a") : ord("z") + 1]
        self.up = self.down = _powers(_BASE, 1)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            self.up, self.down = _powers(_BASE, n), _powers(_INVERSE, n)

    def spans(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        edge = np.diff(np.concatenate(([False], self.keep[buf], [False])).view(np.int8))
        return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

    def piece(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Starts, ends, hashes and prefix hashes of the words of ``buf``."""
        starts, ends = self.spans(buf)
        if not len(starts):
            none = np.zeros(0, dtype=U64)
            return starts, ends, none, [none for _ in self.prefixes]
        self._grow(len(buf) + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(buf) + 1, dtype=U64)
            np.cumsum(self.table[buf] * self.up[: len(buf)], out=sums[1:])
            low, back = sums[starts], self.down[starts]
            hashes = mix((sums[ends] - low) * back + (ends - starts).astype(U64))
            heads = []
            for size in self.prefixes:
                at = np.minimum(starts + size, len(buf))
                h = mix((sums[at] - low) * back + U64(size << 32))
                h[ends - starts < size] = 0
                heads.append(h)
        return starts, ends, hashes, heads

    def _cuts(self, data: bytes) -> Iterator[bytes]:
        at = 0
        while at < len(data):
            end = min(len(data), at + PIECE)
            if end < len(data):
                window = np.frombuffer(data, dtype=np.uint8, count=end - at, offset=at)
                gaps = np.flatnonzero(~self.keep[window[::-1]][:65536])
                if len(gaps):
                    end -= int(gaps[0])
                else:  # one word of more than 64 KiB: cut where its run ends
                    while end < len(data) and self.keep[data[end]]:
                        end += 1
            yield data[at:end]
            at = end

    def words(self, text: str | None) -> np.ndarray:
        """Hashes of all words, in order."""
        if not text:
            return np.zeros(0, dtype=U64)
        out = [self.piece(np.frombuffer(p, dtype=np.uint8))[2] for p in self._cuts(text.encode("utf-8", "replace"))]
        return out[0] if len(out) == 1 else np.concatenate(out)

    def features(self, text: str | None) -> np.ndarray:
        """Hashes of all words and of their prefixes, unordered."""
        if not text:
            return np.zeros(0, dtype=U64)
        out = []
        for p in self._cuts(text.encode("utf-8", "replace")):
            _, _, words, heads = self.piece(np.frombuffer(p, dtype=np.uint8))
            out += [words, *(h[h != 0] for h in heads)]
        return np.concatenate(out) if out else np.zeros(0, dtype=U64)


SLICE = 512  # rows of a batch that Python holds at a time


def slices(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in small runs of rows: an Arrow batch of long texts is many
    times larger as Python objects."""
    for part in parts:
        for at in range(0, part.num_rows, SLICE):
            yield part.slice(at, SLICE)


def batches(texts: list[str | None], limit: int = PIECE) -> Iterable[tuple[int, int]]:
    """Index ranges of consecutive texts of about ``limit`` characters each."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "") + 1
        if size >= limit:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def words_of_many(hasher: WordHasher, texts: list[str | None]) -> list[np.ndarray]:
    """``hasher.words`` of every text; short texts are hashed together."""
    out: list[np.ndarray] = []
    for lo, hi in batches(texts):
        if hi - lo == 1:
            out.append(hasher.words(texts[lo]))
            continue
        parts = [(t or "").encode("utf-8", "replace") for t in texts[lo:hi]]
        data = b"\n".join(parts)
        if len(data) > 4 * PIECE:
            out += [hasher.words(t) for t in texts[lo:hi]]
            continue
        starts, _, hashes, _ = hasher.piece(np.frombuffer(data, dtype=np.uint8))
        begins = np.cumsum([0] + [len(p) + 1 for p in parts])
        at = np.searchsorted(starts, begins)
        out += [hashes[a:b] for a, b in zip(at[:-1], at[1:])]
    return out


BLOOM_BITS = 1 << 24  # 2 MB, whatever the number of keys


def bloom(keys: DataFrame, name: str) -> np.ndarray:
    """A bitmap of fixed size that has a bit for every key (a long column); it
    is summed up in Spark, and at most its words come to the driver."""
    bit = F.pmod(F.xxhash64(F.col(name)), F.lit(BLOOM_BITS))
    words = keys.select(bit.alias("bit")).groupBy(F.shiftright("bit", 5).alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 32 AS INT)))").alias("bits")).toArrow()
    out = np.zeros(BLOOM_BITS // 32, dtype=np.uint32)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out


def maybe_in(df: DataFrame, name: str, bitmap: np.ndarray) -> DataFrame:
    """Rows of ``df`` whose key may be among those of the bitmap: all that are,
    and few others as long as the bitmap is sparse."""
    shared = df.sparkSession.sparkContext.broadcast(bitmap)
    keyed = df.withColumn("__tl_bit", F.pmod(F.xxhash64(F.col(name)), F.lit(BLOOM_BITS)))

    def run(parts):
        words = shared.value
        for part in parts:
            bit = part.column("__tl_bit").to_numpy()
            yield part.filter(pa.array((words[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1))

    return keyed.mapInArrow(run, keyed.schema).drop("__tl_bit")
