"""Packing by a space-filling curve: documents as token ids, laid end to end in
the order of a Hilbert curve and cut into sequences.

1. The hashes of a document's ids give a vector that is projected to few dimensions;
   its place on the Hilbert curve is its key.  Places of equal keys (copies) are
   told apart by a number of the row, so that no key is a hot one.
2. Quantiles of the keys of ``SHARD_KEYS`` sampled documents a shard cut the curve
   into shards of about ``SHARD_CHARS`` characters of text each.  They say only
   which task takes a document; they reach the driver, one for each shard.
3. One shuffle brings each document's ids to its shard, sorted along the curve.
   A shard's ids are one run, cut at every ``length`` ids; what is left at its
   end is cut into sequences whose lengths are falling powers of two, which need
   no padding.  Shards need nothing of one another, and a task holds no more
   than the ids of one batch and of an open sequence.

Every id lies in exactly one piece.  A document is its ids and then ``END``; a
null or empty text is ``END`` alone.  Repeated rows are documents of their own;
a null doc_id is kept as it is.  An empty table gives no rows.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import U64, mix, slices
from tideline.llm.curve import hilbert, project

LENGTH, END = 2048, 1
SHARD_CHARS = 1 << 23
SHARD_KEYS = 64  # documents sampled for each shard to find where it begins
MAX_SHARDS = 1 << 16  # of one call; shards grow beyond that
TIE_BITS = 22
WORDS = 1 << 19  # runs of words whose ids a Python worker remembers

# Only these part words here: the tokenizer reads each of them as white space,
# and nothing that it does to a text reaches across white space.
_GAPS, _GAP = " \n\r\t", re.compile(r"[ \n\r\t]")
# Letters that are left as they are by NFC, and by lower case or one for one.  A word
# of them is one run of the pre-tokenizer, and marks behind it are another.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e"
_RUNS = f"^(?P<head>[{_LETTERS}]+)(?P<tail>[!-&(-/:-@\\[-`{{-~]*)$"
_SPREAD = U64(0x9E3779B97F4A7C15)


def _byte_letters() -> np.ndarray:
    """How byte-level tokenizers write a byte, as a code point: itself where it is
    printable, the others in order from U+0100.  Line ends stay what they are."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = np.arange(256, dtype="<u4")
    others = np.setdiff1d(out, plain)
    out[others] = 0x100 + np.arange(len(others))
    out[ord("\n")] = ord("\n")
    return out


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts by a byte-level tokenizer that lower-cases and parts words at
    white space; each different run of letters or marks, or word of anything else,
    is encoded once while it is remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat, self.starts, self.sizes = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def _learn(self, runs: list[str]) -> None:
        """Ids of new runs.  The model has the bytes of lower-case letters at once;
        other runs go through the whole tokenizer."""
        plain = pc.match_substring_regex(pa.array(runs, pa.string()), f"^[{_LETTERS}]+$").to_numpy(zero_copy_only=False)
        found: list[list[int]] = [[]] * len(runs)
        own, rest = np.flatnonzero(plain).tolist(), np.flatnonzero(~plain).tolist()
        text = np.frombuffer("\n".join([runs[i] for i in own]).encode(), dtype=np.uint8)
        tokenize = self.tokenizer.model.tokenize
        for i, raw in zip(own, self.letters[text].tobytes().decode("utf-32-le").split("\n")):
            found[i] = [t.id for t in tokenize(raw)]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([runs[i] for i in rest], add_special_tokens=False)):
            found[i] = e.ids
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        self.flat = np.concatenate([self.flat, np.fromiter(itertools.chain.from_iterable(found), dtype=np.uint32, count=int(sizes.sum()))])
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])

    def _numbers(self, runs: pa.StringArray) -> np.ndarray:
        """Number of each run; the unseen ones are learned."""
        coded, place = runs.dictionary_encode(), self.place
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if new := [x for x in different if x not in place]:
            place.update(zip(new, range(len(place), len(place) + len(new))))
            self._learn(new)
        return np.fromiter(map(place.__getitem__, different), dtype=np.int64, count=len(different))[coded.indices.to_numpy()]

    def _words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and where each word's end."""
        runs = pc.extract_regex(words, _RUNS)
        heads = pc.coalesce(pc.utf8_lower(pc.struct_field(runs, 0)), words)
        tails = pc.coalesce(pc.struct_field(runs, 1), "")
        own = np.stack([self._numbers(heads), self._numbers(tails)], axis=1).ravel()
        at, ends = _spread_out(self.starts[own], self.sizes[own])
        return self.flat[at], ends[1::2]

    def ids(self, texts: list[str | None], limit: int = 1 << 22) -> list[np.ndarray]:
        """Ids of each text; one of more than ``limit`` characters is encoded piece
        by piece, cut where words part."""
        if any(t and len(t) > limit for t in texts):
            return [np.concatenate([x for p in _pieces(t, limit) for x in self.ids([p], len(p))]) if t and len(t) > limit else self.ids([t])[0] for t in texts]
        if len(self.place) > WORDS:
            self.forget()
        parted = pa.array([t or "" for t in texts], pa.string())
        for gap in _GAPS[1:]:
            parted = pc.replace_substring(parted, gap, _GAPS[0])
        parted = pc.split_pattern(parted, _GAPS[0])  # two gaps part an empty word, which has no ids
        coded = parted.values.dictionary_encode()
        flat, ends = self._words(coded.dictionary)
        sizes, words = np.diff(ends, prepend=0), coded.indices.to_numpy()
        at, ends = _spread_out((ends - sizes)[words], sizes[words])
        cuts = np.concatenate([[0], ends])[parted.offsets.to_numpy()]
        flat = flat[at]
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _spread_out(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``sizes`` places from each of ``starts`` on, in a row, and where each ends."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0), ends


def _pieces(text: str, limit: int) -> Iterator[str]:
    at = 0
    while len(text) - at > limit:
        m = _GAP.search(text, at + limit)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


CHARS = 1 << 22  # of the texts that Python encodes at a time


def _runs(part: pa.RecordBatch, limit: int = CHARS) -> Iterator[tuple[int, list[str | None]]]:
    """Consecutive texts of a batch, of about ``limit`` characters at a time."""
    own: list[str | None] = []
    at = size = 0
    for i in range(part.num_rows):
        own.append(part.column("text")[i].as_py())
        size += len(own[-1] or "")
        if size >= limit:
            yield at, own
            at, size, own = i + 1, 0, []
    if own:
        yield at, own


def _places(ids: list[np.ndarray], row: int) -> np.ndarray:
    """Curve place and row number of each document's ids as one number."""
    with np.errstate(over="ignore"):
        keys = hilbert(project([mix(x.astype(U64) * _SPREAD) for x in ids]))
        part = U64(TaskContext.get().partitionId() if TaskContext.get() else 0)
        ties = mix(np.arange(row, row + len(ids), dtype=U64) + (part << U64(40))) >> U64(64 - TIE_BITS)
    return (keys << TIE_BITS) | ties.astype(np.int64)


def _keyed(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, row = _encoder(path), 0
        for part in slices(batches):
            for _, texts in _runs(part):
                keys = _places(model.ids(texts), row)
                row += len(texts)
                yield pa.RecordBatch.from_arrays([pa.array(keys)], names=["place"])

    return run


def shard_bounds(docs: DataFrame, path: str, shard_chars: int = SHARD_CHARS) -> np.ndarray:
    """First places of all shards but the first, ascending: quantiles of the places
    of about ``SHARD_KEYS`` sampled documents for each shard."""
    size = docs.agg(F.count("*").alias("n"), F.sum(F.char_length("text")).alias("chars")).first()
    shards = min(MAX_SHARDS, -(-(size["chars"] or 0) // shard_chars))
    if shards < 2:
        return np.zeros(0, dtype=np.int64)
    sample = docs.sample(min(1.0, SHARD_KEYS * shards / size["n"]), seed=12)
    steps = F.array(*[F.lit(i / shards) for i in range(1, shards)])
    got = sample.select("text").mapInArrow(_keyed(path), "place bigint").agg(F.percentile_approx("place", steps, F.lit(20 * shards)).alias("p")).first()["p"]
    return np.unique(np.array(got or [], dtype=np.int64))


def _tokens(path: str, bounds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, row = _encoder(path), 0
        for part in slices(batches):
            for at, texts in _runs(part):
                ids = model.ids(texts)
                places = _places(ids, row)
                row += len(texts)
                raw = [np.append(x, np.uint32(END)) for x in ids]
                small = [x.astype(np.uint16).tobytes() if x.max() < 1 << 16 else b"" for x in raw]
                large = [None if s else x.tobytes() for s, x in zip(small, raw)]
                cols = [
                    part.column("doc_id").slice(at, len(texts)),
                    pa.array(np.searchsorted(bounds, places, side="right").astype(np.int32)),
                    pa.array(places),
                    pa.array(small, pa.binary()),
                    pa.array(large, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "shard", "place", "ids2", "ids4"])

    return run


class _Shard:
    """Pieces of one shard in its order; holds what lies in the open sequence."""

    def __init__(self, shard: int, length: int):
        self.next, self.length = shard << 32, length
        self.open: list[tuple[object, int, np.ndarray, int]] = []
        self.used = 0

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        at = 0
        while at < len(ids):
            take = min(len(ids) - at, self.length - self.used)
            self.open.append((doc_id, at, ids[at : at + take], len(ids)))
            at, self.used = at + take, self.used + take
            if self.used == self.length:
                yield from self._write(self.open)
                self.open, self.used = [], 0

    def _write(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, total in pieces:
            yield doc_id, start, len(ids), ids.astype("<u4").tobytes(), total, self.next, offset
            offset += len(ids)
        self.next += 1

    def close(self) -> Iterator[tuple]:
        """The rest, in sequences of falling powers of two."""
        rest, left = self.open, self.used
        while left:
            room = size = 1 << (left.bit_length() - 1)
            own = []
            while room:
                doc_id, start, ids, total = rest[0]
                own.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    rest = [(doc_id, start + room, ids[room:], total), *rest[1:]]
                else:
                    rest = rest[1:]
                room -= len(own[-1][2])
            yield from self._write(own)
            left -= size
        self.open, self.used = [], 0


PIECE = "doc_id {id}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
PIECES = 1024  # rows of an output batch


def _packed(length: int, kind: pa.DataType):
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, now, out = None, None, []
        for part in slices(batches):
            ids, shards = part.column("doc_id").to_pylist(), part.column("shard").to_pylist()
            for i in range(part.num_rows):
                if shards[i] != now:
                    out += shard.close() if shard else ()
                    now = shards[i]
                    shard = _Shard(now, length)
                small = part.column("ids2")[i].as_buffer()
                tokens = np.frombuffer(small, dtype=np.uint16) if small.size else np.frombuffer(part.column("ids4")[i].as_buffer(), dtype=np.uint32)
                for piece in shard.add(ids[i], tokens):
                    out.append(piece)
                    if len(out) >= PIECES:
                        yield batch(out)
                        out = []
        out += shard.close() if shard else ()
        if out:
            yield batch(out)

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text): doc_id, start (in its document),
    length, ids (little-endian unsigned 32 bits each), doc_tokens, sequence_id,
    offset (in its sequence).  ``tokenizer`` is a path that all executors read."""
    docs = docs.select("doc_id", "text")
    path = tokenizer or default_tokenizer()
    bounds = shard_bounds(docs, path, shard_chars)
    kind = dict(docs.dtypes)["doc_id"]
    ids = docs.mapInArrow(_tokens(path, bounds), f"doc_id {kind}, shard int, place bigint, ids2 binary, ids4 binary")
    placed = ids.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "place")
    arrow = docs.sparkSession.createDataFrame([], f"doc_id {kind}").toArrow().schema.field("doc_id").type
    return placed.mapInArrow(_packed(length, arrow), PIECE.format(id=kind))
