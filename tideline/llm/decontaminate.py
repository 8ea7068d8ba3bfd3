"""Benchmark decontamination: word edit distance by the CGK embedding and LSH.

A document leaks an item if some run of its words is within ``0.2 * n`` word
edits of the item's n words (words are lower-cased runs of letters and digits,
so case, punctuation and white space of any script do not count; in scripts
written without spaces, each character is a word).

For every block of items (bounded, so that an index fits a task):

1. Of an item of n words, at most ``2 t`` of its ``n - 1`` word pairs are hurt
   by t edits, so a place in a document can only hold it if a run of ``n + t``
   words has ``n - 1 - 2 t`` of its pairs.  This count loses nothing and leaves
   few places.
2. At these places the CGK walk is run over item-sized windows: a random bit of
   (step, word) says whether the walk moves on, and the word at each step is
   the embedding, whose Hamming distance follows the edit distance.  A
   repetition samples ``BITS`` steps into a key; equal keys of window and item
   make a candidate.  ``repetitions`` are set for the target recall.
3. Candidates are verified by the exact edit distance of the item to the best
   run of words around the place (bit-parallel), for all that the LSH found.

Items are read in blocks of ``ITEM_BLOCK``, one at a time (with more than one
block, its leaks are written first); documents are scanned once for each
block, without a shuffle.  Items of under ``MIN_WORDS`` words, of which no edit
is allowed, are found by the keys of windows of their size.  Items without words
and null or empty texts leak nothing; repeated rows are reported once each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import U64, WordHasher, letter_words, mix, spaced, staged, stream, words_of_many

ITEM_BLOCK = 4096
MIN_WORDS = 5
EDITS = 0.2  # of an item's words
BITS = 2  # sampled steps in a key
AGREE = 0.5  # chance that window and item agree at a sampled step, at EDITS
WINDOWS = 1 << 14  # windows embedded at a time
SPREAD = 1.25  # greatest size of an item over the least, in one class


def repetitions(recall: float) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - AGREE**BITS))


def allowed(n: int) -> int:
    return int(EDITS * n)


def best_run(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least word edit distance of ``pattern`` to any run of ``text``, and
    where that run ends (exclusive); a bit of an integer for each word."""
    masks: dict[int, int] = {}
    for i, w in enumerate(pattern.tolist()):
        masks[w] = masks.get(w, 0) | (1 << i)
    m = len(pattern)
    top, full = 1 << (m - 1), (1 << m) - 1
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text.tolist()):
        eq = masks.get(w, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (~(xh | plus) & full)
        mh = plus & xh
        score += 1 if ph & top else (-1 if mh & top else 0)
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        plus = mh | (~(xv | ph) & full)
        minus = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


@dataclass
class SizeClass:
    """Items of about one size."""

    low: int  # words of its shortest item: the window that is embedded
    steps: np.ndarray  # sampled steps, repetitions x BITS


class Index:
    def __init__(self, items: list[tuple[int, np.ndarray]], recall: float, seed: int = 3):
        self.items = items
        self.reps = repetitions(recall)
        self.seeds = stream(seed, self.reps)
        n = np.array([len(w) for _, w in items], dtype=np.int64)
        edits = np.array([allowed(x) for x in n.tolist()], dtype=np.int64)
        self.reach, self.need = n + edits, n - 1 - 2 * edits
        pairs = [np.unique(self.pairs(w)) for _, w in items] or [np.zeros(0, U64)]
        owner = np.repeat(np.arange(len(pairs)), [len(x) for x in pairs])
        order = np.argsort(np.concatenate(pairs), kind="stable")
        self.owner = owner[order]  # the items of a pair lie together
        self.known, self.first = np.unique(np.concatenate(pairs)[order], return_index=True)
        self.first = np.append(self.first, len(owner))
        self.classes: list[SizeClass] = []
        self.size_class = np.zeros(len(items), dtype=np.int64)
        self.keys = np.zeros((self.reps, len(items)), dtype=U64)
        by_size = sorted(range(len(items)), key=lambda i: len(items[i][1]))
        at = 0
        while at < len(by_size):
            low = len(items[by_size[at]][1])
            own = [i for i in by_size[at:] if len(items[i][1]) <= low * SPREAD]
            at += len(own)
            rng = np.random.default_rng([seed, low])
            steps = np.sort(np.stack([rng.choice(2 * low, BITS, replace=False) for _ in range(self.reps)]), axis=1)
            c = SizeClass(low, steps)
            self.size_class[own] = len(self.classes)
            starts = np.cumsum([0] + [len(items[i][1]) for i in own])[:-1]
            self.keys[:, own] = self.embed(np.concatenate([items[i][1] for i in own]), starts, starts + low, c)
            self.classes.append(c)

    @staticmethod
    def pairs(words: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(words[:-1] * U64(3) + words[1:])

    def embed(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray, c: SizeClass) -> np.ndarray:
        """Keys of the windows ``words[starts:ends]``: repetitions x windows."""
        padded = np.append(words, U64(0))
        at = np.tile(starts, (self.reps, 1))
        keys = np.repeat(self.seeds[:, None], len(starts), axis=1)
        odd = (self.seeds | U64(1))[:, None]
        with np.errstate(over="ignore"):
            for step in range(int(c.steps.max()) + 1):
                inside = at < ends
                word = np.where(inside, padded[np.where(inside, at, -1)], U64(0))
                for r in np.flatnonzero((c.steps == step).any(axis=1)):
                    keys[r] = mix(keys[r] ^ (word[r] + U64(step)))
                coin = ((word * odd + U64(step // 48)) >> U64(8 + step % 48)) & U64(1)
                at += inside & coin.astype(bool)
        return keys

    def places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(items, starts) where a run of the words has pairs enough of an item."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(words) < 2 or not len(self.known):
            return none
        pairs = self.pairs(words)
        at = np.minimum(np.searchsorted(self.known, pairs), len(self.known) - 1)
        hits = np.flatnonzero(self.known[at] == pairs)
        least, longest = int(self.need.min()), int(self.reach.max())
        if len(hits) < least or (hits[least - 1 :] - hits[: len(hits) - least + 1]).min() >= longest:
            return none
        lo, count = self.first[at[hits]], self.first[at[hits] + 1] - self.first[at[hits]]
        pos = np.repeat(hits, count)
        item = self.owner[np.repeat(lo - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())]
        order = np.lexsort((pos, item))
        item, pos = item[order], pos[order]
        end = np.arange(len(item)) + self.need[item] - 1  # the last of the pairs needed, from each pair on
        inside = np.minimum(end, len(item) - 1)
        ok = np.flatnonzero((end < len(item)) & (item[inside] == item) & (pos[inside] - pos < self.reach[item]))
        if not len(ok):
            return none
        begin = np.maximum(0, pos[inside[ok]] - self.reach[item[ok]] + 2)  # starts whose run holds them all
        count = np.maximum(0, pos[ok] - begin + 1)
        starts = np.repeat(begin - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        both = np.unique(np.repeat(item[ok], count) * len(words) + starts)
        return both // len(words), both % len(words)

    def leaks(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, first word, end, edits) of every item that a text holds.
        The windows of all the texts are embedded together."""
        found: dict[tuple[int, int], list[int]] = {}
        docs, base, kept, items, starts, whose = [], [0], [], [], [], []
        for d, words in enumerate(texts):
            item, start = self.places(words)
            if len(item):
                whose.append(np.full(len(item), len(docs)))
                docs.append(d)
                items.append(item)
                starts.append(start + base[-1])
                kept.append(words)
                base.append(base[-1] + len(words))
        if not docs:
            return
        words, item, start, who, end = np.concatenate(kept), np.concatenate(items), np.concatenate(starts), np.concatenate(whose), np.array(base)
        for k, c in enumerate(self.classes):
            own = np.flatnonzero(self.size_class[item] == k)
            for lo in range(0, len(own), WINDOWS):
                w = own[lo : lo + WINDOWS]
                keys = self.embed(words, start[w], np.minimum(start[w] + c.low, end[who[w] + 1]), c)
                for j in w[(keys == self.keys[:, item[w]]).any(axis=0)].tolist():
                    found.setdefault((docs[who[j]], int(item[j])), []).append(int(start[j] - end[who[j]]))
        for (d, i), at in sorted(found.items()):
            if best := self.verify(texts[d], i, sorted(at)):
                yield d, i, *best

    def verify(self, words: np.ndarray, item: int, places: list[int]) -> tuple[int, int, int] | None:
        """First word, end and edits of the best run near the places, if it is
        within the edits allowed."""
        own = self.items[item][1]
        n, t = len(own), allowed(len(own))
        best, k = None, 0
        while k < len(places):  # places that overlap are looked at together
            first = max(0, places[k] - t - 1)
            while k + 1 < len(places) and places[k + 1] - places[k] <= n:
                k += 1
            end = min(len(words), places[k] + n + 2 * t + 1)
            k += 1
            edits, stop = best_run(own, words[first:end])
            if edits <= t and (best is None or edits < best[2]):
                stop += first
                back = max(first, stop - n - t)
                _, length = best_run(own[::-1], words[back:stop][::-1])
                best = (stop - length, stop, edits)
        return best


class Exact:
    """Items of under ``MIN_WORDS`` words: a run of the words has to equal them."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.items = items
        self.sizes: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        for n in sorted({len(w) for _, w in items}):
            own = np.array([i for i, (_, w) in enumerate(items) if len(w) == n])
            keys = np.concatenate([self.keys(items[i][1], n) for i in own])
            order = np.argsort(keys, kind="stable")
            known, first = np.unique(keys[order], return_index=True)
            self.sizes.append((n, own[order], known, np.append(first, len(own))))

    @staticmethod
    def keys(words: np.ndarray, n: int) -> np.ndarray:
        """Keys of all runs of n words."""
        runs = len(words) - n + 1
        out = np.full(runs, n, dtype=U64)
        with np.errstate(over="ignore"):
            for i in range(n):
                out = mix(out * U64(3) + words[i : i + runs])
        return out

    def leaks(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
        """As of ``Index``; the place is the first."""
        for d, words in enumerate(texts):
            for n, owner, known, first in self.sizes:
                if len(words) < n:
                    continue
                keys, place = np.unique(self.keys(words, n), return_index=True)
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                for k in np.flatnonzero(known[at] == keys):
                    start = int(place[k])
                    for i in owner[first[at[k]] : first[at[k] + 1]].tolist():
                        if (words[start : start + n] == self.items[i][1]).all():
                            yield d, i, start, start + n, 0


LEAKS = "doc_id long, item_id long, first_word long, end_word long, edits int, item_words int"


def _scanner(items: list[tuple[int, str]], recall: float):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(letter_words())
        words = [(i, hasher.words(spaced((t or "").lower()))) for i, t in items]
        index = Index([x for x in words if len(x[1]) >= MIN_WORDS], recall)
        exact = Exact([x for x in words if 0 < len(x[1]) < MIN_WORDS])
        for part in parts:
            rows = []
            ids = part.column("doc_id").to_pylist()
            texts = words_of_many(hasher, [spaced((t or "").lower()) for t in part.column("text").to_pylist()])
            for own in (index, exact):
                for d, i, first, end, edits in own.leaks(texts):
                    rows.append((ids[d], own.items[i][0], first, end, edits, len(own.items[i][1])))
            if rows:
                cols = list(zip(*rows))
                kinds = [pa.int64()] * 4 + [pa.int32()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "item_id", "first_word", "end_word", "edits", "item_words"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, recall: float = 0.99) -> DataFrame:
    """One row for each document and item it leaks (its best place)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.col("text").isNotNull())
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    out = None
    for b in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        rows = [(r["item_id"], r["text"]) for r in own.collect()]  # one block of the benchmark
        found = docs.mapInArrow(_scanner(rows, recall), LEAKS)
        if blocks > 1:  # no plan holds a block of items once the next is read
            found = staged(found, "leaks")
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, recall: float = 0.99) -> DataFrame:
    """``docs`` without the documents that leak an item.  Rows whose doc_id is
    null are judged by their text, like all others."""
    key = F.xxhash64(F.col("doc_id"), F.col("text"))
    keyed = docs.withColumn("__tl_row", key)
    bad = leaks(keyed.select(F.col("__tl_row").alias("doc_id"), "text"), benchmark, recall).select(F.col("doc_id").alias("__tl_row")).distinct()
    return keyed.join(bad, "__tl_row", "left_anti").drop("__tl_row")
