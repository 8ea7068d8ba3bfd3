"""Ranked lexical search with per-term geometric blocking.

Terms are runs of ASCII letters and digits and of any character beyond ASCII,
A-Z lower-cased.  A term's weight is ``floor(1000 ln((2 N + 2) / (2 df + 1)))``;
a document gives a term the impact ``(1000000000 tf) div (1000 tf + 20 m)`` with
``m = 50 + (50 n N) div L``; its score for a query sums weight times impact over
the query's different terms.  N, L and df count every document.

1. Each document becomes a sparse vector of its terms that some query may ask (a
   bitmap of fixed size tells; the text is read once), and gets a place on a
   Hilbert curve of hashed vectors.
2. The vectors are dealt by range of their places, so that like documents come
   together, into index shards of at most ``SHARD_DOCS`` documents.  In a shard,
   each term's posting list is clustered by document similarity: pivots along the
   list, each posting to the pivot of the largest inner product.  A cluster is a
   block, and stores as its summary the coordinatewise maximum of its documents'
   vectors, over the coordinates that some query asks along with the term.
3. A first pass scores, in each shard, the blocks whose summaries promise most.
   The k-th best score of a query so far is a bound that its k-th best overall
   reaches.  A second pass skips the blocks whose summary bound (the inner
   product with the query) fails it, with all their documents, and scores the
   documents of the others.  The bound of a block holds for each of its
   documents, so none of the best can be lost, nor a tie with the last.

All of it is in integers.  Queries are searched in blocks of about ``ITEM_TERMS``
terms, each sent to all shards, a stated query set against all rows; what a task
returns is at most ``k`` rows for each query.  Terms are compared by 64-bit
hashes.

Defined results: a null or empty text has no terms, as a document and as a
query; documents without terms are not counted in N.  Repeated document rows are
documents of their own; a null doc_id ranks behind equal scores.  Rows of
queries with equal item_id and text are one query; different texts of an item_id
(or of null) are ranked apart.  Without documents or queries there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import BLOOM_BITS, U64, WordHasher, letter_words, mix, slices, staged, words_of_many
from tideline.llm.curve import hilbert, project

TOP = 50
SHARD_DOCS, CELLS = 2048, 1 << 23  # documents, and documents times terms, of an index shard
MAX_PARTS = 1 << 16  # tasks that build the index
BLOCK = 32  # postings of a block, on average
NEAR_DIMS = 32  # of the hashed vectors that lists are clustered by
PROBES = 4  # blocks of a shard that a query's first pass scores
ITEM_TERMS = 1 << 15  # terms of the queries searched at a time
CHUNK = 256  # queries that a task holds a matrix for
TIE_BITS = 22


def query_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, terms) of the different rows of ``items`` (item_id, text);
    terms are their hashes, once each."""
    kind = dict(items.dtypes)["item_id"]
    rows = staged(items.select("item_id", "text").distinct().withColumn("item", F.monotonically_increasing_id()), "search-items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(letter_words())
        for part in slices(batches):
            terms = [np.unique(h).view(np.int64).tolist() for h in words_of_many(hasher, part.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column("item"), part.column("item_id"), pa.array(terms, pa.list_(pa.int64()))], names=["item", "item_id", "terms"])

    return staged(rows.mapInArrow(run, f"item bigint, item_id {kind}, terms array<bigint>"), "search-queries")


def asked(terms: DataFrame) -> np.ndarray:
    """Bitmap of fixed size with a bit for the hash (column ``h``) of each term."""
    bits = terms.select(F.col("h").bitwiseAND(F.lit(BLOOM_BITS - 1)).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 5).alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 32 AS INT)))").alias("bits")).toArrow()
    out = np.zeros(BLOOM_BITS // 32, dtype=np.uint32)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out


VECTOR = "doc_id {id}, n bigint, place bigint, terms array<bigint>, tfs array<bigint>"


def vectors_of(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """Documents that have terms: their number, the terms that may be asked, how
    often each occurs, and the place on the curve."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, words, row = WordHasher(letter_words()), shared.value, 0
        task = U64(TaskContext.get().partitionId())
        for part in slices(batches):
            hashes = words_of_many(hasher, part.column("text").to_pylist())
            some = np.flatnonzero([len(h) > 0 for h in hashes])
            terms, tfs = [], []
            for i in some:
                h = hashes[i]
                bit = (h & U64(BLOOM_BITS - 1)).astype(np.int64)
                u, c = np.unique(h[(words[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1], return_counts=True)
                terms.append(u)
                tfs.append(c)
            with np.errstate(over="ignore"):
                ties = mix(np.arange(row, row + len(some), dtype=U64) + (task << U64(40))) >> U64(64 - TIE_BITS)
            row += len(some)
            place = (hilbert(project(terms, tfs)) << TIE_BITS) | ties.astype(np.int64)
            cols = [
                part.column("doc_id").take(pa.array(some)),
                pa.array([len(hashes[i]) for i in some], pa.int64()),
                pa.array(place, pa.int64()),
                pa.array([u.view(np.int64) for u in terms], pa.list_(pa.int64())),
                pa.array(tfs, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n", "place", "terms", "tfs"])

    return staged(docs.select("doc_id", "text").mapInArrow(run, VECTOR.format(id=kind)), "search-vectors")


def document_counts(vectors: DataFrame) -> DataFrame:
    """(h, df): documents that hold each term; a task sums up what it has read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for part in batches:
            h = np.concatenate([seen, part.column("terms").flatten().to_numpy()])
            seen, inverse = np.unique(h, return_inverse=True)
            counts = np.bincount(inverse, np.concatenate([counts, np.ones(len(h) - len(counts), dtype=np.int64)]), minlength=len(seen)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts)], names=["h", "n"])

    return vectors.select("terms").mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("df"))


# -- index ---------------------------------------------------------------------------

ARRAYS = {"docs": np.int64, "nulls": np.bool_, "vocabulary": np.int64, "lists": np.int32, "post_doc": np.int32, "post_impact": np.int32, "blocks": np.int32, "starts": np.int32, "columns": np.int32, "column": np.int32, "maxima": np.int32}
INDEX = ", ".join(f"{name} binary" for name in ARRAYS)


@dataclass
class Queries:
    """A block of queries: ``ptr`` cuts ``terms`` (hashes, ascending) and weights."""

    items: np.ndarray
    ptr: np.ndarray
    terms: np.ndarray
    weights: np.ndarray

    def together(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The vocabulary, and for each of its terms (CSR) the terms that a query
        asks along with it."""
        vocabulary, at = np.unique(self.terms, return_inverse=True)
        holders = np.argsort(at, kind="stable")
        owner = np.repeat(np.arange(len(self.items)), np.diff(self.ptr))[holders]
        cuts = np.searchsorted(at[holders], np.arange(len(vocabulary) + 1))
        along = [np.unique(np.concatenate([at[self.ptr[i] : self.ptr[i + 1]] for i in owner[a:b]])) for a, b in zip(cuts[:-1], cuts[1:])]
        return vocabulary, np.concatenate([[0], np.cumsum([len(x) for x in along])]).astype(np.int64), np.concatenate(along) if along else at


def clustered(docs: np.ndarray, near: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """A posting list (documents in the order of the curve) by block, and where
    blocks start: each document goes to the pivot of the largest inner product."""
    if len(docs) <= block:
        return np.arange(len(docs)), np.zeros(1, dtype=np.int64)
    pivots = docs[np.linspace(0, len(docs) - 1, -(-len(docs) // block)).astype(np.int64)]
    home = (near[docs] @ near[pivots].T).argmax(axis=1)
    order = np.argsort(home, kind="stable")
    return order, np.flatnonzero(np.diff(home[order], prepend=-1))


def build_shard(ids: list, impacts: list[np.ndarray], terms: list[np.ndarray], along: tuple[np.ndarray, np.ndarray, np.ndarray], block: int = BLOCK) -> Iterator[dict[str, np.ndarray]]:
    """The index of some documents, in more than one shard if they have too many
    different terms.  ``terms`` are positions in the queries' vocabulary."""
    vocabulary, along_ptr, along_terms = along
    sizes = np.array([len(t) for t in terms])
    own, local = np.unique(np.concatenate(terms), return_inverse=True)
    if len(ids) > 1 and len(ids) * len(own) > CELLS:
        half = len(ids) // 2
        yield from build_shard(ids[:half], impacts[:half], terms[:half], along, block)
        yield from build_shard(ids[half:], impacts[half:], terms[half:], along, block)
        return
    doc, impact = np.repeat(np.arange(len(ids)), sizes), np.concatenate(impacts)
    dense = np.zeros((len(ids), len(own)), dtype=np.int32)
    dense[doc, local] = impact
    near = project([vocabulary[t].view(U64) for t in terms], [x.astype(np.float64) for x in impacts], NEAR_DIMS)
    order = np.argsort(local, kind="stable")
    lists = np.searchsorted(local[order], np.arange(len(own) + 1))
    post_doc, post_impact = doc[order], impact[order]
    blocks, starts, columns, column, maxima = [0], [], [0], [], []
    for t in range(len(own)):
        a, b = lists[t], lists[t + 1]
        by, cuts = clustered(post_doc[a:b], near, block)
        post_doc[a:b], post_impact[a:b] = post_doc[a:b][by], post_impact[a:b][by]
        asked_along = along_terms[along_ptr[own[t]] : along_ptr[own[t] + 1]]
        at = np.searchsorted(own, asked_along)
        at = at[np.where(at < len(own), own[np.minimum(at, len(own) - 1)], -1) == asked_along]
        maxima.append(np.maximum.reduceat(dense[post_doc[a:b][:, None], at[None, :]], cuts, axis=0).ravel())
        starts.append(cuts + a)
        column.append(at)
        blocks.append(blocks[-1] + len(cuts))
        columns.append(columns[-1] + len(at))
    out = {
        "docs": [0 if i is None else i for i in ids], "nulls": [i is None for i in ids], "vocabulary": vocabulary[own], "lists": lists, "post_doc": post_doc, "post_impact": post_impact,
        "blocks": blocks, "starts": np.concatenate(starts), "columns": columns, "column": np.concatenate(column), "maxima": np.concatenate(maxima),
    }
    yield {k: np.asarray(v, dtype=ARRAYS[k]) for k, v in out.items()}


def index(vectors: DataFrame, queries: Queries, n_docs: int, n_terms: int, shard_docs: int = SHARD_DOCS, block: int = BLOCK) -> DataFrame:
    """The index of all documents that hold a term of ``queries``: a row a shard."""
    along = queries.together()
    shared = vectors.sparkSession.sparkContext.broadcast(along)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value[0]
        ids, impacts, terms = [], [], []

        def full() -> Iterator[pa.RecordBatch]:
            for made in build_shard(ids, impacts, terms, shared.value, block):
                yield pa.RecordBatch.from_arrays([pa.array([made[k].tobytes()], pa.binary()) for k in ARRAYS], names=list(ARRAYS))

        for part in slices(batches):
            ends = np.cumsum(part.column("terms").value_lengths().to_numpy())
            flat, tfs = part.column("terms").flatten().to_numpy(), part.column("tfs").flatten().to_numpy()
            at = np.searchsorted(vocabulary, flat)
            found = vocabulary[np.minimum(at, len(vocabulary) - 1)] == flat
            for i, (doc_id, n) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("n").to_pylist())):
                cut = slice(int(ends[i - 1]) if i else 0, int(ends[i]))
                held, tf = at[cut][found[cut]], tfs[cut][found[cut]]
                if len(held):
                    m = 50 + 50 * n * n_docs // n_terms
                    ids.append(doc_id)
                    order = np.argsort(held)
                    terms.append(held[order])
                    impacts.append(((1_000_000_000 * tf) // (1000 * tf + 20 * m))[order])
                    if len(ids) == shard_docs:
                        yield from full()
                        ids, impacts, terms = [], [], []
        if ids:
            yield from full()

    parts = max(1, min(MAX_PARTS, -(-n_docs // (2 * shard_docs))))  # a task builds one shard after another
    placed = vectors.repartitionByRange(parts, "place").sortWithinPartitions("place")
    return staged(placed.mapInArrow(run, INDEX), "search-index")


# -- search --------------------------------------------------------------------------


class Best:
    """The ``k`` best (score, doc_id) of each query that a task has seen."""

    def __init__(self, queries: int, k: int):
        self.k, self.rows = k, [(np.zeros(0, dtype=np.int64),) * 3 for _ in range(queries)]

    def floor(self, q: int) -> int:
        """A score that the k-th best reaches; 1 while there are fewer."""
        scores = self.rows[q][0]
        return int(scores[-1]) if len(scores) == self.k else 1

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        s, i, n = (np.concatenate(x) for x in zip(self.rows[q], (scores, ids, nulls.astype(np.int64))))
        first = np.lexsort((i, n, -s))[: self.k]
        self.rows[q] = (s[first], i[first], n[first])


class Shard:
    """One index row with the queries of a block looked up in it."""

    def __init__(self, part: pa.RecordBatch):
        for name, kind in ARRAYS.items():
            setattr(self, name, np.frombuffer(part.column(name)[0].as_buffer(), dtype=kind))
        self.offsets = np.concatenate([[0], np.cumsum(np.diff(self.blocks).astype(np.int64) * np.diff(self.columns))])

    def look_up(self, q: Queries) -> None:
        at = np.minimum(np.searchsorted(self.vocabulary, q.terms), len(self.vocabulary) - 1)
        held = np.flatnonzero(self.vocabulary[at] == q.terms)
        self.owner = np.repeat(np.arange(len(q.items)), np.diff(q.ptr))[held]
        self.term, self.weight = at[held], q.weights[held]

    def bounds(self, lo: int, hi: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of each term: the queries of ``lo..hi`` that ask it, and a bound of every
        score in each block of its list: (term, queries, bounds[block, query])."""
        own = np.flatnonzero((self.owner >= lo) & (self.owner < hi))
        weights = np.zeros((hi - lo, len(self.vocabulary)))  # sums stay below 2^53
        weights[self.owner[own] - lo, self.term[own]] = self.weight[own]
        order = own[np.argsort(self.term[own], kind="stable")]
        for of in np.split(order, np.flatnonzero(np.diff(self.term[order])) + 1):
            if len(of):
                t, asking = int(self.term[of[0]]), self.owner[of]
                cols = self.column[self.columns[t] : self.columns[t + 1]]
                top = self.maxima[self.offsets[t] : self.offsets[t + 1]].reshape(-1, len(cols))
                yield t, asking, top.astype(np.float64) @ weights[asking - lo][:, cols].T

    def block_postings(self, t: int) -> np.ndarray:
        """Which block of its list each posting of a term is in."""
        starts = self.starts[self.blocks[t] : self.blocks[t + 1]]
        return np.repeat(np.arange(len(starts)), np.diff(np.append(starts, self.lists[t + 1])))

    def score(self, q: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the mask ``wanted`` and their exact scores for a query."""
        own = np.flatnonzero(self.owner == q) if self.ends is None else slice(self.ends[q], self.ends[q + 1])
        total = np.zeros(len(self.docs), dtype=np.int64)
        for t, w in zip(self.term[own].tolist(), self.weight[own].tolist()):
            a, b = self.lists[t], self.lists[t + 1]
            docs = self.post_doc[a:b]
            keep = wanted[docs]
            total[docs[keep]] += w * self.post_impact[a:b][keep].astype(np.int64)
        found = np.flatnonzero(wanted)
        return found, total[found]

    ends: np.ndarray | None = None


def _search(index_rows: DataFrame, queries: Queries, k: int, floors: np.ndarray | None) -> DataFrame:
    """(item, doc_id, score): the best of each task.  Without ``floors`` only the
    most promising blocks are scored; with them, all whose bound reaches them."""
    shared = index_rows.sparkSession.sparkContext.broadcast((queries, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, least = shared.value
        best = Best(len(q.items), k)
        for part in batches:
            for i in range(part.num_rows):
                shard = Shard(part.slice(i, 1))
                shard.look_up(q)
                shard.ends = np.searchsorted(shard.owner, np.arange(len(q.items) + 1))
                for lo in range(0, len(q.items), CHUNK):
                    hi = min(lo + CHUNK, len(q.items))
                    wanted = np.zeros((hi - lo, len(shard.docs)), dtype=bool)
                    if least is None:
                        _probe(shard, lo, hi, wanted)
                    else:
                        _reach(shard, lo, hi, wanted, np.array([max(int(least[x]), best.floor(x)) for x in range(lo, hi)]))
                    for x in np.flatnonzero(wanted.any(axis=1)):
                        docs, scores = shard.score(lo + x, wanted[x])
                        good = scores >= best.floor(lo + x)
                        best.add(lo + x, scores[good], shard.docs[docs[good]], shard.nulls[docs[good]])
        sizes = [len(r[0]) for r in best.rows]
        if sum(sizes):
            score, ids, nulls = (np.concatenate(x) for x in zip(*best.rows))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q.items, sizes)), pa.array(ids, mask=nulls.astype(bool)), pa.array(score)], names=["item", "doc_id", "score"])

    return index_rows.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def _reach(shard: Shard, lo: int, hi: int, wanted: np.ndarray, floor: np.ndarray) -> None:
    """Mark the documents whose blocks all reach the floor of the query: one block
    whose bound fails tells of each of its documents that it scores less, in
    whatever other lists it is."""
    failed = np.zeros_like(wanted)
    for t, asking, bounds in shard.bounds(lo, hi):
        docs, rows = shard.post_doc[shard.lists[t] : shard.lists[t + 1]], (asking - lo)[:, None]
        alive = (bounds >= floor[asking - lo])[shard.block_postings(t)].T
        wanted[rows, docs[None, :]] |= alive
        failed[rows, docs[None, :]] |= ~alive
    wanted &= ~failed


def _probe(shard: Shard, lo: int, hi: int, wanted: np.ndarray) -> None:
    """Mark the documents of the ``PROBES`` blocks of the highest bounds."""
    tops: list[list[tuple]] = [[] for _ in range(hi - lo)]
    for t, asking, bounds in shard.bounds(lo, hi):
        first = bounds.argmax(axis=0)
        for x, b, bound in zip((asking - lo).tolist(), first.tolist(), bounds[first, np.arange(len(asking))].tolist()):
            tops[x].append((bound, t, b))
    for x, found in enumerate(tops):
        for _, t, b in sorted(found, reverse=True)[:PROBES]:
            at = shard.blocks[t] + b
            end = shard.starts[at + 1] if at + 1 < shard.blocks[t + 1] else shard.lists[t + 1]
            wanted[x, shard.post_doc[shard.starts[at] : end]] = True


def _first(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, shard_docs: int = SHARD_DOCS, block: int = BLOCK, item_terms: int = ITEM_TERMS) -> DataFrame:
    """The ``k`` best documents (doc_id, text) of every row of ``items`` (item_id,
    text): item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    queries = query_terms(items)
    terms = queries.select("item", F.explode("terms").alias("h"))
    vectors = vectors_of(docs, asked(terms))
    total = vectors.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = int(total["docs"]), int(total["terms"] or 0)
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    weighed = staged(terms.join(document_counts(vectors), "h").select("item", "h", weight.alias("w")).filter(F.col("w") > 0), "search-terms")
    blocks = -(-weighed.count() // item_terms)
    found = [spark.createDataFrame([], "item bigint, doc_id bigint, score bigint")]
    for b in range(blocks):
        own = weighed.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).toArrow()  # about item_terms rows
        if own.num_rows:
            item, h, w = (own.column(c).to_numpy() for c in ("item", "h", "w"))
            order = np.lexsort((h, item))
            each, starts = np.unique(item[order], return_index=True)
            block_of = Queries(each, np.append(starts, len(order)), h[order], w[order])
            shards = index(vectors, block_of, n_docs, n_terms, shard_docs, block)
            probed = staged(_search(shards, block_of, k, None), "search-probes", 1)
            kth = _first(probed, k).filter(F.col("rank") == k).select("item", "score").toArrow()  # a row a query
            floors = np.ones(len(each), dtype=np.int64)
            floors[np.searchsorted(each, kth.column("item").to_numpy())] = kth.column("score").to_numpy()
            found.append(staged(_search(shards, block_of, k, floors), "search-found", 1))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return _first(rows, k).join(queries.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
