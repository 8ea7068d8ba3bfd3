"""Jaccard self-join over word shingles by T-occurrence search.

A document is its set of distinct shingle hashes (64 bits).  Two sets of sizes
a <= b link when ``100 * overlap >= percent * union``, which asks for an
overlap of ``T = ceil(percent * (a + b) / (100 + percent))``.

* Heavy shingles: every task counts the shingles of its own distinct sets; the
  local repeats are summed, and the most frequent (at most ``HEAVY_KEYS``) are
  the long inverted lists.  One global order holds for all documents: short
  lists first, by hash; long lists last, by count.
* A set of size n enters the inverted lists of its first ``n - T + 1`` shingles
  in that order (T for the smallest partner it can have).  Two sets that link
  share one of these, whatever the order, so none is lost.  The order only
  keeps long lists out of the merge.
* Merge: lists with one set vanish in the sorted scan; lists of sets that
  already are in one component vanish in an aggregate of ``min`` and ``max``.
  Of T common shingles at most ``T' - 1`` lie beyond the prefix of a set whose
  own least overlap is T', so a pair that links meets in ``S = T - T' + 1`` lists
  at least.  Each set leaves its ``S - 1`` longest lists out; the short ones are
  joined on the shingle (Spark's sort-merge is the heap merge).
* Probe: a pair that met is looked up in all lists, long ones included, and goes
  if it shares fewer than S.  Then a candidate's shingles are looked up in the
  partner's sorted array by binary search, and the pair stays if the overlap
  reaches T.

Before the merge, sets that share two of three minimum hashes with the least
set of one of them are compared with it.  What is left and shares many lists with a component is compared with
some of its members.  This is linear, joins most copies, and lets the merge
skip the pairs inside a component: the result names components,
so links between sets already joined are not needed.

Empty sets link with nothing.  Equal sets are one node.  A null doc_id never
names a component, but its text links like any other: a component that holds an
id is named for all its rows, and one of null ids only stays null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import U64, WordHasher, bloom, maybe_in, mix, slices, staged, stream, white_space_words, words_of_many
from tideline.llm.components import components

SEEDS = 3  # minimum hashes of a set
AGREE = 2  # of them that a set shares with its leader
TRIES = 8  # members of a component that a set is compared with before the merge
HEAVY_LOCAL = 3  # repeats in one task from which a shingle is reported
HEAVY_TOTAL = 32  # reported repeats from which it counts as heavy
HEAVY_KEYS = 1 << 19  # heavy shingles known to all tasks, 8 bytes each


def least_overlap(n: int, percent: int) -> int:
    """T with the smallest partner a set of size n can link to."""
    return -(-percent * n // 100)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of the whole sequence if
    it is shorter."""
    n = len(words)
    if not n:
        return words
    width = min(k, n)
    odd = stream(13, k) | U64(1)
    with np.errstate(over="ignore"):
        acc = words[: n - width + 1] * odd[0]
        for j in range(1, width):
            acc += words[j : n - width + 1 + j] * odd[j]
        acc = np.sort(mix(acc + U64(width)))
    return acc[np.concatenate(([True], acc[1:] != acc[:-1]))]


def _signature(tokens: np.ndarray) -> int:
    """A hash of the set: the sum of its members, which are hashes."""
    with np.errstate(over="ignore"):
        return int(mix(np.add.reduce(tokens) + U64(len(tokens))).view(np.int64))


def _sets(part: pa.RecordBatch, hasher: WordHasher, k: int) -> Iterator[tuple[int, np.ndarray]]:
    texts = part.column("text").to_pylist()
    for i, words in enumerate(words_of_many(hasher, texts)):
        yield i, shingle_set(words, k)


HEADS = "doc_id long, __tl_key long, n int, sig long, " + ", ".join(f"mh{j} long" for j in range(SEEDS)) + ", token long, held long"


def _head_rows(k: int):
    salts = stream(17, SEEDS) | U64(1)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(white_space_words())
        seen: set[int] = set()
        counts: dict[int, int] = {}
        waiting: list[np.ndarray] = []
        size = 0

        def fold_in() -> None:
            """Adds what repeats among the waiting sets to the task's counts."""
            nonlocal size
            if waiting:
                token, held = np.unique(np.concatenate(waiting), return_counts=True)
                many = held >= HEAVY_LOCAL
                for t, c in zip(token[many].view(np.int64).tolist(), held[many].tolist()):
                    counts[t] = counts.get(t, 0) + c
                waiting.clear()
            size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if counts:
                n = len(counts)
                none = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [none, none, pa.nulls(n, pa.int32()), none, *[none] * SEEDS, pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
                    names=names,
                )
                counts.clear()

        names = ["doc_id", "__tl_key", "n", "sig", *(f"mh{j}" for j in range(SEEDS)), "token", "held"]
        for part in slices(parts):
            n, sig, mins = [], [], [[] for _ in range(SEEDS)]
            for _, tokens in _sets(part, hasher, k):
                n.append(len(tokens))
                if not len(tokens):
                    sig.append(0)
                    for m in mins:
                        m.append(None)
                    continue
                sig.append(s := _signature(tokens))
                with np.errstate(over="ignore"):
                    for m, salt in zip(mins, salts):
                        m.append(int((tokens * salt).min().view(np.int64)))
                if s not in seen:
                    seen.add(s)
                    waiting.append(tokens)
                    size += len(tokens)
                    if size > 1 << 20:
                        fold_in()
                        if len(counts) > 1 << 17:
                            yield from flush()
            rows = part.num_rows
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("__tl_key"), pa.array(n, pa.int32()), pa.array(sig, pa.int64()), *(pa.array(m, pa.int64()) for m in mins), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64())],
                names=names,
            )
        fold_in()
        yield from flush()

    return run


def _prefix_rows(k: int, percent: int, heavy: np.ndarray, rank: np.ndarray):
    """(token, long list?, sig, n) of the first shingles of every distinct set."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(white_space_words())
        seen: set[int] = set()
        for part in slices(parts):
            tokens_out, sig_out, n_out, long_out = [], [], [], []
            for _, tokens in _sets(part, hasher, k):
                if not len(tokens) or (s := _signature(tokens)) in seen:
                    continue
                seen.add(s)
                take = len(tokens) - least_overlap(len(tokens), percent) + 1
                if len(heavy):
                    at = np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)
                    is_long = heavy[at] == tokens
                    light = tokens[~is_long]
                    first = light[:take]
                    if len(first) < take:
                        late = tokens[is_long][np.argsort(rank[at[is_long]], kind="stable")][: take - len(first)]
                        long_out.append(np.r_[np.zeros(len(first), bool), np.ones(len(late), bool)])
                        first = np.concatenate([first, late])
                    else:
                        long_out.append(np.zeros(len(first), bool))
                else:
                    first = tokens[:take]
                    long_out.append(np.zeros(len(first), bool))
                tokens_out.append(first)
                sig_out.append(np.full(len(first), s, dtype=np.int64))
                n_out.append(np.full(len(first), len(tokens), dtype=np.int32))
            if tokens_out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens_out).view(np.int64)), pa.array(np.concatenate(sig_out)), pa.array(np.concatenate(n_out)), pa.array(np.concatenate(long_out))],
                    names=["token", "sig", "n", "long"],
                )

    return run


def _repeated(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, sig), distinct ones whose token is in a long
    list or has another set; holds back the rows of one token at a time, and of
    those only the first."""
    held: tuple | None = None  # the first row of the current token, not yet given out
    token = sig = None
    for part in parts:
        if not part.num_rows:
            continue
        t, s, n, lo = (part.column(c).to_numpy(zero_copy_only=False) for c in ("token", "sig", "n", "long"))
        fresh = np.ones(len(t), bool)
        fresh[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1])
        fresh[0] = not (t[0] == token and s[0] == sig)
        last = (t[-1], s[-1])
        t, s, n, lo = t[fresh], s[fresh], n[fresh], lo[fresh]
        open_before, out = token, []
        token, sig = last
        if not len(t):
            continue
        same_prev, same_next = np.zeros(len(t), bool), np.zeros(len(t), bool)
        same_prev[1:] = t[1:] == t[:-1]
        same_next[:-1] = same_prev[1:]
        same_prev[0] = t[0] == open_before
        if held is not None:
            if same_prev[0]:
                out.append(held)
            held = None
        keep = same_prev | same_next | lo
        if not keep[-1]:  # the first row of a token that may go on in the next batch
            held = (t[-1], s[-1], n[-1], lo[-1])
        cols = [np.concatenate([np.array([r[i] for r in out], dtype=a.dtype), a[keep]]) for i, a in enumerate((t, s, n, lo))]
        if len(cols[0]):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["token", "sig", "n", "long"])


def _token_rows(k: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(white_space_words())
        for part in slices(parts):
            sig, raw = [], []
            for _, tokens in _sets(part, hasher, k):
                sig.append(_signature(tokens) if len(tokens) else 0)
                raw.append(tokens.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sig, pa.int64()), pa.array(raw, pa.binary())], names=["sig", "tokens"])

    return run


def _linked(percent: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keep = np.zeros(part.num_rows, dtype=bool)
            left, right = part.column("left"), part.column("right")
            last_raw = last = None
            for i in range(part.num_rows):
                raw = left[i].as_buffer()
                if last_raw is None or not raw.equals(last_raw):
                    last_raw, last = raw, np.frombuffer(raw, dtype=U64)
                b = np.frombuffer(right[i].as_buffer(), dtype=U64)
                small, large = (last, b) if len(last) <= len(b) else (b, last)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                overlap = int(np.count_nonzero(large[at] == small))
                keep[i] = 100 * overlap >= percent * (len(last) + len(b) - overlap)
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return run


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _live(lists: DataFrame, joined: DataFrame) -> DataFrame:
    """(token, sig, n, c) of the lists that hold more than one component."""
    placed = lists.join(joined.select(F.col("node").alias("sig"), "component"), "sig", "left").select("token", "sig", "n", F.coalesce("component", "sig").alias("c"))
    mixed = placed.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter(F.col("lo") != F.col("hi")).select("token")
    return placed.join(mixed, "token", "left_semi")


def _to_strongest(live: DataFrame, percent: int) -> DataFrame:
    """Pairs of a set with the strongest set of its lists: the one whose lists
    hold the most sets together.  A text that was edited many times has no
    shingles of its own, so its lists are the fullest and it leads them, and its
    edits, which may link with it only, meet it here.  A pair shares enough of
    the lists that the strongest set leads; a set has at most a few of those."""
    live = staged(live, "placed")
    held = live.groupBy("token").agg(F.count("*").alias("held"))
    strength = live.join(held, "token").groupBy("sig").agg(F.sum("held").alias("strength"))
    lead = live.join(strength, "sig").groupBy("token").agg(F.max_by(F.struct("sig", "n", "c"), F.struct("strength", "sig")).alias("lead"))
    shared = (
        live.join(lead, "token")
        .filter((F.col("c") != F.col("lead.c")) & _sizes_fit(F.col("n"), F.col("lead.n"), percent))
        .groupBy(F.col("lead.sig").alias("a"), F.col("sig").alias("b"))
        .agg(F.count("*").alias("shared"), F.first("lead.n").alias("m"), F.first("n").alias("n"))
    )
    return staged(shared.filter(F.col("shared") >= _least_shared(F.col("m"), F.col("n"), percent)).select("a", "b"), "strongest-pairs")


def _to_large(live: DataFrame, percent: int) -> DataFrame:
    """Up to ``TRIES`` pairs for a set that shares many lists with a larger
    component: with one of its members for each list, another in each.  Like
    the leaders, these only spare the merge the pairs inside a component."""
    live = staged(live, "placed")
    by_list = live.groupBy("token", "c").agg(F.count("*").alias("held"), F.min_by(F.struct("sig", "n"), F.xxhash64("sig", "token")).alias("member"))
    large = by_list.filter("held > 1").groupBy("token").agg(F.max_by(F.struct(F.col("c").alias("to"), "member"), F.struct("held", "c")).alias("large"))
    tried = (
        live.join(large, "token")
        .filter((F.col("c") != F.col("large.to")) & _sizes_fit(F.col("n"), F.col("large.member.n"), percent))
        .groupBy("sig", "n", F.col("large.to").alias("to"))
        .agg(F.count("*").alias("shared"), F.collect_set("large.member.sig").alias("members"))
        .filter(F.col("shared") >= _least_shared(F.col("n"), F.col("n"), percent))
    )
    return staged(tried.select(F.explode(F.slice(F.sort_array("members"), 1, TRIES)).alias("a"), F.col("sig").alias("b")).distinct(), "component-pairs")


def _least_shared(a: Column, b: Column, percent: int) -> Column:
    """Of sets of sizes a and b that link, how many shingles their prefixes
    share: of T common ones, at most ``own T - 1`` lie beyond a prefix."""
    needed = F.ceil((a + b) * percent / (100 + percent) - 1e-9)
    return F.least(*(needed - F.ceil(n * percent / 100 - 1e-9) + 1 for n in (a, b)))


def _merged(live: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share enough lists.

    A pair must share S lists (``_least_shared``).  With the lists of every set
    ranked from short to long, in one order for all, the shortest list that the
    pair shares has S - 1 shared ones behind it in the ranks of both.  So each set
    leaves its S - 1 longest lists out of the merge, S being that of the pair's
    sizes, and the pairs found are then looked up in all lists, long ones included.
    """
    held = live.groupBy("token").agg(F.count("*").alias("held"))
    by_length = Window.partitionBy("sig").orderBy("held", "token")
    ranked = live.join(held, "token").withColumn("rank", F.row_number().over(by_length)).withColumn("lists", F.count("*").over(Window.partitionBy("sig")))
    ranked = staged(ranked.drop("held"), "ranked-lists")
    x, y = ranked.alias("x"), ranked.alias("y")
    shared = _least_shared(F.col("x.n"), F.col("y.n"), percent)
    short = [F.col(f"{s}.rank") <= F.col(f"{s}.lists") - shared + 1 for s in ("x", "y")]
    met = (
        x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.c") < F.col("y.c")) & _sizes_fit(F.col("x.n"), F.col("y.n"), percent) & short[0] & short[1])
        .groupBy(F.col("x.sig").alias("a"), F.col("y.sig").alias("b"))
        .agg(F.first("x.n").alias("m"), F.first("y.n").alias("n"))
    )
    arrays = live.groupBy("sig").agg(F.collect_list("token").alias("tokens"))
    both = met.join(arrays.select(F.col("sig").alias("a"), F.col("tokens").alias("left")), "a").join(arrays.select(F.col("sig").alias("b"), F.col("tokens").alias("right")), "b")
    enough = F.size(F.array_intersect("left", "right")) >= _least_shared(F.col("m"), F.col("n"), percent)
    return staged(both.filter(enough).select("a", "b"), "pairs")


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Of the candidate pairs (a, b), those that link.  Only texts that stand for
    a set in some pair are tokenized again; a set is found by the hash of one of
    its texts, so it needs no doc_id."""
    ends = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).distinct()
    wanted = staged(ends.join(nodes.select("sig", "__tl_key"), "sig").select("__tl_key").distinct(), "wanted")
    likely = maybe_in(docs, "__tl_key", bloom(wanted, "__tl_key"))  # else all texts would go through the shuffle
    sets = staged(
        likely.join(wanted, "__tl_key", "left_semi").select("text").mapInArrow(_token_rows(k), "sig long, tokens binary").dropDuplicates(["sig"]),
        "sets",
    )
    by_b = pairs.join(sets.select(F.col("sig").alias("b"), F.col("tokens").alias("right")), "b")
    both = by_b.join(sets.select(F.col("sig").alias("a"), F.col("tokens").alias("left")), "a")
    return both.select("a", "b", "left", "right").mapInArrow(_linked(percent), "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, keys: bool = False) -> DataFrame:
    """One row for every row of ``docs``: doc_id, n_shingles, component_id (the
    smallest doc_id reachable by links, itself included); with ``keys`` also
    ``__tl_key`` (``xxhash64`` of the text) and ``__tl_class`` (null for an empty
    set), which name rows and classes that have no id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("__tl_key"))
    heads = staged(docs.mapInArrow(_head_rows(k), HEADS), "heads")
    rows = heads.filter(F.col("n").isNotNull()).drop("token", "held")
    top = (
        heads.filter(F.col("token").isNotNull())
        .groupBy("token")
        .agg(F.sum("held").alias("held"))
        .filter(F.col("held") >= HEAVY_TOTAL)
        .orderBy(F.desc("held"), "token")
        .limit(HEAVY_KEYS)
        .toPandas()
    )
    heavy = top["token"].to_numpy(dtype=np.int64).view(U64)
    order = np.argsort(heavy)
    rank = np.empty(len(heavy), dtype=np.int64)
    rank[:] = len(heavy) - order  # the most frequent come last
    nodes = staged(
        rows.filter("n > 0").groupBy("sig", "n").agg(F.min("doc_id").alias("rep"), F.min("__tl_key").alias("__tl_key"), *(F.min(f"mh{j}").alias(f"mh{j}") for j in range(SEEDS))),
        "nodes",
    )

    mins = [f"mh{j}" for j in range(SEEDS)]
    minima = nodes.select("sig", "n", *mins, F.posexplode(F.array(*mins)).alias("j", "mh"))
    leaders = minima.groupBy("j", "mh").agg(F.min(F.struct("n", "sig", *mins)).alias("lead"), F.count("*").alias("held")).filter("held > 1")
    agree = sum((F.col(m) == F.col(f"lead.{m}")).cast("int") for m in mins)
    near = staged(
        minima.join(leaders, ["j", "mh"])
        .filter((F.col("sig") != F.col("lead.sig")) & (agree >= AGREE) & _sizes_fit(F.col("n"), F.col("lead.n"), percent))
        .select(F.col("lead.sig").alias("a"), F.col("sig").alias("b"))
        .distinct(),
        "leader-pairs",
    )
    stars = staged(_verified(near, nodes, docs, k, percent), "leader-links")
    joined = staged(components(stars), "leader-components")

    lists = docs.select("text").mapInArrow(_prefix_rows(k, percent, heavy[order], rank), "token long, sig long, n int, long boolean")
    salt = F.when(F.col("long"), F.pmod("sig", F.lit(64))).otherwise(F.lit(0))
    lists = staged(
        lists.repartition("token", salt).sortWithinPartitions("token", "sig").mapInArrow(_repeated, "token long, sig long, n int, long boolean"),
        "lists",
    )
    for candidates in (_to_strongest, _to_large):
        met = staged(_verified(candidates(_live(lists, joined), percent), nodes, docs, k, percent), "component-links")
        stars = stars.unionByName(met)
        joined = staged(components(stars), "joined")
    pairs = _merged(staged(_live(lists, joined), "live-lists"), percent)
    links = _verified(pairs, nodes, docs, k, percent)
    linked = components(stars.unionByName(links)).withColumnRenamed("node", "sig")
    placed_nodes = nodes.join(linked, "sig", "left").select("sig", "n", "rep", F.coalesce("component", "sig").alias("c"))
    least = placed_nodes.groupBy("c").agg(F.min("rep").alias("least"))
    named = placed_nodes.join(least, "c").select("sig", "n", "least", F.col("c").alias("__tl_class"))
    more = ["__tl_key", "__tl_class"] if keys else []
    return (
        rows.select("doc_id", "n", "sig", "__tl_key")
        .join(named, ["sig", "n"], "left")
        .select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"), *more)
    )
