"""Ranked search against scores of every document."""

import math
import random
import re

import numpy as np
import pytest

from tideline.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=50):
    """Scores of all documents for all items, by the definition."""
    bags = [(i, terms_of(t)) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(len(b) for _, b in bags)
    df = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in sorted(set(items), key=str):
        scores = []
        for i, b in bags:
            m = 50 + (50 * len(b) * n_docs) // n_terms
            s = 0
            for t in set(terms_of(text)):
                tf = b.count(t)
                if tf:
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf) // (1000 * tf + 20 * m))
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, rank int").repartition(4)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in search.search(d, q, **kw).collect()), key=str)


def words(rng, n, size=60):
    return " ".join(f"w{min(int(rng.expovariate(0.08)), size)}" for _ in range(n))


@pytest.mark.parametrize("seed,kw", [(0, {}), (1, {"shard_docs": 40, "block": 4, "k": 5}), (2, {"shard_docs": 16, "block": 2, "k": 3, "item_terms": 30})])
def test_scores_equal_brute_force(spark, seed, kw):
    rng = random.Random(seed)
    docs = [(i, words(rng, rng.randrange(1, 60))) for i in range(300)]
    docs += [(300 + i, docs[7][1]) for i in range(70)]  # ties beyond k
    docs += [(None, docs[9][1]), (None, None), (400, None), (401, ""), (402, "... !"), (7, docs[7][1]), (7, "W1 É w2"), (403, words(rng, 20000)), (404, "Ünï w3-w4 é É")]
    items = [(i, words(rng, rng.randrange(1, 30), 80)) for i in range(12)]
    items += [(3, "É other text"), (None, "w1 w2"), (5, None), (6, ""), (7, "unseen words"), (8, items[8][1]), (9, "w1 w1 W1")]
    assert run(spark, docs, items, **kw) == brute(docs, items, kw.get("k", 50))


def test_without_rows(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []
    assert run(spark, [(1, None)], [(1, "a"), (2, None)]) == []


def test_long_lists_are_cut_into_blocks_of_like_documents():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((8, 16))
    topic = np.sort(rng.integers(0, 8, 512))
    near = centres[topic] + 0.1 * rng.standard_normal((512, 16))
    order, starts = search.clustered(np.arange(512), near, 32)
    assert sorted(order) == list(range(512)) and len(starts) > 4
    for a, b in zip(starts, [*starts[1:], 512]):
        assert len(set(topic[order[a:b]])) == 1


def shard_and_queries(seed):
    rng = np.random.default_rng(seed)
    vocabulary = np.sort(rng.choice(2**62, 50, replace=False))
    terms = [np.sort(rng.choice(50, rng.integers(1, 20), replace=False)) for _ in range(90)]
    impacts = [rng.integers(1, 10**6, len(t)) for t in terms]
    asked = [np.sort(rng.choice(vocabulary, rng.integers(1, 9), replace=False)) for _ in range(10)]
    ptr = np.concatenate([[0], np.cumsum([len(x) for x in asked])])
    flat = np.concatenate(asked)
    q = search.Queries(np.arange(10), ptr, flat, rng.integers(1, 9000, 50)[np.searchsorted(vocabulary, flat)])
    known, a, b = q.together()
    at = {int(h): i for i, h in enumerate(known)}
    kept = [[(at[int(vocabulary[t])], x) for t, x in zip(ts, xs) if int(vocabulary[t]) in at] for ts, xs in zip(terms, impacts)]
    ids = [i for i, own in enumerate(kept) if own]
    pairs = [(np.array([t for t, _ in kept[i]]), np.array([x for _, x in kept[i]])) for i in ids]
    return q, (known, a, b), ids, pairs


def test_summary_bounds_hold_for_every_document_of_a_block():
    import pyarrow as pa

    for seed in range(5):
        q, along, ids, pairs = shard_and_queries(seed)
        made = list(search.build_shard(ids, [x for _, x in pairs], [t for t, _ in pairs], along, block=6))
        assert len(made) == 1
        row = pa.RecordBatch.from_arrays([pa.array([made[0][k].tobytes()]) for k in search.ARRAYS], names=list(search.ARRAYS))
        shard = search.Shard(row)
        shard.look_up(q)
        seen = 0
        for t, asking, bounds in shard.bounds(0, 10):
            block_of = shard.block_postings(t)
            docs = shard.post_doc[shard.lists[t] : shard.lists[t + 1]]
            for col, x in enumerate(asking):
                found, scores = shard.score(x, np.ones(len(shard.docs), dtype=bool))
                exact = np.zeros(len(shard.docs), dtype=np.int64)
                exact[found] = scores
                for b in range(bounds.shape[0]):
                    assert bounds[b, col] >= exact[docs[block_of == b]].max() > 0
                    seen += 1
        assert seen > 100


def test_too_many_terms_split_a_shard(monkeypatch):
    q, along, ids, pairs = shard_and_queries(1)
    monkeypatch.setattr(search, "CELLS", 200)
    made = list(search.build_shard(ids, [x for _, x in pairs], [t for t, _ in pairs], along))
    assert len(made) > 4 and sorted(i for m in made for i in m["docs"]) == ids
