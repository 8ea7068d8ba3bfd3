"""Vector code compression against plain Python integers."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tideline.llm import codebooks

SCHEMA = "vec_id long, embedding array<float>, label int, ints string, codes int"


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    kept = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    whole = sorted((r for r in kept if r[1] and len(r[1]) % parts == 0 and max(map(abs, r[1])) < 2**30 / math.sqrt(len(r[1]))), key=key)
    dim = len(whole[0][1]) if whole else 0
    whole = [r for r in whole if len(r[1]) == dim]
    w = dim // parts
    cut = lambda q, p: tuple(q[p * w : (p + 1) * w])
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    books = [[cut(r[1], p) for r in whole[:entries]] for p in range(parts)]

    def assign():
        return [[min(range(len(books[p])), key=lambda e: (far(cut(q, p), books[p][e]), e)) for p in range(parts)] for _, q, _ in whole]

    for _ in range(rounds if whole else 0):
        codes = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(r[1], p) for r, c in zip(whole, codes) if c[p] == e]
                if own:
                    books[p][e] = tuple(sum(x) // len(own) for x in zip(*own))
    codes = assign() if whole else []
    out = [(i, "".join(f"{x:02x}" for x in c), sum(far(cut(q, p), books[p][c[p]]) for p in range(parts)), lab) for (i, q, lab), c in zip(whole, codes)]
    ok = {id(r) for r in whole}
    out += [(i, None, None, lab) for r in kept if id(r) not in ok for i, q, lab in [r]]
    text = ",".join(str(x) for b in books for e in b for x in e)
    return sorted(out, key=str), hashlib.sha256(text.encode()).hexdigest()


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, lab, "x", 9) for i, v, lab in rows], SCHEMA)
    coded, books = codebooks.compress(df, **kw)
    got = [(r["vec_id"], None if r["codes"] is None else bytes(r["codes"]).hex(), r["error"], r["label"]) for r in coded.collect()]
    return sorted(got, key=str), books.sha256()


def near(rng, dim, n, spread):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(7)]
    return [[float(x + rng.gauss(0, spread)) for x in rng.choice(centres)] for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_codes_equal_plain_integers(spark, seed):
    import numpy as np

    rng = random.Random(seed)
    rows = [(rng.randrange(1000), [float(np.float32(x)) for x in v], rng.choice([1, 2, None])) for v in near(rng, 32, 150, rng.choice([0.02, 0.5]))]
    rows += [(None, rows[0][1], 2), (5, None, 1), (6, [], 1), (7, [1.0] * 5, None), (8, [float("nan")] + [0.0] * 31, 1), (9, [float("inf")] + [0.0] * 31, 1), (9, [None] + [0.0] * 31, 1), (10, [0.0] * 16, 3), (11, [3e38] * 32, 3)]
    rows += [rows[3], rows[3]]  # repeated rows
    kw = {"entries": 20, "rounds": 3} if seed == 2 else {}
    assert run(spark, rows, **kw) == brute(rows, **kw)


def test_ties_go_to_the_lower_index(spark):
    rows = [(i, [float(i % 3)] * 16, 1) for i in range(40)]  # entries repeat
    assert run(spark, rows) == brute(rows)
    rows = [(i, [x / 256] * 16, 1) for i, x in enumerate([0, 2, 4, 1, 3, 1, 3])]  # 1 lies between 0 and 2
    for rounds in (0, 1, 2):
        assert run(spark, rows, entries=3, rounds=rounds) == brute(rows, entries=3, rounds=rounds)


def test_fewer_vectors_than_entries_and_none(spark):
    rows = [(i, [float(i)] * 16, None) for i in range(3)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == ([], hashlib.sha256(b"").hexdigest())
    assert run(spark, [(1, [1.0], 1)]) == ([(1, None, None, 1)], hashlib.sha256(b"").hexdigest())


def test_decode_and_label_errors(spark):
    rows = [(i, [float(i % 5)] * 32, [1, None][i % 2]) for i in range(30)]
    df = spark.createDataFrame([(i, v, lab, "x", 9) for i, v, lab in rows], SCHEMA)
    coded, books = codebooks.compress(df, entries=5)
    back = {r["vec_id"]: list(r["embedding"]) for r in codebooks.decode(coded, books).collect()}
    assert back == {i: v for i, v, _ in rows}  # five different vectors, five entries
    lossy, _ = codebooks.compress(df, entries=2)
    got = codebooks.label_errors(lossy).collect()
    for lab in (1, None):
        own = [r for r in got if r["label"] == lab]
        assert {r["label_error"] for r in own} == {sum(r["error"] for r in own)} and len(own) == 15


def test_balls_leave_out_only_what_cannot_win():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(20):
        entries = rng.integers(-30, 30, (4, 9, 3))
        x = rng.integers(-40, 40, (200, 4, 3))
        before = codebooks.Codebooks(entries)
        codes = codebooks._nearest(before, x)
        radius = np.zeros((4, 9))
        for p in range(4):
            np.maximum.at(radius[p], codes[:, p], np.sqrt(codebooks._distances(before, x, codes)[:, p]))
        moved = entries + rng.integers(-4, 5, entries.shape)
        way = np.sqrt(((moved - entries) ** 2).sum(axis=2))
        books = codebooks.with_balls(moved, radius + way)
        assert (codebooks._ringed(books, x, codes) == codebooks._nearest(books, x)).all()
