"""op7: border visits are made by short codes; only near vectors are moved."""

import os

import numpy as np

from tideline.llm import embeddings
from tideline.session import shared_root


def brute_force(vectors, labels, threshold=0.98):
    """(n_links, component_id) of every vector, its number as its id."""
    x = vectors.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = (x @ x.T >= threshold) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(hit, False)
    low = np.arange(len(x))
    while True:
        new = np.minimum(low, np.where(hit, low[None, :], len(x)).min(axis=1))
        if (new == low).all():
            return list(zip(hit.sum(axis=1).tolist(), low.tolist()))
        low = new


def linked(spark, vectors, labels):
    rows = [(i, [float(y) for y in x], int(k)) for i, (x, k) in enumerate(zip(vectors, labels))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return [(r["n_links"], r["component_id"]) for r in sorted(embeddings.link_vectors(frame).collect(), key=lambda r: r["vec_id"])]


def staged_bytes(spark):
    """Of the operators' tables, by their paths."""
    top = shared_root(spark).removeprefix("file:")
    return {p: os.path.getsize(p) for d, _, names in os.walk(f"{top}/tideline") for p in (f"{d}/{n}" for n in names)}


def unclustered(rng, n, dim):
    """Vectors of any direction; of each tenth, one near copy."""
    x = rng.normal(size=(n, dim))
    return np.concatenate([x, x[: n // 10] + rng.normal(size=(n // 10, dim)) * 0.15]).astype(np.float32)


def test_visits_do_not_write_vectors_for_every_cell(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL_VECTORS", 100)
    rng = np.random.default_rng(3)
    x, labels = unclustered(rng, 3000, 64), np.zeros(3300, dtype=int)
    before = staged_bytes(spark)
    got = linked(spark, x, labels)
    assert got == brute_force(x, labels) and sum(n > 0 for n, _ in got) > 300
    wrote = sum(size for path, size in staged_bytes(spark).items() if path not in before)
    assert wrote < 2 * x.nbytes


def test_small_parts_and_blocks_lose_no_link(spark, monkeypatch):
    for name, value in (("CELL_VECTORS", 30), ("PART", 90), ("BLOCK", 20), ("FEW", 40)):
        monkeypatch.setattr(embeddings, name, value)
    rng = np.random.default_rng(4)
    x = unclustered(rng, 500, 40)
    x = np.concatenate([x, x[:1] + rng.normal(size=(150, 40)).astype(np.float32) * 0.1, x[7:9] * 2])
    labels = np.where(np.arange(len(x)) < 400, np.arange(len(x)) % 2, 0)
    got = linked(spark, x, labels)
    assert got == brute_force(x, labels) and max(n for n, _ in got) >= 150


def test_codes_of_near_vectors_meet():
    rng = np.random.default_rng(5)
    x = embeddings.unit(unclustered(rng, 600, 48))
    frame = embeddings.fit(x, 40)
    codes = frame.codes(x)
    home = frame.home(codes)
    assert np.abs(np.linalg.norm(embeddings.floats(codes), axis=1) - 1).max() < 1e-3
    row, at, other, other_at = embeddings.near_codes(frame, 0.98, codes, home)
    found = {*zip(row.tolist(), at.tolist()), *zip(other.tolist(), other_at.tolist())}
    a, b = np.nonzero((x @ x.T >= 0.98) & ~np.eye(len(x), dtype=bool))
    assert len(a) > 100 and {*zip(a.tolist(), home[b].tolist())} <= found
    assert len({r for r, _ in found}) < len(x) / 2
    half = len(x) // 2  # two blocks
    row, at, other, other_at = embeddings.near_codes(frame, 0.98, codes[:half], home[:half], codes[half:], home[half:])
    across = (a < half) & (b >= half)
    assert {*zip(a[across].tolist(), home[b[across]].tolist())} <= {*zip(row.tolist(), at.tolist())}
    assert {*zip((b[across] - half).tolist(), home[a[across]].tolist())} <= {*zip(other.tolist(), other_at.tolist())}
