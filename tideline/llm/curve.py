"""Hashed word vectors of texts, projected to few dimensions, and their place on
a Hilbert curve: texts of like words come near one another."""

from __future__ import annotations

import functools

import numpy as np

from tideline.llm.common import U64

BUCKETS, DIMS, BITS = 512, 4, 10


@functools.lru_cache(maxsize=4)
def _directions(dims: int) -> np.ndarray:
    return np.random.default_rng(12).standard_normal((BUCKETS, dims))


def project(hashes: list[np.ndarray], weights: list[np.ndarray] | None = None, dims: int = DIMS) -> np.ndarray:
    """One row of ``dims`` normal-like coordinates for each array of word hashes:
    signed counts by hash bucket, their square roots, unit length, then fixed
    random directions.  Without words all coordinates are 0."""
    out = np.zeros((len(hashes), dims))
    for at in range(0, len(hashes), 256):
        own = hashes[at : at + 256]
        flat = np.concatenate(own) if own else np.zeros(0, dtype=U64)
        row = np.repeat(np.arange(len(own)), [len(h) for h in own])
        sign = np.where((flat >> U64(40)) & U64(1) == 1, 1.0, -1.0)
        if weights is not None:
            sign = sign * np.concatenate(weights[at : at + 256]) if own else sign
        counts = np.bincount(row * BUCKETS + (flat % U64(BUCKETS)).astype(np.int64), sign, minlength=len(own) * BUCKETS).reshape(len(own), BUCKETS)
        counts = np.sign(counts) * np.sqrt(np.abs(counts))
        size = np.linalg.norm(counts, axis=1, keepdims=True)
        out[at : at + len(own)] = (counts / np.where(size > 0, size, 1)) @ _directions(dims)
    return out


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each point on the Hilbert curve of ``2^bits`` cells a dimension.

    Coordinates are taken as standard normal and brought to the unit interval
    first.  The cells' axes are undone bit by bit, then Gray-coded (Skilling,
    "Programming the Hilbert curve", 2004).
    """
    n = points.shape[1]
    cells = np.minimum((1 / (1 + np.exp(-1.702 * points)) * (1 << bits)).astype(np.int64), (1 << bits) - 1)
    x = [cells[:, i].copy() for i in range(n)]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(len(points), dtype=np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    out = np.zeros(len(points), dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | (((x[i] ^ flip) >> b) & 1)
    return out
