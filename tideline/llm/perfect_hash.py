"""A minimal perfect hash over 128-bit line hashes (one shard), as arrays.

Levels of bit arrays: at each level a key sets the bit its hash names; keys
that collide go on to the next level.  A key's slot is the rank of its bit
over all levels.  A shard is built by one task from a bounded number of keys.
"""

from __future__ import annotations

import numpy as np

from tideline.llm.common import U64, mix, stream

LEVELS = 64
GAMMA = 2  # bits of a level for each key that reaches it
_SEEDS = stream(11, 2 * LEVELS)


def _at(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = mix(h1 * (_SEEDS[2 * level] | U64(1)) + h2 * (_SEEDS[2 * level + 1] | U64(1)))
    return (x % U64(bits)).astype(np.int64)


def build(h1: np.ndarray, h2: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit arrays of the levels, and the slot of each key (keys are distinct)."""
    levels: list[np.ndarray] = []
    slot = np.full(len(h1), -1, dtype=np.int64)
    left = np.arange(len(h1))
    taken = 0
    for level in range(LEVELS):
        if not len(left):
            break
        bits = max(64, GAMMA * len(left))
        at = _at(h1[left], h2[left], level, bits)
        hits = np.bincount(at, minlength=bits)
        alone = hits == 1
        levels.append(alone)
        rank = np.cumsum(alone) - 1
        won = alone[at]
        slot[left[won]] = taken + rank[at[won]]
        taken += int(alone.sum())
        left = left[~won]
    if len(left):
        raise ValueError("equal keys in a perfect hash")
    return levels, slot


def pack(levels: list[np.ndarray]) -> tuple[bytes, list[int]]:
    return b"".join(np.packbits(x).tobytes() for x in levels), [len(x) for x in levels]


class Probe:
    """Slots of keys; a key that was not in the build gets some slot or -1, so
    the caller compares fingerprints."""

    def __init__(self, data: bytes, sizes: list[int]):
        self.levels, self.ranks, self.base = [], [], []
        at = taken = 0
        for size in sizes:
            raw = np.frombuffer(data, dtype=np.uint8, count=(size + 7) // 8, offset=at)
            bits = np.unpackbits(raw, count=size).astype(bool)
            self.levels.append(bits)
            self.ranks.append(np.cumsum(bits) - 1)
            self.base.append(taken)
            taken += int(bits.sum())
            at += (size + 7) // 8

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.full(len(h1), -1, dtype=np.int64)
        left = np.arange(len(h1))
        for level, bits in enumerate(self.levels):
            if not len(left):
                break
            at = _at(h1[left], h2[left], level, len(bits))
            won = bits[at]
            out[left[won]] = self.base[level] + self.ranks[level][at[won]]
            left = left[~won]
        return out
