"""Minimal perfect hashing of 64-bit keys in buckets.

Keys are dealt to buckets by a hash. A bucket's function is a stack of bit levels: a key is placed
in the first level where its bit is hit by no other key that is left, and its slot is the number
of set bits before its own. Building and looking up are numpy passes over all keys of a bucket.
"""

from __future__ import annotations

import numpy as np

from inkwell.llm.text_hash import U64, mix

#: Bits of a level for every key that is left; words of 64 bits.
SPACE = 2


def _spread(keys: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(keys.view(np.uint64) ^ mix(np.array([level + 1], dtype=U64) * U64(0x9E3779B97F4A7C15)))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of every int64 key."""
    return (_spread(keys, -1) % U64(buckets)).astype(np.int64)


class PerfectHash:
    """Slots 0 to n - 1 of n distinct keys; other keys get some slot or -1, so a hit has to be verified."""

    def __init__(self, levels: list[np.ndarray], n: int) -> None:
        self.levels, self.n = levels, n
        self.ranks, total = [], 0
        for bits in levels:
            ones = np.bitwise_count(bits).astype(np.int64)
            self.ranks.append(total + np.cumsum(ones) - ones)
            total += int(ones.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        """``keys``: distinct int64 numbers."""
        levels, left = [], keys
        while len(left):
            words = max(1, -(-SPACE * len(left) // 64))
            at = (_spread(left, len(levels)) % U64(64 * words)).astype(np.int64)
            alone = np.bincount(at, minlength=64 * words) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = left[~alone[at]]
        return cls(levels, len(keys))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            if not len(left):
                break
            at = (_spread(keys[left], level) % U64(64 * len(bits))).astype(np.int64)
            word, bit = at >> 6, (at & 63).astype(U64)
            hit = (bits[word] >> bit) & U64(1) == 1
            below = bits[word[hit]] & ((U64(1) << bit[hit]) - U64(1))
            out[left[hit]] = ranks[word[hit]] + np.bitwise_count(below)
            left = left[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([self.n, len(self.levels), *map(len, self.levels)], dtype=np.int64)
        return head.tobytes() + b"".join(x.tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, blob: bytes) -> "PerfectHash":
        n, k = np.frombuffer(blob, dtype=np.int64, count=2).tolist()
        sizes = np.frombuffer(blob, dtype=np.int64, count=k, offset=16).tolist()
        levels, at = [], 16 + 8 * k
        for size in sizes:
            levels.append(np.frombuffer(blob, dtype=np.uint64, count=size, offset=at))
            at += 8 * size
        return cls(levels, n)
