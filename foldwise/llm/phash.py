"""A minimal perfect hash of 64-bit keys: one bit array per level, slots by rank (BBHash, Limasset et al. 2017)."""

from __future__ import annotations

import numpy as np

from foldwise.llm.common import mix64

GAMMA, LEVELS, BLOCK = 2, 40, 8  # bits a key on each level; most levels; 64-bit words between stored ranks


def _place(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    return (mix64(keys ^ mix64(np.array([level + 1], np.uint64))) % np.uint64(bits)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    """32 bits of another hash, stored at a key's slot, to recognise keys that are not in the set."""
    return (mix64(keys ^ np.uint64(0xA5A5A5A5DEADBEEF)) >> np.uint64(32)).astype(np.uint32)


def build(keys: np.ndarray) -> bytes:
    """The function for distinct keys: a key takes the first level on which no other remaining key has its bit."""
    sizes, arrays, left = [], [], keys
    for level in range(LEVELS):
        if not len(left):
            break
        bits = max(64, -(-len(left) * GAMMA // 64) * 64)
        at = _place(left, level, bits)
        alone = np.bincount(at, minlength=bits) == 1
        sizes.append(bits)
        arrays.append(np.packbits(alone, bitorder="little"))
        left = left[~alone[at]]
    if len(left):
        raise ValueError("keys are not distinct")
    head = np.array([len(sizes), *sizes], np.int64).tobytes()
    return head + b"".join(a.tobytes() for a in arrays)


class Slots:
    """Reads what :func:`build` made; ``find`` takes a bounded number of steps a key."""

    def __init__(self, blob: bytes):
        n = int(np.frombuffer(blob, np.int64, 1)[0])
        self.sizes = np.frombuffer(blob, np.int64, n, 8)
        self.words = np.frombuffer(blob, np.uint64, offset=8 * (n + 1))
        self.level_at = np.cumsum(self.sizes) - self.sizes
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(ones)])[::BLOCK]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, from 0 without gaps over the set; -1 for keys that can be told not to be in it."""
        slot = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, bits in enumerate(self.sizes):
            if not len(open_):
                break
            at = self.level_at[level] + _place(keys[open_], level, int(bits))
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit & np.uint64(1)).astype(bool)
            rank = self.rank[word // BLOCK].copy()
            for back in range(BLOCK - 1):
                w = word // BLOCK * BLOCK + back
                rank += np.where(w < word, np.bitwise_count(self.words[np.minimum(w, len(self.words) - 1)]), 0).astype(np.int64)
            rank += np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            slot[open_[hit]] = rank[hit]
            open_ = open_[~hit]
        return slot
