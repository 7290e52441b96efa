"""Word shingles of whole texts as 64-bit hashes, computed on the bytes of a batch at once."""

from __future__ import annotations

import numpy as np

from foldwise.llm.common import SEPARATORS, mix64

MULTIPLIER = np.uint64(0x5851F42D4C957F2D)  # odd, so that it can be inverted
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
BYTE_VALUES = mix64(np.arange(256))  # a scattered value for each byte, A-Z as a-z
BYTE_VALUES[0x41:0x5B] = BYTE_VALUES[0x61:0x7B]
IS_SEPARATOR = np.isin(np.arange(256), SEPARATORS)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and starting byte of every word, lower-cased in A-Z, and how many words each row has."""
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    gap = IS_SEPARATOR[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = True, gap[:-1]
    starts = np.flatnonzero(~gap & (before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, gap[1:]
    ends = np.flatnonzero(~gap & (after | edge[1:])) + 1
    powers = np.full(n, MULTIPLIER)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers, out=sums[1:])
    back = np.full(n, INVERSE)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    hashes = mix64((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    return hashes, starts, np.diff(np.searchsorted(starts, offsets))


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words within a row, and how many each row has.

    A row with fewer words has one, of all of them; a row without words has none.
    """
    rows, n = len(counts), len(hashes)
    factors = mix64(np.arange(1, size + 1) * 7919) | np.uint64(1)
    last = np.cumsum(counts)
    own = np.repeat(np.arange(rows), counts)
    at = np.arange(n)
    full = at + size <= last[own]
    short = (at == (last - counts)[own]) & (counts[own] < size)
    keep = np.flatnonzero(full | short)
    total = np.zeros(len(keep), np.uint64)
    length = np.minimum(size, last[own[keep]] - keep)
    for k in range(size):
        inside = k < length
        total[inside] += hashes[keep[inside] + k] * factors[k]
    return mix64(total + length.astype(np.uint64)), np.bincount(own[keep], minlength=rows)


def distinct(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of every row, ascending, and how many each row has."""
    out, sizes, at = [], np.zeros(len(counts), np.int64), 0
    for i, n in enumerate(counts.tolist()):
        if n:
            row = np.sort(values[at:at + n])
            if n > 1:
                row = row[np.concatenate([[True], row[1:] != row[:-1]])]
            out.append(row)
            sizes[i] = len(row)
            at += n
    return np.concatenate(out) if out else np.empty(0, np.uint64), sizes


def signatures(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each row's set of values."""
    ends = np.cumsum(sizes)
    found = []
    for salt in (0x1234567, 0x7654321):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(values ^ np.uint64(salt)))])
        found.append(mix64(sums[ends] - sums[ends - sizes]))
    return found[0], found[1]
