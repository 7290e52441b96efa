"""Which keys of an item do other items hold too? Exact, in one shuffle of packed keys and one of the answers.

A task gathers the distinct keys of a chunk of items and sends them, 6 bytes each, to buckets by their leading bits. A
bucket sees every holder of its keys, finds those held twice or more, and answers each chunk with its items' shared
keys and how many items hold them. Keys that very many items of one chunk hold are not sent item by item: the bucket
only learns that they are frequent, so a key that a third of all items hold costs it one entry per chunk.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BUCKET_KEYS = 1 << 20  # keys that one bucket receives, on average, at most
FREQUENT = 64  # holders in one chunk from which on a key counts as frequent everywhere
FREQUENT_DF = (1 << 32) - 1
PACKET = ("bucket long, base long, owners binary, counts binary, high binary, low binary, frequent binary, "
          "tokens binary, holders binary, note binary")
ANSWER = "base long, owners binary, tokens binary, holders binary, note binary"
_PACKET = pa.schema([("bucket", pa.int64()), ("base", pa.int64()),
                     *[(c, pa.binary()) for c in ("owners", "counts", "high", "low", "frequent", "tokens", "holders", "note")]])
_ANSWER = pa.schema([("base", pa.int64()), *[(c, pa.binary()) for c in ("owners", "tokens", "holders", "note")]])


def bucket_bits(keys: int) -> int:
    """Leading bits that make enough buckets for so many keys."""
    return max(4, int(max(keys, 1) / BUCKET_KEYS).bit_length())


def send(base: int, sizes: np.ndarray, keys: np.ndarray, bits: int, note: bytes) -> pa.RecordBatch:
    """The packets of a chunk: item i has the next ``sizes[i]`` of the distinct ``keys``; ``note`` travels along."""
    owner = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
    rest = np.uint64(64 - bits)
    drop = np.uint64(max(0, 16 - bits))
    keys = keys >> drop << drop
    values, times = np.unique(keys, return_counts=True)
    frequent = values[times >= FREQUENT]
    rows = {c: [] for c in _PACKET.names}

    def row(bucket, **columns):
        for c in rows:
            rows[c].append(bucket if c == "bucket" else base if c == "base" else columns.get(c))

    spread = -1 - (base % 8191)
    if len(frequent):
        often = np.isin(keys, frequent)
        row(spread, owners=owner[often].tobytes(), tokens=keys[often].tobytes(),
            holders=np.full(int(often.sum()), FREQUENT_DF, np.uint32).tobytes())
        keys, owner = keys[~often], owner[~often]
    row(spread, note=note)
    bucket = (keys >> rest).astype(np.uint16 if bits <= 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, keys, owner = bucket[order], keys[order], owner[order]
    low48 = keys >> drop
    high, low = (low48 >> np.uint64(16)).astype(np.uint32), low48.astype(np.uint16)
    frequent_bucket = (frequent >> rest).astype(np.int64)
    here = np.union1d(np.unique(bucket).astype(np.int64), frequent_bucket)
    cut = np.searchsorted(bucket, here)
    for b, a, z in zip(here.tolist(), cut.tolist(), [*cut[1:].tolist(), len(bucket)]):
        new = np.flatnonzero(np.diff(owner[a:z].astype(np.int64), prepend=-1))
        row(b, owners=owner[a:z][new].tobytes(), counts=np.diff(new, append=z - a).astype(np.uint32).tobytes(),
            high=high[a:z].tobytes(), low=low[a:z].tobytes(), frequent=frequent[frequent_bucket == b].tobytes())
    return pa.RecordBatch.from_pydict(rows, schema=_PACKET)


def _all(parts: list[bytes], kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(p, kind) for p in parts]) if parts else np.empty(0, kind)


def _met(bits: int) -> Callable[[pa.Table], pa.Table]:
    drop, rest = np.uint64(max(0, 16 - bits)), np.uint64(64 - bits)

    def run(packets: pa.Table) -> pa.Table:
        bucket = packets["bucket"][0].as_py()
        if bucket < 0:
            return packets.select(_ANSWER.names).cast(_ANSWER)
        packets = packets.sort_by("base")
        get = lambda c: packets[c].to_pylist()
        low48 = _all(get("high"), np.uint32).astype(np.uint64) << np.uint64(16) | _all(get("low"), np.uint16)
        keys = (np.uint64(bucket) << rest) | (low48 << drop & ((np.uint64(1) << rest) - np.uint64(1)))
        del low48
        ordered = np.sort(keys)
        edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, int)
        times = np.diff(edge, append=len(ordered))
        values, times = ordered[edge[times > 1]], times[times > 1].astype(np.uint32)
        frequent = np.unique(_all(get("frequent"), np.uint64))
        if len(frequent):
            times = np.concatenate([times[~np.isin(values, frequent)], np.full(len(frequent), FREQUENT_DF, np.uint32)])
            values = np.concatenate([values[~np.isin(values, frequent)], frequent])
            by = np.argsort(values)
            values, times = values[by], times[by]
        if not len(values):
            return _ANSWER.empty_table()
        # most keys have one holder: a small table of 24 bits of each shared key sorts them out before the search
        some = np.zeros(1 << 24, bool)
        mask, shift = np.uint64((1 << 24) - 1), drop + np.uint64(3)
        some[values >> shift & mask] = True
        maybe = np.flatnonzero(some[keys >> shift & mask])
        at = np.searchsorted(values, keys[maybe])
        at[at == len(values)] = 0
        hit = values[at] == keys[maybe]
        maybe, at = maybe[hit], at[hit]
        owners, counts = get("owners"), get("counts")
        owner = np.repeat(_all(owners, np.uint32), _all(counts, np.uint32))[maybe]
        ends = np.cumsum([int(np.frombuffer(c, np.uint32).sum()) for c in counts])
        cut = [0, *np.searchsorted(maybe, ends).tolist()]
        rows = {c: [] for c in _ANSWER.names}
        for base, a, z in zip(get("base"), cut, cut[1:]):
            if z > a:
                for c, v in (("base", base), ("owners", owner[a:z].tobytes()), ("tokens", values[at[a:z]].tobytes()),
                             ("holders", times[at[a:z]].tobytes()), ("note", None)):
                    rows[c].append(v)
        return pa.table(rows, schema=_ANSWER)
    return run


def answers(packets: DataFrame, bits: int) -> DataFrame:
    """Rows ``base, owners, tokens, holders`` and the notes; group them by ``base`` to have a chunk together."""
    return packets.groupBy("bucket").applyInArrow(_met(bits), ANSWER)


def gathered(chunk: pa.Table) -> tuple[bytes | None, np.ndarray, np.ndarray, np.ndarray]:
    """Note, and item, key and number of holders of all answers to a chunk, by item, rarest and then smallest key first."""
    get = lambda c: [x for x in chunk[c].to_pylist() if x is not None]
    notes = get("note")
    owner, token, times = _all(get("owners"), np.uint32), _all(get("tokens"), np.uint64), _all(get("holders"), np.uint32)
    order = np.lexsort((token, times, owner))
    return notes[0] if notes else None, owner[order], token[order], times[order]
