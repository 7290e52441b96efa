"""Similarity digests of texts: their improbable byte windows in chained Bloom filters.

Every window of 32 bytes has an entropy level. How rare a level is among the windows of all documents gives the window its rank. A
window that is the rarest (leftmost of ties) of many of the stretches of 32 windows it lies in is a feature. The distinct features of a
text fill Bloom filters of 2,048 bits, 160 features each, five bits a feature. The likeness of two digests is the mean, over the filters
of the shorter one, of the best bit overlap with a filter of the other, counted from what chance gives to the most possible.

Null and empty texts have the empty digest, which is like itself (1) and like nothing else (0). A text shorter than a window has one
feature, the whole of it. Equal texts have equal digests. Very long texts are taken whole, in stretches of bounded memory.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import mix64, only, partitions, pieces, short_batches, utf8
from foldwise.llm.words import INVERSE, MULTIPLIER

WINDOW, STRETCH, WINS = 32, 32, 8  # bytes of a window; windows of a stretch; stretches a feature must win
BITS, FEATURES, HASHES = 2048, 160, 5  # of a filter
LEVELS, FRACTION = 1024, 20  # entropy levels; binary places of the sums
LANE = 1024  # windows that one lane slides over
CUTOFF = 0.3  # overlap up to this share of the way from chance to the most possible counts as none

_n = np.arange(WINDOW + 2, dtype=float)
_NLOGN = np.round(_n * np.log2(np.maximum(_n, 1)) * (1 << FRACTION)).astype(np.int64)
_STEP = np.diff(_NLOGN)  # change of the sum of n log n when a byte's count goes from n to n + 1
_MOST = int(_NLOGN[WINDOW])
_PLAIN = mix64(np.arange(256) + 4096)


def levels(data: np.ndarray) -> np.ndarray:
    """The entropy level of every window of the bytes, by counts that slide along many lanes at once."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int64)
    lane = min(LANE, max(64, n))
    lanes = -(-n // lane)
    padded = np.zeros(lanes * lane + WINDOW, np.uint8)
    padded[:len(data)] = data
    view = np.lib.stride_tricks.as_strided(padded, (lane + WINDOW - 1, lanes), (1, lane))
    columns = np.ascontiguousarray(view).astype(np.int32) + np.arange(lanes, dtype=np.int32) * 256
    seen = np.zeros(lanes * 256, np.int32)
    total = np.zeros(lanes, np.int64)
    out = np.empty((lane, lanes), np.int64)
    for t in range(lane + WINDOW - 1):
        enter = columns[t]
        c = seen[enter]
        total += _STEP[c]
        seen[enter] = c + 1
        if t >= WINDOW - 1:
            out[t - WINDOW + 1] = total
            leave = columns[t - WINDOW + 1]
            c = seen[leave] - 1
            total -= _STEP[c]
            seen[leave] = c
    # entropy = log2(w) - sum / w for a window of w bytes, as a level of the span from 0 to log2(w)
    return ((_MOST - out.T.ravel()[:n]) * (LEVELS - 1)) // _MOST


def _leftmost(keys: np.ndarray) -> np.ndarray:
    """The smallest of each ``STRETCH`` neighbouring keys, by minima from both ends of blocks."""
    blocks = -(-len(keys) // STRETCH) + 1
    padded = np.full(blocks * STRETCH, np.iinfo(np.int64).max)
    padded[:len(keys)] = keys
    grid = padded.reshape(blocks, STRETCH)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    m = len(keys)
    return np.minimum(back[:m], ahead[STRETCH - 1:STRETCH - 1 + m])


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    powers, back = np.full(len(data), MULTIPLIER), np.full(len(data), INVERSE)
    powers[:1], back[:1] = 1, 1
    np.multiply.accumulate(powers, out=powers)
    np.multiply.accumulate(back, out=back)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_PLAIN[data] * powers)])
    return mix64((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def features(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct features in order of first place, and how many each text has."""
    rows, sizes = len(offsets) - 1, np.diff(offsets)
    level = levels(data)
    windows = np.maximum(sizes - WINDOW + 1, 0)
    row = np.repeat(np.arange(rows), windows)
    first = np.cumsum(windows) - windows
    place = np.arange(len(row)) - first[row]
    at = offsets[row] + place  # windows that lie in one text
    runs = np.maximum(windows - STRETCH + 1, np.minimum(windows, 1))
    key = rank[level[at]] * (1 << 40) + np.arange(len(at))
    wins = np.zeros(len(at), np.int64)
    if len(at):
        starts = place < np.maximum(windows - STRETCH + 1, 0)[row]
        best = _leftmost(key)[starts] & ((1 << 40) - 1)
        wins = np.bincount(best, minlength=len(at))
        short = np.flatnonzero((windows > 0) & (windows < STRETCH))
        if len(short):  # a single stretch, shorter than others
            lowest = np.minimum.reduceat(key, first[windows > 0])
            wins[lowest[np.isin(np.flatnonzero(windows > 0), short)] & ((1 << 40) - 1)] += 1
        chosen = wins >= np.minimum(WINS, runs)[row]
        none = np.flatnonzero((windows > 0) & (np.bincount(row[chosen], minlength=rows) == 0))
        if len(none):  # no window wins often: the one that wins most
            order = np.maximum.reduceat(wins * (1 << 40) - np.arange(len(at)), first[windows > 0])
            most = order[np.isin(np.flatnonzero(windows > 0), none)]
            chosen[(-most) & ((1 << 40) - 1)] = True
        chosen = np.flatnonzero(chosen)
    else:
        chosen = np.empty(0, np.int64)
    tiny = np.flatnonzero((sizes > 0) & (windows == 0))
    owner = np.concatenate([row[chosen], tiny])
    starts = np.concatenate([at[chosen], offsets[tiny]])
    ends = np.concatenate([at[chosen] + WINDOW, offsets[tiny + 1]])
    order = np.argsort(owner, kind="stable")
    owner, hashed = owner[order], _hashes(data, starts[order], ends[order])
    if not len(hashed):
        return hashed, np.zeros(rows, np.int64)
    sort = np.lexsort((np.arange(len(hashed)), hashed, owner))
    new = np.ones(len(sort), bool)
    new[1:] = (hashed[sort][1:] != hashed[sort][:-1]) | (owner[sort][1:] != owner[sort][:-1])
    keep = np.sort(sort[new])
    return hashed[keep], np.bincount(owner[keep], minlength=rows)


def filters(hashed: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Each text's chain of Bloom filters, as rows of bytes."""
    chains = -(-counts // FEATURES)
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(hashed)) - (np.cumsum(counts) - counts)[owner]
    which = (np.cumsum(chains) - chains)[owner] + place // FEATURES
    bits = np.zeros(int(chains.sum()) * BITS, bool)
    for k in range(HASHES):
        bits[which * BITS + (hashed >> np.uint64(11 * k) & np.uint64(BITS - 1)).astype(np.int64)] = True
    return np.split(np.packbits(bits).reshape(-1, BITS // 8), np.cumsum(chains)[:-1])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 to 1 for two chains of filters."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    size_b = np.bitwise_count(b).sum(1).astype(float)
    y, total = np.unpackbits(b, axis=1).astype(np.float32), 0.0
    for from_ in range(0, len(a), 256):
        part = a[from_:from_ + 256]
        size_a = np.bitwise_count(part).sum(1).astype(float)[:, None]
        both = np.unpackbits(part, axis=1).astype(np.float32) @ y.T
        most = np.minimum(size_a, size_b)
        chance = size_a * size_b / BITS
        least = chance + CUTOFF * (most - chance)
        total += np.clip((both - least) / (most - least), 0, 1).max(1).sum()
    return float(total / len(a))


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(LEVELS, np.int64)
    for batch in pieces(batches):
        data, offsets = utf8(batch.column("text"))
        level = levels(data)
        edge = np.zeros(len(level) + 1, np.int64)  # windows that cross from one text to the next do not count
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        np.add.at(edge, np.clip(inner - WINDOW + 1, 0, len(level)), 1)
        np.add.at(edge, np.clip(inner, 0, len(level)), -1)
        total += np.bincount(level[np.cumsum(edge)[:-1] == 0], minlength=LEVELS)
    yield pa.RecordBatch.from_pydict({"level": np.arange(LEVELS), "n": total})


def ranks(docs: DataFrame) -> np.ndarray:
    """Entropy levels by how many windows of all ``docs(text)`` have them: 0 for the rarest, ties to the lower level."""
    found = short_batches(docs.select("text")).mapInArrow(_histogram, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(LEVELS, np.int64)
    for r in found:
        n[r["level"]] = r["n"]
    rank = np.empty(LEVELS, np.int64)
    rank[np.lexsort((np.arange(LEVELS), n))] = np.arange(LEVELS)
    return rank


def chains(texts: list[str], rank: np.ndarray) -> list[np.ndarray]:
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    return filters(*features(data, offsets, rank)) if texts else []


def digests(texts: list[str], rank: np.ndarray, limit: int = 256 << 10) -> list[np.ndarray]:
    out, part, size = [], [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= limit:
            out += chains(part, rank)
            part, size = [], 0
    return out + chains(part, rank)


def written(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the beginning of another."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def _compared(rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, marks, size = [], [], [], 0

        def done():
            """All rows but the last, whose successor is not known yet; a bucket's closing row has none."""
            own = digests(texts, rank)
            at = [i for i in range(len(texts) - 1) if not marks[i]]
            changed = [edited(texts[i], texts[i + 1]) for i in at]
            theirs = digests(changed, rank)
            return pa.RecordBatch.from_pydict({
                "doc_id": pa.array([ids[i] for i in at], pa.int64()),
                "n_chars": pa.array([len(texts[i]) for i in at], pa.int64()),
                "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
                "fingerprint": [written(own[i]) for i in at], "edited_fingerprint": [written(c) for c in theirs],
                "near_edited": pa.array([likeness(own[i], c) for i, c in zip(at, theirs)], pa.float64()),
                "near_next": pa.array([likeness(own[i], own[i + 1]) for i in at], pa.float64())})

        for batch in pieces(batches):
            ids += batch.column("doc_id").to_pylist()
            texts += batch.column("text").fill_null("").to_pylist()
            marks += batch.column("closing").to_pylist()
            size += sum(map(len, texts[-batch.num_rows:]))
            if size >= 1 << 20:
                yield done()
                ids, texts, marks, size = ids[-1:], texts[-1:], marks[-1:], len(texts[-1])
        if len(texts) > 1:
            yield done()
    return run


def compare(docs: DataFrame) -> DataFrame:
    """Digests of ``docs(doc_id, text)`` and of their edited texts, with the likeness to the edited text and to the next document.

    The next document is that of the next smaller doc_id (null ids last, copies by text); the last one's is the first.
    Documents are dealt to ranges of doc_id; each range is closed by the first document of the next one.
    """
    rows = only(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    rank = ranks(rows)
    n = partitions(rows.sparkSession)
    many = 4 * n
    edges = rows.select("doc_id").approxQuantile("doc_id", [i / many for i in range(1, many)], 1 / (4 * many))
    edges = sorted({int(e) for e in edges}, reverse=True)
    over = F.array(*[F.lit(e) for e in edges]) if edges else F.array().cast("array<bigint>")
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), len(edges) + 1).otherwise(
        F.size(F.filter(over, lambda e: e > F.col("doc_id")))))
    heads = rows.groupBy("bucket").agg(F.max("doc_id").alias("head")).collect()  # at most one a range
    heads = sorted((r["bucket"], r["head"]) for r in heads)
    closed = [(heads[i - 1][0], *heads[i]) for i in range(len(heads))]  # the last range is closed by the first
    spark = rows.sparkSession
    ends = F.broadcast(spark.createDataFrame(closed, "closes int, b int, head long"))
    closing = (rows.join(ends, (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("head")))
               .groupBy("closes").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
               .select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("closes").alias("bucket"), F.lit(True).alias("closing")))
    return (rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("closing", F.lit(False)).select("doc_id", "text", "bucket", "closing")
            .union(closing).repartition(n, "bucket")
            .sortWithinPartitions("bucket", "closing", F.col("doc_id").desc_nulls_last(), "text")
            .mapInArrow(_compared(rank), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                         "edited_fingerprint string, near_edited double, near_next double"))
