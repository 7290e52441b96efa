"""Language identification by the nearest of several centroids per language, over TF-IDF vectors of byte n-grams.

Texts are lower-cased in A-Z; everything in ASCII but letters separates. Two- and three-byte sequences are hashed to ``SLOTS``
dimensions, counted over the whole text, weighed by inverse document frequencies over all documents to learn from, and
normalised. Each language has up to ``CENTROIDS`` centroids from spherical k-means over a bounded, hashed sample of its documents.
A text gets the language of the centroid with the largest cosine; ``rejected`` tells that it lies further from that
centroid than nearly all of the centroid's own documents.

Null texts and texts without a letter are ``und`` with score 0, as is everything if there is nothing to learn from. Ties go to the
smaller language code. Repeated rows are scored each, very long texts whole. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foldwise.llm.common import fresh, mix64, pieces, short_batches, utf8

SLOTS, CENTROIDS, ROUNDS = 4096, 4, 12
SAMPLE = 1500  # documents of a language from which its centroids are made, about
ROWS = 512  # texts whose vectors are held at a time
OUTLIERS = 0.005  # share of a centroid's documents beyond its rejection distance

BYTE_CLASS = np.arange(256, dtype=np.uint32)
BYTE_CLASS[:128] = 0x20
BYTE_CLASS[0x61:0x7B] = BYTE_CLASS[0x41:0x5B] = np.arange(0x61, 0x7B)
_codes = np.arange(1 << 16)
PAIR_SLOT = (mix64(_codes) >> np.uint64(40)).astype(np.uint32) % SLOTS
PAIR_SALT = (mix64(_codes + (1 << 20)) >> np.uint64(32)).astype(np.uint32)
BYTE_SALT = (mix64(np.arange(256) + (1 << 30)) >> np.uint64(32)).astype(np.uint32)


def counts(column: pa.Array) -> np.ndarray:
    """How often each slot's sequences occur in each text."""
    data, offsets = utf8(column)
    n, rows = len(data), len(offsets) - 1
    out = np.zeros((rows, SLOTS), np.float32)
    if n < 2:
        return out
    kind = BYTE_CLASS[data]
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(offsets))
    pair = kind[:-1] << np.uint32(8) | kind[1:]
    two = (row[:-1] == row[1:]) & (pair != 0x2020)
    three = two[:-1] & (row[:-2] == row[2:])
    slot3 = (PAIR_SALT[pair[:-1]] ^ BYTE_SALT[kind[2:]] * np.uint32(0x9E3779B1)) >> np.uint32(7)
    at = np.concatenate([row[:-1][two] * SLOTS + PAIR_SLOT[pair[two]], row[:-2][three] * SLOTS + slot3[three] % SLOTS])
    return np.bincount(at, minlength=rows * SLOTS).reshape(rows, SLOTS).astype(np.float32)


def _weighed(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.sqrt(x) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(SLOTS, np.int64), 0
    for batch in pieces(batches, rows=ROWS):
        total += (counts(batch.column("text")) > 0).sum(0)
        rows += batch.num_rows
    yield pa.RecordBatch.from_pydict({"slot": np.arange(SLOTS + 1, dtype=np.int32), "n": np.append(total, rows)})


def _centroids(idf: np.ndarray):
    schema = pa.schema([("lang", pa.string()), ("centroid", pa.binary()), ("least", pa.float64())])

    def run(group: pa.Table) -> pa.Table:
        order = np.argsort(group["hash"].to_numpy(), kind="stable")
        text = group["text"].combine_chunks().take(pa.array(order))
        x = np.concatenate([_weighed(counts(text.slice(a, ROWS)), idf) for a in range(0, len(text), ROWS)])
        x = x[np.linalg.norm(x, axis=1) > 0]
        if not len(x):
            return schema.empty_table()
        c = x[:1]
        while len(c) < min(CENTROIDS, len(x)):  # the document furthest from the centroids so far
            c = np.concatenate([c, x[[np.argmin((x @ c.T).max(1))]]])
        for _ in range(ROUNDS):
            own = (x @ c.T).argmax(1)
            c = np.stack([x[own == k].sum(0) if (own == k).any() else c[k] for k in range(len(c))])
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        near = x @ c.T
        own = near.argmax(1)
        least = [float(np.quantile(near[own == k, k], OUTLIERS)) if (own == k).any() else 0.0 for k in range(len(c))]
        return pa.table([pa.array([group["lang"][0].as_py()] * len(c)), pa.array([v.astype(np.float32).tobytes() for v in c]),
                         pa.array(least)], schema=schema)
    return run


def fit(docs: DataFrame) -> tuple[np.ndarray, list[tuple[str, bytes, float]]]:
    """Weights and centroids from ``docs(doc_id, text, lang)``; rows without language are not used."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), "lang").where(
        "lang is not null and text is not null")
    found = short_batches(docs.select("text")).mapInArrow(_frequencies, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(SLOTS + 1)
    for r in found:
        df[r["slot"]] = r["n"]
    idf = (np.log((df[-1] + 1) / (df[:-1] + 1)) + 1).astype(np.float32)
    shares = docs.groupBy("lang").agg(F.count("*").alias("n")).select(
        F.col("lang").alias("l"), (F.lit(float(SAMPLE)) / F.col("n")).alias("share"))
    hashed = F.xxhash64("doc_id", F.length("text"), F.lit("sample"))
    sample = (docs.withColumn("hash", hashed).join(F.broadcast(shares), F.col("lang") == F.col("l"))  # a row per language
              .where(F.shiftrightunsigned("hash", 11) / F.lit(float(1 << 53)) < F.col("share")).select("lang", "text", "hash"))
    rows = sample.groupBy("lang").applyInArrow(_centroids(idf), "lang string, centroid binary, least double").collect()
    return idf, sorted((r["lang"], bytes(r["centroid"]), r["least"]) for r in rows)


def predict(docs: DataFrame, model: tuple[np.ndarray, list[tuple[str, bytes, float]]]) -> DataFrame:
    """``docs`` with further columns ``lang_pred``, ``score`` and ``rejected``, from ``text`` alone; columns that it has by these names go."""
    idf, centroids = model
    docs = docs.drop("lang_pred", "score", "rejected")
    names = docs.columns
    letter = fresh(docs, "_letter")[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = np.array([np.frombuffer(v, np.float32) for _, v, _ in centroids])
        lang, least = np.array([k for k, _, _ in centroids], object), np.array([x for _, _, x in centroids])
        for batch in pieces(batches, rows=ROWS):
            letters = batch.column(letter).to_numpy(zero_copy_only=False).astype(bool)
            if len(c):
                near = _weighed(counts(batch.column("text")), idf) @ c.T
                best = near.argmax(1)
                value = np.clip(near[np.arange(len(best)), best].astype(float), 0, 1)
                pred, far = np.where(letters, lang[best], "und"), value < least[best]
            else:
                value, far, pred = np.zeros(batch.num_rows), np.ones(batch.num_rows, bool), np.full(batch.num_rows, "und")
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(pred.tolist(), pa.string()),
                 pa.array(np.where(letters, value, 0.0)), pa.array(far | ~letters)], [*names, "lang_pred", "score", "rejected"])

    marked = short_batches(docs).withColumn(letter, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    schema = StructType(docs.schema.fields + StructType.fromDDL("lang_pred string, score double, rejected boolean").fields)
    return marked.mapInArrow(run, schema)
