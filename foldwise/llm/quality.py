"""Text quality by compression: which of two dictionaries, built from good and from bad text, shortens a text more.

Fitting takes a bounded sample of labelled rows, and of their whole texts parts of 512 bytes up to about 16 MB a label. One half of it (by
a hash of the id) gives two zstandard dictionaries, the other half a calibration. The score rests on one number: what the good dictionary
saves against the bad one, in compressed bytes per byte of text. A ridge-penalised logistic curve makes a probability of it. Nothing else
of a text enters, neither its length nor how well it compresses without a dictionary. Scoring compresses every whole text, in parts of 512
bytes so that the dictionaries keep their weight in long texts; each part counts.

Null and empty texts are compressed to nothing and get the calibrated value of that; ties cannot arise, equal texts have equal
scores; repeated rows are scored each. Without labels of both kinds every score is the mean label, or 0.5 without any.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from foldwise.llm.common import mix64, pieces, short_batches

PART, LEVEL, DICTIONARY = 512, 3, 112 << 10  # bytes of a part, compression level, bytes of a dictionary
DICTIONARY_ROWS, CALIBRATION_ROWS = 2000, 8000  # labelled rows used at most: of each label, and for the curve
SAMPLE_BYTES = 16 << 20  # of the parts of each label that a dictionary learns from, about
RIDGE = 0.05
SHORT = 32  # bytes that a text is taken to be longer, so that a few letters prove little
_DRAWN = pa.schema([("label", pa.int32()), ("doc_id", pa.int64()), ("key", pa.int64()), ("place", pa.int64()), ("part", pa.binary())])


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    mean: np.ndarray | None
    scale: np.ndarray | None
    weights: np.ndarray | None
    constant: float


def _drawn(share: dict[int, float]):
    """Parts of whole texts, chosen by a hash of text and position, so that all places of a long text can be drawn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = []
            for label, doc_id, key, text in zip(*(batch.column(c).to_pylist() for c in ("label", "doc_id", "key", "text"))):
                data = text.encode()
                place = np.arange(-(-len(data) // PART))
                chance = (mix64(place.astype(np.uint64) ^ mix64(np.array([key]).view(np.uint64))) >> np.uint64(11)) / 2.0 ** 53
                out += [(label, doc_id, key, i, data[i * PART:(i + 1) * PART]) for i in np.flatnonzero(chance < share[label]).tolist()]
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(_DRAWN.names, zip(*out))), schema=_DRAWN)
    return run


def _dictionary(parts: list[bytes]) -> bytes:
    import zstandard
    parts = [p for p in parts if len(p) >= 8]
    try:
        return zstandard.train_dictionary(DICTIONARY, parts).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: its raw content serves
        return b"".join(parts)[-DICTIONARY:]


class _Differences:
    """How much shorter than under the bad dictionary a text is under the good one, relative to its bytes."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard as z
        plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.by = []
        for content in (good, bad):
            known = z.ZstdCompressionDict(content) if len(content) >= 8 else None
            if known:
                known.precompute_compress(level=LEVEL)
            c = z.ZstdCompressor(**plain, **({"dict_data": known} if known else {}))
            self.by.append((c, len(c.compress(b""))))

    def of(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), 1))
        for i, text in enumerate(texts):
            data = text.encode()
            parts = [data[a:a + PART] for a in range(0, len(data), PART)]
            good, bad = (sum(len(c.compress(p)) - least for p in parts) for c, least in self.by)
            out[i] = (bad - good) / (len(data) + SHORT)
        return out


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean, scale = x.mean(0), x.std(0) + 1e-9
    x = np.c_[np.ones(len(x)), (x - mean) / scale]
    penalty = RIDGE * np.r_[1e-6, np.ones(x.shape[1] - 1)]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from ``docs(doc_id, text)`` and ``labels(doc_id, label)`` of 0 and 1; other labels are not used."""
    labels = labels.select("doc_id", F.col("label").cast("int").alias("label")).where("label in (0, 1)")
    half, order = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)), F.xxhash64("doc_id", F.lit("order"))
    parts = [labels.where((half == 0) & (F.col("label") == v)).orderBy(order, "doc_id").limit(DICTIONARY_ROWS)
             .withColumn("use", F.lit(v)) for v in (0, 1)]
    parts.append(labels.where(half == 1).orderBy(order, "doc_id").limit(CALIBRATION_ROWS).withColumn("use", F.lit(2)))
    chosen = parts[0].union(parts[1]).union(parts[2]).withColumnRenamed("doc_id", "_id")  # bounded: may be broadcast
    bound = 2 * DICTIONARY_ROWS + CALIBRATION_ROWS
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    texts = rows.where("use < 2 and text is not null").select(
        "label", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("key"), "text")
    totals = texts.groupBy("label").agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n")).collect()
    share = {r["label"]: SAMPLE_BYTES / max(r["bytes"], 1) for r in totals}
    drawn = short_batches(texts).mapInArrow(_drawn(share), "label int, doc_id long, key long, place long, part binary")
    samples = sorted(drawn.collect(), key=lambda r: (r["doc_id"], r["key"], r["place"]))
    good, bad = (_dictionary([bytes(r["part"]) for r in samples if r["label"] == v]) for v in (1, 0))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        differences = _Differences(good, bad)
        for batch in pieces(batches):
            x = differences.of(batch.column("text").fill_null("").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(x.tolist(), pa.list_(pa.float64()))], ["label", "x"])

    seen = rows.where("use = 2").select("label", "text").limit(bound).mapInArrow(measured, "label int, x array<double>").collect()
    y = np.array([r["label"] for r in seen], float)
    if len(y) == 0 or y.min() == y.max():
        known = y if len(y) else np.repeat([r["label"] for r in totals], [r["n"] for r in totals]).astype(float)
        return Model(good, bad, None, None, None, float(known.mean()) if len(known) else 0.5)
    by = sorted(seen, key=lambda r: (r["label"], r["x"]))  # the same sums whatever the order of arrival
    return Model(good, bad, *_curve(np.array([r["x"] for r in by]), np.array([r["label"] for r in by], float)), 0.0)


def score(docs: DataFrame, model: Model, name: str = "quality_score") -> DataFrame:
    """``docs`` with a further column, named ``name``, from 0 to 1, from ``text`` alone; a column that it has by this name goes."""
    docs = docs.drop(name)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        differences = _Differences(model.good, model.bad)
        for batch in pieces(batches):
            if model.weights is None:
                value = np.full(batch.num_rows, model.constant)
            else:
                x = (differences.of(batch.column("text").fill_null("").to_pylist()) - model.mean) / model.scale
                value = 1 / (1 + np.exp(-np.clip(x @ model.weights[1:] + model.weights[0], -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], [*names, name])

    return short_batches(docs).mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def fold(doc_id: str | Column, folds: int) -> Column:
    """The remainder that deals documents to folds: crc32 of the id as text."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id), F.lit(folds))
