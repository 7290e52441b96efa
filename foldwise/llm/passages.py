"""Paragraphs that repeat, exactly or nearly, within and across documents.

Paragraphs are the parts of a text between line feeds. Those of at least five words take part: equal word sequences are one class,
and classes get MinHash values of their five-word shingles, banded for recall (16 bands of 4: at a similarity of 0.8 a pair
meets with a chance of 0.9998). Paragraphs that meet in a band are verified by the exact Jaccard similarity of their
shingle sets; linked paragraphs form components, of which the first paragraph, by doc_id and position, stays.

A band that nobody shares never leaves its bucket, and shingles are read again only for paragraphs that met another.
Null and empty texts have no paragraphs. Null ids come last in the order. Rows alike in doc_id and text are copies of each other,
and :func:`remove` treats them alike: they lose a paragraph only if none of them keeps it. Very long texts are taken whole.
An empty table gives an empty result. Other columns are not read, and :func:`remove` hands them on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm import shared
from foldwise.llm.common import Scratch, fresh, mix64, only, pieces, ragged, short_batches, utf8
from foldwise.llm.units import clusters, linked
from foldwise.llm.words import distinct, shingles, word_hashes

SHINGLE, BANDS, ROWS = 5, 16, 4
CHUNK_BYTES = 4 << 20
NOTE = ("doc_id", "known", "text_hash", "paragraph", "n_words", "one", "two")


def paragraphs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of all paragraphs, the row each belongs to, and its place there."""
    starts = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 0x0A) + 1]))
    starts = starts[starts < len(data)]
    row = np.searchsorted(offsets, starts, "right") - 1
    first = np.searchsorted(starts, offsets[:-1])
    return np.append(starts, len(data)), row, np.arange(len(starts)) - first[row]


def band_keys(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The band hashes of every row that has values, ``BANDS`` in a row."""
    begins = (np.cumsum(counts) - counts)[counts > 0]
    out = np.empty((len(begins), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(begins), band, np.uint64)
        for k in range(ROWS):
            salt = mix64(np.array([band * ROWS + k + 1], np.uint64))[0]
            hashed = (values ^ salt) * (salt | np.uint64(1))
            hashed ^= hashed >> np.uint64(32)
            key = mix64(key ^ np.minimum.reduceat(hashed * np.uint64(0xD6E8FEB86659FD93), begins))
        out[:, band] = key
    return out


def sequence_digests(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two digests of the words of each row, in their order."""
    ends = np.cumsum(counts)
    place = (np.arange(len(hashes)) - np.repeat(ends - counts, counts)).astype(np.uint64)
    out = []
    for salt in (0x51ED2701, 0x2545F491):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(hashes ^ mix64(place + np.uint64(salt))))])
        out.append(mix64(sums[ends] - sums[ends - counts]))
    return out[0], out[1]


def _sent(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, notes, keys, size = TaskContext.get().partitionId() << 40, [], [], 0

        def chunk():
            note, bands = np.concatenate(notes, axis=1), np.concatenate(keys)
            _, first = np.unique(note[5:], axis=1, return_index=True)
            is_first = np.zeros(note.shape[1], bool)
            is_first[first] = True
            bands = bands[is_first]
            sizes = np.where(is_first, BANDS, 0)
            return shared.send(base, sizes, bands.ravel(), bits, note.tobytes())

        for batch in pieces(batches):
            ids = batch.column("doc_id").cast(pa.int64())
            data, offsets = utf8(batch.column("text"))
            size += len(data)
            starts, row, place = paragraphs(data, offsets)
            hashes, _, counts = word_hashes(data, starts)
            long = counts >= SHINGLE
            hashes, counts, row, place = hashes[np.repeat(long, counts)], counts[long], row[long], place[long]
            if len(counts):
                one, two = sequence_digests(hashes, counts)
                get = lambda v: v.to_numpy(zero_copy_only=False)[row]
                notes.append(np.stack([get(ids.fill_null(0)), get(ids.is_valid()), get(batch.column("text_hash")), place,
                                       counts, one.view(np.int64), two.view(np.int64)]).astype(np.int64))
                keys.append(band_keys(*shingles(hashes, counts, SHINGLE)))
            if size >= CHUNK_BYTES and notes:
                yield chunk()
                base, notes, keys, size = base + sum(n.shape[1] for n in notes), [], [], 0
        if notes:
            yield chunk()
    return run


_PARAGRAPH = "uid long, doc_id long, text_hash long, paragraph long, n_words long, one long, two long, keys binary"


def _listed(chunk: pa.Table) -> pa.Table:
    schema = pa.schema([(c, pa.int64()) for c in ("uid", "doc_id", "text_hash", "paragraph", "n_words", "one", "two")]
                       + [("keys", pa.binary())])
    note, owner, token, _ = shared.gathered(chunk)
    doc_id, known, *rest = np.frombuffer(note, np.int64).reshape(len(NOTE), -1)
    ends = np.cumsum(np.bincount(owner, minlength=len(doc_id)))
    begins = np.concatenate([[0], ends[:-1]])
    keys = [token[a:z].tobytes() if z > a else None for a, z in zip(begins.tolist(), ends.tolist())]
    return pa.table([chunk["base"][0].as_py() + np.arange(len(doc_id)), pa.array(doc_id, mask=known == 0), *rest,
                     pa.array(keys, pa.binary())], schema=schema)


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle sets of the wanted paragraphs of each text."""
    for batch in pieces(batches):
        data, offsets = utf8(batch.column("text"))
        starts, row, place = paragraphs(data, offsets)
        hashes, _, counts = word_hashes(data, starts)
        wanted = batch.column("wanted").to_pylist()
        at = {(r, p): i for i, (r, p) in enumerate(zip(row.tolist(), place.tolist()))}
        pick = [(at[r, w["paragraph"]], w["uid"], w["keys"]) for r, ws in enumerate(wanted) for w in ws]
        if not pick:
            continue
        index = np.array([p[0] for p in pick])
        begin = (np.cumsum(counts) - counts)[index]
        values, sizes = distinct(*shingles(hashes[ragged(begin, counts[index])], counts[index], SHINGLE))
        ends = np.cumsum(sizes)
        yield pa.RecordBatch.from_pydict({
            "uid": pa.array([p[1] for p in pick], pa.int64()), "n": pa.array(sizes, pa.int64()),
            "keys": pa.array([p[2] for p in pick], pa.binary()),
            "tokens": pa.array([values[z - s:z].tobytes() for z, s in zip(ends.tolist(), sizes.tolist())], pa.binary())})


def _rows(docs: DataFrame) -> DataFrame:
    return only(docs, doc_id="doc_id", text="text").withColumn("text_hash", F.xxhash64("text"))


def _repeated(docs: DataFrame, percent: int) -> DataFrame:
    scratch, rows = Scratch(docs.sparkSession), _rows(docs)
    letters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = shared.bucket_bits(letters * BANDS // 300)
    packets = short_batches(rows).mapInArrow(_sent(bits), shared.PACKET)
    found = scratch.keep(shared.answers(packets, bits).groupBy("base").applyInArrow(_listed, _PARAGRAPH), "paragraphs")
    classes = scratch.keep(found.groupBy("one", "two").agg(
        F.min("uid").alias("rep"), F.count("*").alias("copies"),
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("paragraph"), F.col("uid"))).alias("head")), "classes")
    reps = scratch.keep(found.where("keys is not null").join(
        classes.select("rep"), F.col("uid") == F.col("rep"), "left_semi"), "reps")
    labels = clusters(reps, scratch, "paragraphs")
    wanted = (reps.join(labels.select(F.col("uid").alias("u")), F.col("uid") == F.col("u"), "left_semi")
              .groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("paragraph", "uid", "keys")).alias("wanted"))
              .select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "wanted"))
    texts = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")))
    items = scratch.keep(short_batches(texts.select("text", "wanted")).mapInArrow(
        _shingled, "uid long, n long, keys binary, tokens binary").dropDuplicates(["uid"]), "items")
    of = linked(labels, items, scratch, "paragraphs", percent, ordered=False)
    grouped = scratch.keep(classes.join(of, F.col("rep") == F.col("node"), "left").select(
        F.col("one").alias("c1"), F.col("two").alias("c2"), "copies", "head",
        F.coalesce("root", "rep").alias("component")), "grouped")
    heads = (grouped.groupBy("component").agg(F.sum("copies").alias("members"), F.min("head").alias("head"))
             .where("members > 1").select(F.col("component").alias("c"), "members", "head"))
    placed = grouped.drop("head").join(heads, F.col("component") == F.col("c"))
    return found.drop("keys").join(placed, (F.col("one") == F.col("c1")) & (F.col("two") == F.col("c2"))).select(
        "doc_id", "text_hash", "paragraph", "n_words", F.col("members").alias("n_members"),
        F.col("head.doc_id").alias("kept_doc_id"), F.col("head.paragraph").alias("kept_paragraph"),
        (F.col("uid") != F.col("head.uid")).alias("removed"))


def repeated(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Every paragraph of ``docs(doc_id, text)`` that repeats another: where it stands, which one is kept, and whether it goes."""
    return _repeated(docs, percent).drop("text_hash")


def remove(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with each text rid of the paragraphs that repeat an earlier one; texts left without any paragraph go."""
    d, h, lost, left = fresh(docs, "_d", "_h", "_gone", "_kept")
    gone = (_repeated(docs, percent).groupBy("doc_id", "text_hash", "paragraph").agg(F.min("removed").alias("removed"))
            .where("removed").groupBy("doc_id", "text_hash").agg(F.collect_list("paragraph").alias(lost))
            .select(F.col("doc_id").alias(d), F.col("text_hash").alias(h), lost))
    edited = docs.join(gone, F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(h)), "left")
    kept = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(lost, i.cast("long")))
    edited = edited.withColumn(left, F.when(F.col(lost).isNotNull(), F.array_join(kept, "\n")))
    edited = edited.where(F.col(lost).isNull() | F.col(left).rlike(r"[^\x20\x09-\x0D]"))
    return edited.select(*[F.coalesce(left, "text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
