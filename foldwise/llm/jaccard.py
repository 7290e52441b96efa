"""Documents linked by the Jaccard similarity of their word shingles, exactly.

Shingles are ordered by how many documents hold them, rarest first. Two sets of similarity t share an element among the first
n - ceil(t n) + 1 of each, so only those prefixes are joined; a document whose prefix nobody shares is done. Length, position of
the first common shingle and counts by token range rule out most other pairs; the rest is verified once, exactly.
Equal sets are one class with one representative, however many documents have them.

Words are runs of characters other than space and tab to carriage return, with A-Z lower-cased; a document with fewer words than
a shingle has one, of all its words. Null and empty texts have no shingles and link with nothing. Rows that share a doc_id, null
ids included, are documents of their own; a null id is never the smallest of a component unless it has no other.
Very long texts are taken whole. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm import shared
from foldwise.llm.common import Scratch, fresh, only, pieces, short_batches, utf8
from foldwise.llm.units import clusters, linked, weighted_links
from foldwise.llm.words import distinct, shingles, signatures, word_hashes

CHUNK_BYTES, CHUNK_ROWS = 4 << 20, 1 << 16  # text and rows that are gathered before they are sent


def _sent(size: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, held_bytes = TaskContext.get().partitionId() << 40, [], 0

        def chunk():
            doc_id, known, text, values, sizes = (np.concatenate(c) for c in zip(*held))
            one, two = signatures(values, sizes)
            _, first = np.unique(np.stack([one, two, sizes.astype(np.uint64)]), axis=1, return_index=True)
            is_first = np.zeros(len(sizes), bool)
            is_first[first] = True
            sent = np.where(is_first, sizes, 0)
            note = np.stack([doc_id, known, text, sizes, one.view(np.int64), two.view(np.int64)]).astype(np.int64)
            return shared.send(base, sent, values[np.repeat(is_first, sizes)], bits, note.tobytes())

        for batch in pieces(batches):
            ids = batch.column("doc_id").cast(pa.int64())
            data, offsets = utf8(batch.column("text"))
            hashes, _, counts = word_hashes(data, offsets)
            held.append((*(c.to_numpy(zero_copy_only=False) for c in (ids.fill_null(0), ids.is_valid(), batch.column("text_hash"))),
                         *distinct(*shingles(hashes, counts, size))))
            held_bytes += len(data)
            rows = sum(len(h[0]) for h in held)
            if held_bytes >= CHUNK_BYTES or rows >= CHUNK_ROWS:
                yield chunk()
                base, held, held_bytes = base + rows, [], 0
        if held:
            yield chunk()
    return run


def _sets(percent: int):
    schema = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("one", pa.int64()),
                        ("two", pa.int64()), ("keys", pa.binary()), ("tokens", pa.binary())])

    def run(chunk: pa.Table) -> pa.Table:
        note, owner, token, _ = shared.gathered(chunk)
        doc_id, known, text, n, one, two = np.frombuffer(note, np.int64).reshape(6, -1)
        m = len(n)
        here = np.bincount(owner, minlength=m)
        prefix = n + percent * n // -100 + 1 - (n - here)  # of the shared tokens; the others come first
        ends = np.cumsum(here)
        keys, tokens = [None] * m, [None] * m
        for i in np.flatnonzero((here > 0) & (prefix > 0)):
            row = token[ends[i] - here[i]:ends[i]]
            keys[i], tokens[i] = row[:prefix[i]].tobytes(), row.tobytes()
        base = chunk["base"][0].as_py()
        return pa.table([base + np.arange(m), pa.array(doc_id, mask=known == 0), text, n, one, two,
                         pa.array(keys, pa.binary()), pa.array(tokens, pa.binary())], schema=schema)
    return run


def _components(docs: DataFrame, percent: int, size: int, links: bool) -> DataFrame:
    """Per document doc_id, text_hash, n and the component: its smallest doc_id and the text_hash of the one that stays; with ``links``
    also n_links, the documents it is linked with."""
    scratch = Scratch(docs.sparkSession)
    docs = only(docs, doc_id="doc_id", text="text").withColumn("text_hash", F.xxhash64("text"))
    letters = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = shared.bucket_bits(letters // 6)
    packets = short_batches(docs).mapInArrow(_sent(size, bits), shared.PACKET)
    sets = scratch.keep(shared.answers(packets, bits).groupBy("base").applyInArrow(
        _sets(percent), "uid long, doc_id long, text_hash long, n long, one long, two long, keys binary, tokens binary"), "sets")
    # null ids come after all others, and of a repeated id the smallest text_hash first
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash")))
    classes = scratch.keep(sets.where("n > 0").groupBy("n", "one", "two").agg(
        F.min("uid").alias("rep"), first.alias("first"), F.count("*").alias("copies")), "classes")
    items = scratch.keep(sets.where("tokens is not null").select("uid", "n", "keys", "tokens").join(
        classes.select("rep", "copies"), F.col("uid") == F.col("rep")).drop("rep"), "items")
    labels = clusters(items, scratch, "docs")
    if links:
        of, degrees = weighted_links(labels, items, scratch, "docs", percent, ordered=True)
        classes = classes.join(degrees.withColumnRenamed("uid", "u"), F.col("rep") == F.col("u"), "left").drop("u").withColumn(
            "n_links", F.col("copies") - 1 + F.coalesce("links", F.lit(0)))
    else:
        of = linked(labels, items, scratch, "docs", percent, ordered=True)
    more = ["n_links"] if links else []
    met = classes.join(of, F.col("rep") == F.col("node"))
    smallest = met.groupBy("root").agg(F.min("first").alias("component"))
    met = met.join(smallest, "root").select(F.col("rep").alias("r"), "component")
    classes = classes.join(met, F.col("rep") == F.col("r"), "left").select(
        F.col("n").alias("cn"), F.col("one").alias("c1"), F.col("two").alias("c2"),
        F.coalesce("component", "first").alias("component"), *more)
    return sets.select("doc_id", "text_hash", "n", "one", "two").join(
        classes, (F.col("n") == F.col("cn")) & (F.col("one") == F.col("c1")) & (F.col("two") == F.col("c2")), "left").select(
        "doc_id", "text_hash", "n", "component", *more)


def join(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of ``docs(doc_id, text)``: the smallest doc_id reachable by links, and how many
    other documents are linked with this one directly. Every pair of different sets is verified; equal sets count by their number."""
    return _components(docs, percent, size, True).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component.doc_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def first_of_each(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """``docs`` with one document of each component: the first by doc_id, null ids last. Documents without words all stay."""
    d, h, has_words, own, copy = fresh(docs, "_d", "_h", "_linked", "_hash", "_copy")
    found = _components(docs, percent, size, False)
    stays = found.where((F.col("n") == 0) | (F.col("doc_id").eqNullSafe(F.col("component.doc_id"))
                                             & (F.col("text_hash") == F.col("component.text_hash"))))
    stays = stays.select(F.col("doc_id").alias(d), F.col("text_hash").alias(h), (F.col("n") > 0).alias(has_words)).distinct()
    kept = docs.withColumn(own, F.xxhash64("text")).join(
        stays, F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(own) == F.col(h)))
    # rows alike in doc_id and text stay once if they have words
    copies = Window.partitionBy("doc_id", own).orderBy(F.lit(0))
    return kept.withColumn(copy, F.row_number().over(copies)).where((F.col(copy) == 1) | ~F.col(has_words)).select(
        *[F.col(f"`{c}`") for c in docs.columns])
