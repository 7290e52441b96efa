"""Exact linking of candidate clusters, in bounded units of work.

Items that share a candidate key are candidates. Clusters are the connected components of items and keys; an item's set
of tokens travels once to its cluster. Small clusters are put together into units of bounded size; a cluster beyond that
is cut into blocks, and every pair of blocks is a unit, so that no pair is lost and no task grows with a cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from foldwise.llm.common import Scratch, ragged
from foldwise.llm.components import components

UNIT_ITEMS, UNIT_BYTES = 2048, 32 << 20  # of a unit, about
RANGES = 16  # token ranges that the suffix filter compares


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        uid = batch.column("uid").to_numpy()
        keys = [np.frombuffer(k, np.int64) for k in batch.column("keys").to_pylist()]
        if keys:
            yield pa.RecordBatch.from_pydict({
                "token": np.concatenate(keys), "uid": np.repeat(uid, [len(k) for k in keys])})


class _Lists:
    """Ragged rows of numbers with the reverse index: which rows, in ascending order, hold a number."""

    def __init__(self, rows: list[np.ndarray]):
        self.size = np.array([len(r) for r in rows], np.int64)
        self.start = np.cumsum(self.size) - self.size
        flat = np.concatenate(rows) if rows else np.empty(0, np.uint64)
        _, self.value = np.unique(flat, return_inverse=True)
        row, place = np.repeat(np.arange(len(rows)), self.size), np.arange(len(flat)) - np.repeat(self.start, self.size)
        order = np.argsort(self.value, kind="stable")
        self.holder, self.place = row[order], place[order]
        self.ends = np.cumsum(np.bincount(self.value, minlength=1))
        self.begins = np.concatenate([[0], self.ends[:-1]])

    def row(self, i: int) -> np.ndarray:
        return self.value[self.start[i]:self.start[i] + self.size[i]]


def _linked(percent: int, ordered: bool, weighted: bool = False) -> Callable[[pa.Table], pa.Table]:
    """Links of a unit that join two parts of it. With ``weighted`` every pair is verified, and each item with links has a row of its
    own, from itself to itself, with the number of copies it is linked with."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), *([("links", pa.int64())] if weighted else [])])

    def run(unit: pa.Table) -> pa.Table:
        unit = unit.sort_by([("n", "ascending"), ("uid", "ascending")])
        uid, n, block = (unit[c].to_numpy() for c in ("uid", "n", "block"))
        cross = unit["low"][0].as_py() != unit["high"][0].as_py()
        tokens = _Lists([np.frombuffer(t, np.uint64) for t in unit["tokens"].to_pylist()])
        keys = _Lists([np.frombuffer(t, np.uint64) for t in unit["keys"].to_pylist()])
        lead = n - tokens.size if ordered else None  # tokens that nobody else holds come first in the order
        span = max(1, -(-(int(tokens.value.max()) + 1) // RANGES)) if len(tokens.value) else 1
        ranges = np.zeros((len(uid), RANGES), np.int32)
        np.add.at(ranges, (np.repeat(np.arange(len(uid)), tokens.size), tokens.value // span), 1)
        label = np.arange(len(uid))
        copies, links = (unit["copies"].to_numpy(), np.zeros(len(uid), np.int64)) if weighted else (None, None)
        found_a, found_b = [], []
        for x in range(1, len(uid)):
            mine = keys.row(x)
            begins = keys.begins[mine]
            at = ragged(begins, keys.ends[mine] - begins)
            earlier = keys.holder[at] < x
            at = at[earlier]
            y = keys.holder[at]
            if not len(y):
                continue
            y, first = np.unique(y, return_index=True)  # the first key that both hold, in the order of x
            keep = 100 * n[y] >= percent * n[x]
            if not weighted:
                keep &= label[y] != label[x]
            if cross:
                keep &= block[y] != block[x]
            need = -(-percent * (n[x] + n[y]) // (100 + percent))  # overlap that two sets of these sizes must have
            if ordered:
                place = np.repeat(np.arange(len(mine)), keys.ends[mine] - begins)[earlier][first]
                # no common token stands before the first common key: positions bound the overlap
                keep &= np.minimum(n[x] - lead[x] - place, n[y] - lead[y] - keys.place[at[first]]) >= need
            y, need = y[keep], need[keep]
            if len(y):
                bound = np.minimum(ranges[x], ranges[y]).sum(1)
                y, need = y[bound >= need], need[bound >= need]
            if not len(y):
                continue
            own = tokens.row(x)
            if len(y) <= 8:
                common = np.array([len(np.intersect1d(own, tokens.row(i), assume_unique=True)) for i in y])
            else:
                held = ragged(tokens.begins[own], tokens.ends[own] - tokens.begins[own])
                common = np.bincount(tokens.holder[held], minlength=len(uid))[y]
            met = y[100 * common >= percent * (n[x] + n[y] - common)]
            if weighted and len(met):
                links[x] += copies[met].sum()
                links[met] += copies[x]
            for i in met:
                if label[i] != label[x]:
                    label[label == label[i]] = label[x]
                    found_a.append(uid[i])
                    found_b.append(uid[x])
        some = np.flatnonzero(links) if weighted else np.empty(0, np.int64)
        columns = [np.concatenate([np.array(c, np.int64), uid[some]]) for c in (found_a, found_b)]
        if weighted:
            columns.append(np.concatenate([np.zeros(len(found_a), np.int64), links[some]]))
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=schema)
    return run


def clusters(items: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``uid, label`` of the items of a stored table ``uid, keys`` that share a key with another; keys are packed 64-bit numbers."""
    postings = items.select("uid", "keys").mapInArrow(_postings, "token long, uid long")
    leads = (postings.groupBy("token").agg(F.min("uid").alias("lead"), F.max("uid").alias("last"))
             .where("lead < last").select(F.col("token").alias("t"), "lead"))
    edges = postings.join(leads, F.col("token") == F.col("t")).select(F.col("uid").alias("a"), F.col("lead").alias("b"))
    return components(edges, scratch, f"{name}-clusters").select(F.col("node").alias("uid"), F.col("root").alias("label"))


def linked(labels: DataFrame, items: DataFrame, scratch: Scratch, name: str, percent: int, ordered: bool) -> DataFrame:
    """``node, root`` of the items linked, directly or by way of others, by a Jaccard similarity of ``percent`` or more.

    ``items`` is a stored table ``uid, n, keys, tokens``: size of the whole set, candidate keys and tokens (64-bit, packed);
    ``labels`` are their clusters. With ``ordered``, keys and tokens stand in one global order, keys are the first of the tokens,
    and the n - len(tokens) elements that are not in ``tokens`` come before all of them and are held by nobody else.
    """
    found = _placed(labels, items, scratch, name).applyInArrow(_linked(percent, ordered), "a long, b long")
    return components(found, scratch, f"{name}-links")


def weighted_links(labels: DataFrame, items: DataFrame, scratch: Scratch, name: str, percent: int, ordered: bool) -> tuple[DataFrame, DataFrame]:
    """:func:`linked`, and ``uid, links``: by how many ``copies`` of other items each is linked. Each pair is verified, once."""
    found = scratch.keep(_placed(labels, items, scratch, name).applyInArrow(
        _linked(percent, ordered, True), "a long, b long, links long"), f"{name}-pairs")
    degrees = found.where("a = b").groupBy(F.col("a").alias("uid")).agg(F.sum("links").alias("links"))
    return components(found.where("a <> b").select("a", "b"), scratch, f"{name}-links"), degrees


def _placed(labels: DataFrame, items: DataFrame, scratch: Scratch, name: str) -> GroupedData:
    """The items by units of work."""
    weighed = labels.join(items.select("uid", (F.octet_length("tokens") + F.octet_length("keys")).alias("bytes")), "uid")
    sizes = weighed.groupBy("label").agg(F.count("*").alias("items"), F.sum("bytes").alias("bytes"))
    sizes = scratch.keep(sizes.select("label", "items", F.greatest(
        F.ceil(F.col("items") / UNIT_ITEMS), F.ceil(F.col("bytes") / UNIT_BYTES)).alias("parts")), f"{name}-sizes")
    small = sizes.where("parts = 1").agg(F.sum("items")).first()[0] or 0
    units = -(-small // UNIT_ITEMS) or 1
    # a cut cluster has blocks of half a unit, so that two of them make a unit
    placed = (labels.join(sizes.select("label", "parts"), "label")
              .withColumn("blocks", F.when(F.col("parts") == 1, 1).otherwise(2 * F.col("parts")).cast("int"))
              .withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
              .select("uid", "block",
                      F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("label"), F.lit(units))).otherwise(F.col("label")).alias("unit"),
                      F.when(F.col("blocks") == 1, -1).otherwise(F.least("block", "other")).alias("low"),
                      F.when(F.col("blocks") == 1, -1).otherwise(F.greatest("block", "other")).alias("high")))
    return placed.join(items, "uid").groupBy("unit", "low", "high")
