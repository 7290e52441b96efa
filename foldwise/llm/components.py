"""Connected components of an edge table, by contraction: tasks join what they hold, nodes carry the rest over."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import Scratch

PART_EDGES = 1 << 20  # edges that one task joins at a time


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges and the smallest node connected with each."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    parent = np.arange(len(ids))
    while True:
        low, high = np.minimum(parent[x], parent[y]), np.maximum(parent[x], parent[y])
        open_ = low != high
        if not open_.any():
            return ids, ids[parent]
        np.minimum.at(parent, high[open_], low[open_])
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        x, y = x[open_], y[open_]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
    if parts:
        node, root = roots(*(np.concatenate(c) for c in zip(*parts)))
        yield pa.RecordBatch.from_pydict({"node": node[node != root], "root": root[node != root]})


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; the root is the smallest node of its component.

    Each round every task reduces its edges to stars, and every node keeps its smallest centre; what the other centres
    say becomes an edge between centres, of which there are fewer each time. Once the edges fit one task it ends.
    """
    edges = scratch.keep(edges.select("a", "b").where("a <> b").distinct(), f"{name}-edges-0")
    levels = []
    while True:
        parts = -(-edges.count() // PART_EDGES)
        if not parts:
            break
        stars = edges.repartition(parts).mapInArrow(_stars, "node long, root long")
        level = len(levels)
        if parts == 1:
            levels.append(scratch.keep(stars, f"{name}-level-{level}"))
            break
        stars = scratch.keep(stars, f"{name}-stars-{level}")
        best = scratch.keep(stars.groupBy("node").agg(F.min("root").alias("root")), f"{name}-level-{level}")
        levels.append(best)
        low = best.select(F.col("node").alias("n"), F.col("root").alias("low"))
        between = stars.join(low, stars["node"] == low["n"]).where("root <> low").select(
            F.col("root").alias("a"), F.col("low").alias("b"))
        centres = stars.select(F.col("root").alias("c")).distinct()
        up = best.join(centres, best["node"] == centres["c"], "left_semi").select(
            F.col("node").alias("a"), F.col("root").alias("b"))
        edges = scratch.keep(between.union(up).distinct(), f"{name}-edges-{level + 1}")
    spark = scratch.spark
    if not levels:
        return spark.createDataFrame([], "node long, root long")
    found = levels.pop()
    while levels:
        level = levels.pop()
        above = found.select(F.col("node").alias("centre"), F.col("root").alias("top"))
        lifted = level.join(above, level["root"] == above["centre"], "left").select(
            "node", F.coalesce("top", "root").alias("root"))
        rest = found.join(level.select("node"), "node", "left_anti")
        found = lifted.union(rest)
    found = scratch.keep(found, f"{name}-found")
    return found.union(found.select(F.col("root").alias("node"), "root").distinct())
