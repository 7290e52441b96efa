"""Exact linear-interpolated quantiles without holding a column in one place.

The built-in exact percentile keeps every distinct value of a group in one
task. Here a sketch brackets each wanted order statistic first. One more pass
then counts the rows between the brackets and groups the values inside them, so
only a sliver of each column is shuffled. Counts and the picked values are all
that reaches the driver, and the answer is exact at any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.operators.ranks import running_before
from foldwise.scratch import written

DIRECT_CELLS = 4_000_000
SKETCH_ACCURACY = 1000
SLACK = 2.0 / SKETCH_ACCURACY

Interval = tuple[float, float]


def exact_quantiles(df: DataFrame, targets: Mapping[str, tuple[Column, Sequence[float]]],
                    direct_cells: int = DIRECT_CELLS) -> dict[str, list[float | None]]:
    """Quantiles of many expressions over one table, nulls skipped.

    ``targets`` maps a name to an expression and its probabilities; restrict a
    target to a subset by giving ``when(condition, column)``. Up to
    ``direct_cells`` values in all are grouped without a sketch. The table is
    read three times: hand in a stored one where it is the result of joins.
    """
    names = list(targets)
    values = [targets[n][0].cast("double") for n in names]
    counts = list(df.agg(*[F.count(v) for v in values]).first())
    wanted = [sorted({r for p in targets[n][1] for r in _around(p, c)}) if c else []
              for n, c in zip(names, counts)]
    if sum(counts) <= direct_cells:
        found = _pick(written(_grouped(df, values, [[] for _ in names])), wanted)
    else:
        brackets = _brackets(df, values, [targets[n][1] for n in names])
        grouped = written(_grouped(df, values, brackets))
        found = _pick(grouped, wanted)
        missed = [i for i, ranks in enumerate(wanted) if any((i, r) not in found for r in ranks)]
        if missed:  # a sketch fell outside its error bound: group these columns whole
            keep = [wanted[i] if i in missed else [] for i in range(len(names))]
            some = [v if i in missed else F.lit(None).cast("double") for i, v in enumerate(values)]
            found |= _pick(written(_grouped(df, some, [[] for _ in names])), keep)
    out = {}
    for i, name in enumerate(names):
        row = []
        for p in targets[name][1]:
            if not counts[i]:
                row.append(None)
                continue
            at = p * (counts[i] - 1)
            low, high = found[(i, math.floor(at))], found[(i, math.ceil(at))]
            row.append(low + (high - low) * (at - math.floor(at)))
        out[name] = row
    return out


def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    found = exact_quantiles(df, {c: (F.col(c), [0.5]) for c in cols})
    return {c: found[c][0] for c in cols}


def _around(p: float, n: int) -> list[int]:
    at = p * (n - 1)
    return [math.floor(at), math.ceil(at)]


def _brackets(df, values, probs) -> list[list[Interval]]:
    """Disjoint intervals per expression that hold the wanted order statistics."""
    shares = [sorted({min(max(p + d, 0.0), 1.0) for p in ps for d in (-SLACK, SLACK)}) for ps in probs]
    row = df.agg(*[F.struct(F.min(v).alias("low"), F.max(v).alias("high"),
                            F.percentile_approx(v, s, SKETCH_ACCURACY).alias("at"))
                   for v, s in zip(values, shares)]).first()
    out = []
    for cell, s, ps in zip(row, shares, probs):
        if cell["low"] is None:
            out.append([])
            continue
        at = dict(zip(s, cell["at"])) | {0.0: cell["low"], 1.0: cell["high"]}
        spans = sorted((at[max(p - SLACK, 0.0)], at[min(p + SLACK, 1.0)]) for p in ps)
        merged = [spans[0]]
        for low, high in spans[1:]:
            if low <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
            else:
                merged.append((low, high))
        out.append(merged)
    return out


def _grouped(df, values, brackets) -> DataFrame:
    """``(key, slot, v, n)``: even slots count the rows between intervals (v null),
    odd slots hold the distinct values inside an interval. Without intervals all
    values are in slot 1."""
    if not any(brackets):
        cells = [F.struct(F.lit(i).alias("key"), v.alias("v")) for i, v in enumerate(values)]
        long = df.select(F.explode(F.array(*cells)).alias("c")).select("c.key", F.lit(1).alias("slot"), "c.v")
        return long.where(F.col("v").isNotNull()).groupBy("key", "slot", "v").agg(F.count(F.lit(1)).alias("n"))
    lows = [np.array([low for low, _ in b], dtype=float) for b in brackets]
    highs = [np.array([high for _, high in b], dtype=float) for b in brackets]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between = [np.zeros(2 * len(b) + 1, dtype="int64") for b in brackets]
        for batch in batches:
            for i, column in enumerate(batch.columns):
                if not len(lows[i]):
                    continue
                v = column.drop_null().to_numpy(zero_copy_only=False)
                below = np.searchsorted(highs[i], v, side="left")  # NaN is the largest value here and there
                inside = np.searchsorted(lows[i], v, side="right") > below
                between[i] += np.bincount(2 * below[~inside], minlength=len(between[i]))
                found, first, n = np.unique(v[inside], return_index=True, return_counts=True)
                if len(found):
                    yield rows(i, 2 * below[inside][first] + 1, pa.array(found), n)
        for i, n in enumerate(between):
            slot = np.flatnonzero(n)
            if len(slot):
                yield rows(i, slot, pa.nulls(len(slot), pa.float64()), n[slot])

    def rows(key: int, slot: np.ndarray, v: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), key, dtype="int32")), pa.array(slot.astype("int32")), v,
                                           pa.array(n.astype("int64"))], ["key", "slot", "v", "n"])

    counted = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values)]).mapInArrow(run, "key int, slot int, v double, n long")
    return counted.groupBy("key", "slot", "v").agg(F.sum("n").alias("n"))


def _pick(grouped: DataFrame, wanted: Sequence[Sequence[int]]) -> dict[tuple[int, int], float]:
    """Values at the wanted 0-based ranks, as ``(key, rank) -> value``."""
    slots: dict[int, list[tuple[int, int]]] = {}
    for r in grouped.groupBy("key", "slot").agg(F.sum("n").alias("n")).collect():
        slots.setdefault(r["key"], []).append((r["slot"], r["n"]))
    asked: dict[tuple[int, int], list[int]] = {}
    start: dict[tuple[int, int], int] = {}
    for key, sizes in slots.items():
        below = 0
        for slot, n in sorted(sizes):
            start[(key, slot)] = below
            hits = [r - below for r in wanted[key] if below <= r < below + n]
            if hits and slot % 2:
                asked[(key, slot)] = hits
            below += n
    if not asked:
        return {}
    spots = grouped.sparkSession.createDataFrame(
        [(k, s, r) for (k, s), ranks in asked.items() for r in ranks], "k int, s int, r long")
    ranked = running_before(grouped.where(F.col("v").isNotNull()), "v", ["n"], ["key", "slot"])
    hit = ranked.join(F.broadcast(spots), (F.col("key") == F.col("k")) & (F.col("slot") == F.col("s"))
                      & (F.col("r") >= F.col("n_before")) & (F.col("r") < F.col("n_before") + F.col("n")))
    return {(row["key"], row["r"] + start[(row["key"], row["slot"])]): row["v"]
            for row in hit.select("key", "slot", "r", "v").collect()}
