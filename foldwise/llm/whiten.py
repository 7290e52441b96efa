"""Whitening of vectors by shifted CholeskyQR.

The fit list is every distinct vector once, as integers. With n of them and sums S per dimension, n x - S is exact, so rows are
centred before anything is rounded. A pass gives the Gram matrix of the rows as the last pass left them, its Cholesky factor R is a
step towards orthogonal rows, and the rows of the next pass are those of this one times R's inverse, by a triangular solve. The first
pass adds a shift to the diagonal, so it can't break down whatever the rows' condition; later ones add it only where pivots vanish, that is
where dimensions depend on each other. Three passes leave rows orthogonal to rounding; the product of the factors then has the singular
values and right vectors of the centred rows, and so the covariance's components without ever squaring their condition.

Every pass reads the written fit list once and moves a d x d matrix a task, summed in groups of tasks. Only d x d matrices reach the driver.

Vectors that are null or empty or hold null or non-finite entries take no part. Of different lengths the most frequent among distinct
vectors is fitted, the smaller of two; others have no rows. Components whose deviation is below a 10**11th of the first one's are rounding and are left out, so fewer than
asked for come back where vectors depend on each other, and none, thus no rows, where all are equal or the table is empty. ``deviation`` is null where it
passes 64 bits. Repeated ids have rows each.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import Scratch, partitions

ROWS = 8192  # rows of a matrix
PASSES = 3
NOISE = 1e-11  # relative singular values below are not told from zero


def integers(column: str, scale: int, shift: int) -> Column:
    """Every entry times ``scale``, rounded down, plus ``shift``; null where a vector can't take part."""
    c = F.col(f"`{column}`")
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    whole = F.transform(c, lambda v: F.floor(v.cast("double") * scale).cast("long") + F.lit(shift).cast("long"))
    return F.when(c.isNotNull() & (F.size(c) > 0) & ~bad, whole)


@dataclass
class Whitening:
    n: int
    sums: np.ndarray         # per dimension, exact
    axes: np.ndarray         # a unit column for each component
    values: np.ndarray       # its eigenvalue of the covariance
    trace: float
    identity_error: float

    @property
    def width(self) -> int:
        return len(self.sums)


def _matrices(batches: Iterator[pa.RecordBatch], column: str, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            flat = part.column(part.schema.names.index(column)).flatten().to_numpy(zero_copy_only=False)
            yield part, flat.reshape(-1, width)


def _total(df: DataFrame, column: str, width: int, of: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum over all rows of ``of(matrix)``: one array a task, added up in groups of tasks, then on the driver."""
    dtype = np.dtype(np.int64 if kind == "long" else np.float64)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _matrices(batches, column, width):
            total = of(x) if total is None else total + of(x)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              "total": pa.array([total.ravel().tolist()], pa.list_(pa.from_numpy_dtype(dtype)))})

    def added(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        total = np.sum([np.array(v, dtype) for v in table["total"].to_pylist()], axis=0, dtype=dtype)
        return pa.table({"part": table["part"][:1], "total": pa.array([total.tolist()], pa.list_(pa.from_numpy_dtype(dtype)))})

    schema = f"part long, total array<{kind}>"
    groups = max(1, math.isqrt(partitions(df.sparkSession)))
    rows = (df.mapInArrow(partial, schema).groupBy(F.pmod("part", F.lit(groups)))
            .applyInArrow(added, schema).orderBy("part").collect())
    return np.sum([np.array(r["total"], dtype) for r in rows], axis=0, dtype=dtype)


def solve(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """q with q r = a, for upper triangular r, column by column."""
    q = np.empty_like(a)
    for j in range(a.shape[1]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def factor(gram: np.ndarray, shift: float, always: bool) -> tuple[np.ndarray, bool]:
    """The upper Cholesky factor, with the shift on the diagonal if asked for or needed, and whether it was."""
    if not always:
        try:
            r = np.linalg.cholesky(gram).T
            if np.diag(r).min() > math.sqrt(shift):
                return r, False
        except np.linalg.LinAlgError:
            pass
    return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T, True


def fit(vectors: DataFrame, scratch: Scratch, k: int) -> Whitening | None:
    """The first ``k`` whitening components of the distinct ``x`` of ``vectors``; None if there are none."""
    stored = scratch.keep(vectors.where("x IS NOT NULL").select("x").distinct(), "distinct-vectors")
    length = stored.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None:
        return None
    d, n = length["d"], length["count"]
    listed = stored.where(F.size("x") == d)
    sums = _total(listed, "x", d, lambda x: x.sum(axis=0), "long")

    def centred(x: np.ndarray) -> np.ndarray:
        return (n * x - sums) / n

    done, shifted = np.eye(d), False
    for i in range(PASSES):
        gram = _total(listed, "x", d, lambda x, r=done, first=not i: (lambda q: q.T @ q)(centred(x) if first else solve(centred(x), r)),
                      "double").reshape(d, d)
        size = float(np.trace(gram))
        if not i:
            trace = size / n
            if size == 0:
                return None
        step, again = factor(gram, 11 * (d * n + d * (d + 1)) * 2.0 ** -53 * size, always=not i)
        shifted |= again and i > 0
        done = step @ done
    last = done
    if shifted:  # dependent dimensions: the rows are orthogonal on what they span only, so their Gram matrix counts as well
        gram = _total(listed, "x", d, lambda x: (lambda q: q.T @ q)(solve(centred(x), done)), "double").reshape(d, d)
        value, vector = np.linalg.eigh(gram)
        last = (np.sqrt(np.maximum(value, 0))[:, None] * vector.T) @ done
    _, singular, right = np.linalg.svd(last)
    kept = int((singular > NOISE * singular[0]).sum())
    axes = right[:min(k, kept)].T
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    values = singular[:axes.shape[1]] ** 2 / n
    scale = axes / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ scale
        return np.vstack([w.sum(axis=0), w.T @ w])

    found = _total(listed, "x", d, moments, "double").reshape(-1, axes.shape[1]) / n
    error = float(np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(axes.shape[1])).max())
    scratch.drop("distinct-vectors")
    return Whitening(n, sums, axes, values, trace, error)


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Per row the exact sum of (n x - S)**2."""
    apart = [[n * int(v) - int(s) for v, s in zip(row, sums)] for row in x] if np.abs(x).max(initial=1) * n > 2 ** 62 else n * x - sums
    most = max((abs(int(v)) for v in (np.max(apart), np.min(apart))), default=0)
    if most ** 2 * x.shape[1] < 2 ** 63:
        apart = np.asarray(apart, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in apart]
    return [v if v < 2 ** 63 else None for v in exact]


def project(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` of every usable ``x`` of ``vectors(id, x)``."""
    kind = vectors.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    scale, k = model.axes / np.sqrt(model.values), len(model.values)
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches, "x", model.width):
            rows = len(x)
            whitened = ((model.n * x - model.sums) / model.n) @ scale
            at = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_pydict({
                "id": part.column(part.schema.names.index("id")).take(pa.array(at)), "component": pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                "n": np.full(rows * k, model.n), "deviation": pa.array(_deviation(x, model.n, model.sums), pa.int64()).take(pa.array(at)),
                "whitened": whitened.ravel(), "explained": np.tile(explained, rows), "identity_error": np.full(rows * k, model.identity_error)})

    return vectors.where(F.size("x") == model.width).select("id", "x").mapInArrow(run, schema)
