"""Exact top-k by inner product: ranges of vectors in blocks, visited by their best possible score.

Vectors are integers per dimension. Those of a range of ids are cut into blocks of neighbouring ids; a block keeps each dimension's
largest and smallest value and, as its forward index, its vectors. No vector of a block can score more with a query than the sum over
dimensions of the better of the two products. Blocks are visited in descending order of that bound until it falls below the k-th best
score that the query is known to reach. A first round visits the best block of each range and so gives every query a good k-th score;
the second round starts from it and rarely needs more.

Queries meet ranges in blocks: a block of queries and a range of vectors are one unit of work, which returns its k best of each query.
Vectors that are null, or hold null or non-finite components, take no part; shorter ones count as filled up with zeros.
Every row is a query or a candidate of its own, also where ids repeat: then an id may stand in a result more than once, and rows of the
query's id are no candidates. Rows without id take no part. Ties go to the smaller id.
Components are cut to 63 bits and scores to 64, within which they are exact. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm.common import Scratch, only

BLOCK, RANGE, QUERIES = 64, 8192, 512  # vectors of a block and a range, queries of a block
EXACT = float(1 << 53)  # sums below this are exact in double precision


def _packed(rows: int):
    """Consecutive rows of a partition, ``rows`` at a time, as ids and a matrix of 64-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, ids, vectors = TaskContext.get().partitionId(), 0, [], []

        def close():
            width = max(map(len, vectors))
            x = np.zeros((len(ids), width), np.int64)
            for i, v in enumerate(vectors):
                x[i, :len(v)] = v
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int64()), "block": pa.array([part << 32 | seq], pa.int64()),
                "ids": [np.array(ids, np.int64).tobytes()], "width": pa.array([width], pa.int64()), "data": [x.tobytes()]})

        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist()):
                ids.append(i)
                vectors.append(v)
                if len(ids) == rows:
                    yield close()
                    ids, vectors, seq = [], [], seq + 1
        if ids:
            yield close()
    return run


def _matrix(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["data"], np.int64).reshape(len(ids), row["width"])


def _products(q: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; ``exact`` tells that double precision holds every partial sum."""
    if exact:
        return (q @ x.T).astype(np.int64)
    full = q.astype(object) @ x.T.astype(object)
    return np.clip(full, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class _Best:
    """The k best of each query so far, by score and then smaller id, and the score a further one must reach."""

    def __init__(self, n: int, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.score, self.id = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
        self.have = np.zeros((n, k), bool)

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray, valid: np.ndarray) -> None:
        """Scores of queries ``q`` (rows) with ``ids`` (columns)."""
        score = np.concatenate([self.score[q], score], axis=1)
        ids = np.concatenate([self.id[q], np.broadcast_to(ids, (len(q), len(ids)))], axis=1)
        have = np.concatenate([self.have[q], valid], axis=1)
        rows = np.arange(len(q))[:, None]
        order = np.lexsort((ids, ~score, ~have))[:, :self.k]  # ~ turns the order around without overflow
        self.score[q], self.id[q], self.have[q] = score[rows, order], ids[rows, order], have[rows, order]
        full = q[self.have[q].all(1)]
        self.least[full] = np.maximum(self.least[full], self.score[full, self.k - 1])


def _visited(k: int, first_only: bool, q: np.ndarray, qid: np.ndarray, least: np.ndarray, x: np.ndarray, ids: np.ndarray) -> _Best:
    """A block of queries against a range of vectors."""
    width = max(q.shape[1], x.shape[1])
    q, x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, x))
    size = np.abs(q.astype(float)).max(initial=0) * np.abs(x.astype(float)).max(initial=0) * max(width, 1)
    exact = bool(size < EXACT)
    qf, xf = (q.astype(float), x.astype(float)) if exact else (q, x)
    starts = np.arange(0, len(ids), BLOCK)
    high, low = (f.reduceat(x, starts, axis=0).astype(float) for f in (np.maximum, np.minimum))
    bound = np.maximum(q, 0).astype(float) @ high.T + np.minimum(q, 0).astype(float) @ low.T
    bound += 0 if exact else size * 1e-9  # never below the true bound
    order = np.argsort(-bound, axis=1, kind="stable")
    best = _Best(len(qid), k, least)
    for turn in range(1 if first_only else len(starts)):
        block = order[:, turn]
        open_ = np.flatnonzero(bound[np.arange(len(qid)), block] >= best.least.astype(float))
        if not len(open_):
            break  # bounds fall from turn to turn, and k-th scores only rise
        for b in np.unique(block[open_]):
            rows, span = open_[block[open_] == b], slice(starts[b], starts[b] + BLOCK)
            best.add(rows, _products(qf[rows], xf[span], exact), ids[span], ids[span] != qid[rows][:, None])
    return best


def _searched(k: int, first_only: bool):
    schema = pa.schema([("block", pa.int64()), ("row", pa.int64()), ("query_id", pa.int64()),
                        ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(queries: pa.Table, ranges: pa.Table) -> pa.Table:
        out = [schema.empty_table()]
        ranges = [_matrix(r) for r in ranges.to_pylist()]
        for block in queries.to_pylist():
            qid, q = _matrix(block)
            least = np.full(len(qid), np.iinfo(np.int64).min)
            for known in block["least"] or []:
                least[known["row"]] = known["score"]
            for ids, x in ranges:
                best = _visited(k, first_only, q, qid, least, x, ids)
                row, place = np.nonzero(best.have)
                out.append(pa.table([np.full(len(row), block["block"]), row, qid[row], best.id[row, place],
                                     best.score[row, place]], schema=schema))
                least = best.least
        return pa.concat_tables(out)
    return run


def _ranked(found: DataFrame) -> DataFrame:
    best_first = Window.partitionBy("block", "row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best_first))


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of ``vectors(id, v)`` for each of ``queries(id, v)``, never a query's own id."""
    scratch = Scratch(vectors.sparkSession)

    def packed(df: DataFrame, rows: int, name: str) -> DataFrame:
        df = only(df, id="id", v="v").where("id is not null and v is not null and forall(v, x -> x is not null)")
        df = df.repartitionByRange(-(-df.count() // rows) or 1, "id").sortWithinPartitions("id", "v")
        return scratch.keep(df.mapInArrow(_packed(rows), "part long, block long, ids binary, width long, data binary"), name)

    ranges = packed(vectors, RANGE, "ranges").select("part", "ids", "width", "data")
    blocks = packed(queries, QUERIES, "queries").select("block", "ids", "width", "data")
    last = ranges.agg(F.max("part")).first()[0] or 0
    bunches = (blocks.agg(F.max("block")).first()[0] or 0) >> 32

    def search(blocks: DataFrame, first_only: bool) -> DataFrame:
        # bunches of queries and ranges make the units: each side is sent to every one of the other
        bunched = blocks.withColumn("bunch", F.shiftright("block", 32))
        met = bunched.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))))
        many = ranges.withColumn("bunch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bunches).cast("long"))))
        return met.groupBy("part", "bunch").cogroup(many.groupBy("part", "bunch")).applyInArrow(
            _searched(k, first_only), "block long, row long, query_id long, vec_id long, score long")

    first = _ranked(search(blocks.withColumn("least", F.lit(None).cast("array<struct<row:long,score:long>>")), True))
    known = first.where(F.col("rank") == k).groupBy("block").agg(F.collect_list(F.struct("row", "score")).alias("least"))
    blocks = scratch.keep(blocks.join(known, "block", "left"), "known")
    return _ranked(search(blocks, False)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def integers(vector: str, factor: float) -> Column:
    """floor(factor * x) of every component x; null for vectors that are null or hold null or non-finite components."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    top = F.lit(float(1 << 62))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.when(fine, F.transform(x, lambda c: F.floor(F.greatest(-top, F.least(top, c * factor)))))
