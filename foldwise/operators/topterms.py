"""The most frequent terms of a collection, without sending every term through a shuffle.

Most distinct n-grams are rare, and a count by term ships all of them. Here terms that are frequent in a sample of rows are counted exactly in
one pass, in which all others are counted by hashed slots. The ``top``-th of the exact counts bounds the answer from below, a slot bounds
each of its terms from above; a second pass counts exactly the terms of slots that reach the bound. The answer is exact whatever the sample;
a poor sample only leaves more slots. A task ships ``SLOTS`` rows at most, besides the candidates; slots that stay open go to the tasks as bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.scratch import fitted, written

SLOTS = 1 << 22
SAMPLE_ROWS = 10_000  # rows of the sample that candidates come from; up to as many, all rows are counted at once


def top_terms(df: DataFrame, by: str, counts: Callable[[DataFrame], DataFrame], top: int, min_df: int = 1, n_rows: int | None = None) -> DataFrame:
    """``(term, df, total)`` of the ``top`` terms by total, then by term, among those with ``df`` of ``min_df`` or more.

    ``counts`` turns rows of ``df`` into ``(term, tf, df)`` rows; ``df`` and ``total`` are the sums of ``df`` and ``tf``. ``by`` is the
    column whose hash draws the sample.
    """
    n = df.count() if n_rows is None else n_rows
    if n <= SAMPLE_ROWS:
        return _first(_exact(counts(df), min_df), top)
    drawn = df.where(F.pmod(F.xxhash64(F.lit("candidates"), by), F.lit(-(-n // SAMPLE_ROWS))) == 0)
    likely = fitted(_first(_exact(counts(drawn), 1), 2 * top).select("term")).withColumn("__likely", F.lit(True))

    marked = counts(df).join(likely, "term", "left")
    cells = written(marked.groupBy(F.when(F.col("__likely"), F.col("term")).alias("term"),
                                   F.when(F.col("__likely").isNull(), _slot()).alias("slot")).agg(*_figures()))
    exact = cells.where(F.col("term").isNotNull() & (F.col("df") >= min_df)).select("term", "df", "total")
    kept = _first(exact, top).agg(F.count(F.lit(1)), F.min("total")).first()
    floor = kept[1] if kept[0] == top else 0
    open_slots = cells.where(F.col("slot").isNotNull() & (F.col("df") >= min_df) & (F.col("total") >= floor))
    bits = open_slots.groupBy(F.shiftright("slot", 6).alias("__b")).agg(
        F.expr("bit_or(shiftleft(1L, slot & 63))").alias("__bits"))  # SLOTS / 64 rows
    rest = (counts(df).withColumn("__s", _slot()).join(F.broadcast(bits), F.shiftright("__s", 6) == F.col("__b"))
            .where(F.expr("shiftrightunsigned(__bits, __s & 63) & 1L = 1L")).join(likely, "term", "left_anti"))
    late = _exact(rest, min_df).where(F.col("total") >= floor)
    return _first(exact.unionByName(late), top)


def _slot() -> Column:
    return F.pmod(F.xxhash64("term"), F.lit(SLOTS)).cast("int")


def _figures() -> list[Column]:
    return [F.sum("df").alias("df"), F.sum("tf").alias("total")]


def _exact(rows: DataFrame, min_df: int) -> DataFrame:
    return rows.groupBy("term").agg(*_figures()).where(F.col("df") >= min_df)


def _first(totals: DataFrame, top: int) -> DataFrame:
    return totals.orderBy(F.col("total").desc(), "term").limit(top)
