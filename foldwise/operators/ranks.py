"""Global ranks and running totals without one giant window partition.

Rows are cut into ordered buckets, bucket totals are cumulated (a tiny table)
and only the inside of each bucket is sorted by a window. The result does not
depend on the bucket edges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.scratch import fitted, written

BUCKET_ROWS = 250_000


def largest_group(df: DataFrame, by: Sequence[str]) -> int:
    """Rows of the largest group, from partial counts."""
    if not by:
        return df.count()
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    return sizes.agg(F.max("__n")).first()[0] or 0


def hash_order(id_col: str, seed: Column | int) -> Column:
    """Shuffle key of a row: depends on nothing but the seed and the id."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.md5(F.concat(seed.cast("string"), F.lit(":"), F.col(id_col).cast("string")))


def hash_rank(df: DataFrame, id_col: str, seed: Column | int, by: Sequence[str] = (),
              out: str = "rank", rows: int | None = None,
              bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """0-based position of each row in hash order, inside each ``by`` group.

    ``rows`` is the size of the largest group, counted here unless given.

    Hash prefixes are uniform, so they cut even one group that holds most rows
    into equal ordered buckets.
    """
    by = list(by)
    rows = largest_group(df, by) if rows is None else rows
    digits = max(0, math.ceil(math.log(max(rows, 1) / bucket_rows, 16)))
    keyed = df.withColumn("__h", hash_order(id_col, seed))
    if not digits:
        w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
        return (keyed.withColumn(out, F.row_number().over(w.orderBy("__h", id_col)).cast("long") - 1)
                .drop("__h"))
    keyed = keyed.withColumn("__b", F.substring("__h", 1, digits))
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    start = fitted(keyed.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__n"))
                   .withColumn("__start", F.sum("__n").over(w.orderBy("__b")) - F.col("__n"))
                   .drop("__n"))  # small: joined where the ranked rows lie
    inside = F.row_number().over(Window.partitionBy(*by, "__b").orderBy("__h", id_col))
    ranked = keyed.withColumn("__i", inside.cast("long") - 1)
    return (_join_null_safe(ranked, start, by + ["__b"])
            .withColumn(out, F.col("__start") + F.col("__i"))
            .drop("__h", "__b", "__i", "__start"))


def running_before(grouped: DataFrame, order: str, sums: Sequence[str], by: Sequence[str] = (),
                   bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add ``<c>_before``: the sum of ``c`` over rows with a smaller ``order``.

    ``grouped`` has one row per (by, order): group equal values first, so that
    no single value can be hot.
    """
    by = list(by)
    n = largest_group(grouped, by)
    if n <= bucket_rows:
        w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(order)
        return grouped.withColumns(
            {f"{c}_before": F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                       F.lit(0)) for c in sums})
    bucketed = _bucket(grouped, by, order, math.ceil(grouped.count() / bucket_rows))
    small = bucketed.groupBy(*by, "__b").agg(*[F.sum(c).alias(f"__{c}") for c in sums])
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("__b")
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    small = small.select(*by, "__b", *[F.coalesce(F.sum(f"__{c}").over(prior), F.lit(0))
                                       .alias(f"__{c}") for c in sums])
    inside = (Window.partitionBy(*by, "__b").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, -1))
    joined = _join_null_safe(
        bucketed.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(inside), F.lit(0))
                              for c in sums}), small, by + ["__b"])
    return (joined.withColumns({f"{c}_before": F.col(f"{c}_before") + F.col(f"__{c}") for c in sums})
            .drop("__b", *[f"__{c}" for c in sums]))


def average_rank(df: DataFrame, col: str, by: Sequence[str] = (), out: str = "rank",
                 bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per distinct value: its count and its 1-based average rank."""
    by = list(by)
    grouped = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    return running_before(grouped, col, ["n"], by, bucket_rows).select(
        *by, col, "n", (F.col("n_before") + (F.col("n") + 1) / F.lit(2.0)).alias(out))


def sorted_codes(values: DataFrame, col: str, out: str = "code") -> DataFrame:
    """0-based position of each distinct value in sorted order."""
    one = values.select(col).distinct().withColumn("__one", F.lit(1).cast("long"))
    return (running_before(one, col, ["__one"])
            .select(col, F.col("__one_before").cast("int").alias(out)))


def _bucket(df: DataFrame, by: Sequence[str], order: str, buckets: int) -> DataFrame:
    """``df`` with an ordered bucket number: its range partition by (group, value).

    The ranges are taken over groups and values together, so each group gets as many as its rows need, numbers and
    texts alike and without a limit. The numbers are written down: a range partitioning is not repeatable.
    """
    ranged = df.repartitionByRange(buckets, *by, order)
    return written(ranged.withColumn("__b", F.spark_partition_id()))


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on possibly null keys, keeping the left copy of them."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(renamed, on).drop(*[f"__r_{k}" for k in keys])
