"""Lookup joins that no frequent level can slow down.

A table of bounded size goes to every task. Beyond that, levels that very many rows share are found from counts: there can be only
a few of them, so their part of the table goes by broadcast and their rows stay where they are. The other rows meet the rest of
the table by shuffle, where no level has more than its small share. Rows without a level match nothing and are not shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.scratch import measured, written

HOT_SHARE = 4  # a level is frequent from a ``HOT_SHARE``-th of what a shuffle partition has on average


def level_join(df: DataFrame, table: DataFrame, on: Mapping[str, Column | str], how: str = "left") -> DataFrame:
    """``df`` with the columns of ``table`` where its columns ``on`` equal the given expressions of ``df``.

    Their combinations have to be unique in ``table``; ``how`` is left or inner. The key columns of ``table`` are not handed on.
    """
    names = list(on)
    small_table, small = measured(table)
    right = small_table.withColumnsRenamed({c: f"__t_{c}" for c in names})
    keyed = df.withColumns({f"__k_{c}": F.col(e) if isinstance(e, str) else e for c, e in on.items()})
    drop = [f"__{side}_{c}" for c in names for side in "kt"]

    def joined(rows: DataFrame, part: DataFrame) -> DataFrame:
        equal = F.lit(True)
        for c in names:
            equal = equal & (F.col(f"__k_{c}") == F.col(f"__t_{c}"))
        return rows.join(part, equal, how).drop(*drop)

    if small:
        return joined(keyed, right)
    hot = frequent(keyed, [f"__k_{c}" for c in names])
    flags = F.broadcast(hot.withColumnsRenamed({f"__k_{c}": f"__h_{c}" for c in names}).withColumn("__hot", F.lit(True)))
    same, unknown, hot_rows = F.lit(True), F.lit(False), F.lit(True)
    for c in names:
        same = same & (F.col(f"__k_{c}") == F.col(f"__h_{c}"))
        hot_rows = hot_rows & (F.col(f"__t_{c}") == F.col(f"__h_{c}"))
        unknown = unknown | F.col(f"__k_{c}").isNull()
    marked = keyed.join(flags, same, "left").withColumn("__stays", F.col("__hot").isNotNull() | unknown).drop(
        "__hot", *[f"__h_{c}" for c in names])
    hot_part = F.broadcast(right.join(flags, hot_rows, "left_semi"))
    stay = joined(marked.where("__stays").drop("__stays"), hot_part)
    return stay.unionByName(joined(marked.where("not __stays").drop("__stays"), right))


def frequent(df: DataFrame, keys: list[str]) -> DataFrame:
    """The combinations of ``keys`` that alone fill a good part of a shuffle partition; their number is bounded by that of the partitions."""
    counts = written(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")))
    rows = counts.agg(F.sum("__n")).first()[0] or 0
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return counts.where(F.col("__n") > rows / (parts * HOT_SHARE)).drop("__n")
