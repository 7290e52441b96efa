"""Category statistics: dictionaries, frequencies, group and target means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise import fixed
from foldwise.functions.rows import level
from foldwise.operators.lookups import level_join
from foldwise.operators.ranks import sorted_codes


def dictionary(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values with 0-based codes; null is a level of its own."""
    return sorted_codes(df.select(level(col, fixed.NULL_LEVEL).alias(col)), col)


def group_means(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(*[F.avg(v).alias(v) for v in values]))


def lookup(df: DataFrame, table: DataFrame, col: str, key: str | None = None,
           how: str = "left", null_level: str | None = None) -> DataFrame:
    """Left lookup join of a fitted table on ``col``; unseen values give null."""
    key = key or col
    left = level(col, null_level) if null_level is not None else F.col(col)
    right = table.withColumnRenamed(key, "__key")
    return df.join(right, left == F.col("__key"), how).drop("__key")


def smoothed_means(df: DataFrame, col: str, y: str,
                   smoothing: float = fixed.TE_SMOOTHING) -> DataFrame:
    """Target mean per category, pulled to the overall mean."""
    cells = df.groupBy(level(col, fixed.NULL_LEVEL).alias(col)).agg(
        F.sum(y).alias("s"), F.count(y).alias("n"))
    prior = df.select(F.avg(y).alias("prior")).scalar()
    return cells.select(col, _smooth(F.col("s"), F.col("n"), prior, smoothing).alias("te"))


def smoothed_lookup(fit: DataFrame, df: DataFrame, col: str, y: str, out: str | None = None,
                    smoothing: float = fixed.TE_SMOOTHING) -> DataFrame:
    """Encode ``df`` by the means of ``fit``; unseen categories get the mean."""
    out = out or f"te_{col}"
    prior = fit.agg(F.avg(y)).first()[0]
    table = smoothed_means(fit, col, y, smoothing).withColumnRenamed(col, "__key")
    return (level_join(df, table, {"__key": level(col, fixed.NULL_LEVEL)})
            .withColumn(out, F.coalesce("te", F.lit(prior))).drop("te"))


def nested_means(nested: DataFrame, id_col: str, col: str, y: str, outer: str = "outer",
                 inner: str = "inner", smoothing: float = fixed.TE_SMOOTHING,
                 out: str = "value") -> DataFrame:
    """Leak-free target means for every outer fold, without refits.

    ``nested`` comes from :func:`foldwise.operators.folds.inner_folds`. What a
    row may be encoded by is a total minus the cell the row is in: the sums per
    (outer, inner, category) are built once, and leaving a fold out is a
    subtraction. Validation rows (inner -1) use the whole training part.
    """
    key = level(col, fixed.NULL_LEVEL)
    cells = nested.groupBy(outer, inner, key.alias("__cat")).agg(
        F.sum(y).alias("s"), F.count(y).alias("n"))
    training = F.col(inner) >= 0
    by_cat = Window.partitionBy(outer, "__cat")
    left = cells.select(
        outer, inner, "__cat",
        _left_out("s", training, by_cat).alias("s"), _left_out("n", training, by_cat).alias("n"))
    folds = cells.groupBy(outer, inner).agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    by_outer = Window.partitionBy(outer)
    priors = folds.select(
        F.col(outer).alias("__o"), F.col(inner).alias("__i"),
        F.try_divide(_left_out("s", training, by_outer), _left_out("n", training, by_outer))
        .alias("__prior"))
    encoded = (
        left.join(priors, (F.col(outer) == F.col("__o")) & (F.col(inner) == F.col("__i")))
        .select(F.col(outer).alias("__o"), F.col(inner).alias("__i"), "__cat",
                _smooth(F.col("s"), F.col("n"), F.col("__prior"), smoothing).alias(out)))
    rows = nested.select(id_col, outer, inner, key.alias("__c"))
    return level_join(rows, encoded, {"__o": outer, "__i": inner, "__cat": "__c"}, "inner").select(id_col, outer, out)


def left_out_means(df: DataFrame, key: str | None, y: str, fold: str, by: Sequence[str] = (),
                   out: str = "pred") -> DataFrame:
    """Mean of ``y`` over the rows of the same key in the other folds.

    A plain out-of-fold predictor; the means are totals minus the fold's cell.
    """
    by = list(by)
    label = level(key, fixed.NULL_LEVEL) if key else F.lit("")
    cells = df.groupBy(*by, fold, label.alias("__k")).agg(
        F.sum(y).alias("s"), F.count(y).alias("n"))
    w = Window.partitionBy(*by, "__k")
    means = cells.select(
        *[F.col(c).alias(f"__{c}") for c in [*by, fold]], F.col("__k").alias("__level"),
        F.try_divide(F.sum("s").over(w) - F.col("s"), F.sum("n").over(w) - F.col("n")).alias(out))
    return level_join(df, means, {**{f"__{c}": c for c in [*by, fold]}, "__level": label}, "inner")


def _smooth(total: Column, count: Column, prior: Column, smoothing: float) -> Column:
    return (total + prior * F.lit(smoothing)) / (count + F.lit(smoothing))


def _left_out(c: str, training: Column, w) -> Column:
    own = F.when(training, F.col(c)).otherwise(F.lit(0))
    return F.coalesce(F.sum(F.when(training, F.col(c))).over(w), F.lit(0)) - own
