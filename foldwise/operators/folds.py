"""Deterministic stratified folds and distribution-shift weights."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise import fixed
from foldwise.functions.rows import clip
from foldwise.operators.quantiles import exact_quantiles
from foldwise.operators.ranks import BUCKET_ROWS, hash_rank
from foldwise.scratch import fitted, written
from foldwise.sources.tables import repeated_ids


def quantile_edges(df: DataFrame, y: Column | str, bins: int) -> list[float]:
    """Distinct quantile edges; ties collapse edges, so there may be fewer bins."""
    y = F.col(y) if isinstance(y, str) else y
    found = exact_quantiles(df, {"y": (y, [i / bins for i in range(bins + 1)])})["y"]
    return sorted({e for e in found if e is not None})


def bin_of(y: str | Column, edges: Sequence[float]) -> Column:
    """Right-closed bin: the edges strictly below the value, the lowest edge included."""
    y = F.col(y) if isinstance(y, str) else y
    inner = list(edges)[1:-1] if len(edges) > 2 else []
    if not inner:
        return F.lit(0)
    return reduce(add, [(F.lit(e) < y).cast("int") for e in inner])


def with_bins(df: DataFrame, y: str, bins: int, out: str = "bin") -> DataFrame:
    return df.withColumn(out, bin_of(y, quantile_edges(df, y, bins)))


def assign(df: DataFrame, id_col: str, strata: Sequence[str], splits: int,
           seed: Column | int, by: Sequence[str] = (), out: str = "fold",
           rows: int | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Deal the hash-ordered rows of each stratum into folds in turn.

    Dealing goes on where the previous stratum stopped, so sizes differ by at
    most one inside every stratum and over the whole group.
    """
    by, strata = list(by), list(strata)
    ranked = hash_rank(df, id_col, seed, by + strata, "__rank", rows, bucket_rows)
    if not by and not strata:
        return ranked.withColumn(out, (F.col("__rank") % splits).cast("int")).drop("__rank")
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    sizes = df.groupBy(*by, *strata).agg(F.count(F.lit(1)).alias("__n"))  # one row per stratum
    start = fitted(sizes.withColumn("__start", F.sum("__n").over(w.orderBy(*strata)) - F.col("__n"))
                   .drop("__n"))
    renamed = start.withColumnsRenamed({c: f"__s_{c}" for c in by + strata})
    on = [F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in by + strata]
    return (ranked.join(renamed, on)
            .withColumn(out, ((F.col("__rank") + F.col("__start")) % splits).cast("int"))
            .drop("__rank", "__start", *[f"__s_{c}" for c in by + strata]))


def make_folds(df: DataFrame, id_col: str, y: str, splits: int = fixed.N_FOLDS,
               seed: int = fixed.SEED, bins: int | None = None, year: str | None = None,
               out: str = "fold") -> DataFrame:
    """Folds stratified by target quantile bin, crossed with year when given."""
    bins = bins or (fixed.TARGET_BINS_BY_YEAR if year else fixed.TARGET_BINS)
    binned = with_bins(df, y, bins, "__bin")
    strata = ["__bin"] + ([year] if year else [])
    return assign(binned, id_col, strata, splits, seed, out=out).drop("__bin")


def repeated_folds(df: DataFrame, id_col: str, y: str, seeds: Sequence[int] = fixed.REPEAT_SEEDS,
                   splits: int = fixed.N_FOLDS, year: str | None = None,
                   bins: int | None = None) -> DataFrame:
    """Long table ``(id, repeat, fold)``: one fold per row and seed."""
    bins = bins or (fixed.TARGET_BINS_BY_YEAR if year else fixed.TARGET_BINS)
    keep = [id_col, "__bin"] + ([year] if year else [])
    narrow = written(df.select(id_col, y, *([year] if year else [])))  # read several times
    binned = with_bins(narrow, y, bins, "__bin").select(*keep)
    pairs = F.array(*[F.struct(F.lit(r).alias("repeat"), F.lit(s).alias("__seed"))
                      for r, s in enumerate(seeds)])
    long = binned.select("*", F.explode(pairs).alias("__p")).select(*keep, "__p.*")
    strata = ["__bin"] + ([year] if year else [])
    return (assign(long, id_col, strata, splits, F.col("__seed"), by=["repeat"])
            .select(id_col, "repeat", "fold"))


def inner_folds(df: DataFrame, id_col: str, y: str, fold: str = "fold",
                splits: int = fixed.N_FOLDS, inner: int = fixed.INNER_SPLITS,
                seed: int = fixed.SEED, bins: int = fixed.TARGET_BINS, keep: Sequence[str] | None = None) -> DataFrame:
    """Every row once per outer fold: ``inner`` is its inner fold in the outer
    training part, and -1 where the row belongs to the outer validation part.

    Bins are those of each outer training part alone, so validation targets
    have no say in the inner folds. ``keep`` names the other columns to hand on
    (all unless given); without any, rows are joined to theirs only where ids repeat.
    """
    edges = exact_quantiles(df, {
        str(k): (F.when(F.col(fold) != k, F.col(y)), [i / bins for i in range(bins + 1)])
        for k in range(splits)})
    binned = reduce(
        lambda chain, k: chain.when(F.col("outer") == k, bin_of(
            y, sorted({e for e in edges[str(k)] if e is not None}))),
        range(splits), F.when(F.lit(False), F.lit(0)))
    narrow = df.select(id_col, y, fold)  # only what dealing needs is copied and shuffled
    long = narrow.select("*", F.explode(F.array(*[F.lit(k) for k in range(splits)])).alias("outer"))
    training = (long.where(F.col(fold) != F.col("outer")).withColumn("__bin", binned))
    dealt = assign(training, id_col, ["__bin"], inner,
                   F.lit(seed) + F.lit(fixed.INNER_SEED_STEP) * F.col("outer"),
                   by=["outer"], out="inner").drop("__bin")
    held = long.where(F.col(fold) == F.col("outer")).withColumn("inner", F.lit(-1))
    both = dealt.unionByName(held)
    rest = [c for c in df.columns if c not in (y, fold)] if keep is None else [id_col, *keep]
    if rest == [id_col] and (keep is None or repeated_ids(df, id_col).isEmpty()):
        return both
    return both.join(df.select(*rest), id_col)


def shares(df: DataFrame, col: str, out: str = "share") -> DataFrame:
    """Relative frequency of each non-null value."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
    total = df.select(F.count(col).alias("__n")).scalar()
    return counts.select(col, F.try_divide(F.col("__n").cast("double"), total).alias(out))


def year_mix(train: DataFrame, test: DataFrame, year: str) -> DataFrame:
    """Share of every year on both sides; null where a side lacks the year."""
    return shares(train, year, "train").join(shares(test, year, "test"), year, "full_outer")


def shift_ratios(train: DataFrame, test: DataFrame, year: str,
                 bounds: tuple[float, float] = fixed.WEIGHT_CLIP) -> DataFrame:
    """Clipped density ratio per training year; 1 where the test side lacks it."""
    mix = year_mix(train, test, year).where(F.col("train").isNotNull())
    ratio = F.coalesce(F.try_divide(F.col("test"), F.col("train")), F.lit(1.0))
    return mix.select(year, "train", clip(ratio, *bounds).alias("ratio"))


def year_weights(train: DataFrame, test: DataFrame, year: str,
                 bounds: tuple[float, float] = fixed.WEIGHT_CLIP, out: str = "w") -> DataFrame:
    """Training rows with a weight of mean 1 that follows the test side's year mix.

    The mean over rows is the share-weighted mean over years, so the rows are
    read once for the shares and once for the lookup.
    """
    ratios = fitted(shift_ratios(train, test, year, bounds))
    n_year, mean = ratios.agg(F.sum("train"), F.sum(F.col("train") * F.col("ratio"))).first()
    missing = train.where(F.col(year).isNull()).limit(1).count()
    if missing:  # rows without a year weigh 1 before scaling
        known, every = train.agg(F.count(year), F.count(F.lit(1))).first()
        mean = (mean or 0.0) * known / every + (every - known) / every
    lookup = ratios.select(F.col(year).alias("__y"), "ratio")
    return (train.join(lookup, F.col(year) == F.col("__y"), "left")
            .withColumn(out, F.coalesce("ratio", F.lit(1.0)) / F.lit(mean))
            .drop("__y", "ratio"))
