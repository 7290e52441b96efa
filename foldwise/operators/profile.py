"""Profiling tables: target, nulls, correlations, text lengths, outliers, scorecard.

Per-column tables come from one wide aggregate that is turned on its side, so
the number of columns does not multiply the number of scans.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from foldwise import fixed
from foldwise.functions.rows import pearson
from foldwise.operators.lookups import level_join
from foldwise.operators.quantiles import exact_quantiles
from foldwise.operators.ranks import BUCKET_ROWS, average_rank, running_before
from foldwise.scratch import fitted, written


def sideways(df: DataFrame, rows: Mapping[str, Mapping[str, Column]], name: str = "name") -> DataFrame:
    """One aggregate over ``df``; one output row per key of ``rows``."""
    first = next(iter(rows.values()))
    packed = [F.struct(*[e.alias(f) for f, e in cells.items()]).alias(f"c{i}")
              for i, cells in enumerate(rows.values())]
    listed = F.array(*[F.struct(F.lit(key).alias(name),
                                *[F.col(f"c{i}.{f}").alias(f) for f in first])
                       for i, key in enumerate(rows)])
    return df.agg(*packed).select(F.explode(listed).alias("r")).select("r.*")


# ------------------------------------------------------------------------ target
def target_profile(df: DataFrame, y: str, ceiling: float = fixed.CEILING) -> DataFrame:
    return df.agg(F.avg(y).alias("mean"), F.stddev_samp(y).alias("sd"), F.min(y).alias("min"),
                  F.max(y).alias("max"),
                  F.avg((F.col(y) >= ceiling).cast("int")).alias("at_ceiling"),
                  F.var_samp(y).alias("variance"))


def target_by(df: DataFrame, y: str, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"))


def histogram(df: DataFrame, y: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum; the maximum is in the last."""
    low, high = df.agg(F.min(y), F.max(y)).first()
    if low is None:
        return df.limit(0).select(F.lit(0).alias("bin"), F.lit(0.0).alias("low"), F.lit(0).alias("n"))
    width = (high - low) or 1.0
    at = F.floor((F.col(y) - low) / F.lit(width) * bins)
    return (df.where(F.col(y).isNotNull())
            .groupBy(F.least(at, F.lit(bins - 1)).cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("low", F.lit(low) + F.col("bin") * F.lit(width / bins)))


# ------------------------------------------------------------------------- nulls
def null_table(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols or df.columns)
    return sideways(df, {c: {"nulls": F.count(F.when(F.col(c).isNull(), 1)),
                             "rate": F.avg(F.col(c).isNull().cast("int"))} for c in cols})


def null_rates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return null_table(df, cols).where("rate > 0").select("name", "rate")


def informative_nulls(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    return sideways(df, {c: {"missing": F.avg(F.when(F.col(c).isNull(), F.col(y))),
                             "present": F.avg(F.when(F.col(c).isNotNull(), F.col(y)))}
                         for c in cols})


# ------------------------------------------------------------------ correlations
def correlations(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    from foldwise.operators.features import long_pairs
    long = long_pairs(df, {c: F.col(c) for c in cols}, F.col(y))
    return long.groupBy("name").agg(pearson("x", "y").alias("r"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r of every unordered pair of columns over the rows that have both; null when one side is constant.

    One matrix of products holds all sums: per column whether it is known, its centred value and the square of that.
    """
    k = len(cols)
    if k < 2:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    middle = df.agg(*[F.avg(F.col(c).cast("double")) for c in cols]).first()
    known = [F.col(c).isNotNull().cast("double") for c in cols]
    values = [F.coalesce(F.col(c).cast("double") - F.lit(m), F.lit(0.0)) for c, m in zip(cols, middle)]
    rows = df.select(array_to_vector(F.concat(F.array(*known), F.array(*values))).alias("v"))
    rows = rows.select(array_to_vector(F.concat(
        vector_to_array("v"), F.transform(F.slice(vector_to_array("v"), k + 1, k), lambda x: x * x))).alias("v"))
    sums = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "v")).computeGramianMatrix().toArray()
    m, x, q = slice(0, k), slice(k, 2 * k), slice(2 * k, 3 * k)
    n, s = np.maximum(sums[m, m], 1), sums[x, m]
    spread = sums[q, m] - s * s / n  # of the row's column, over the rows that have both
    spread[spread <= 1e-12 * sums[q, m]] = 0
    product = sums[x, x] - s * s.T / n
    scale = np.sqrt(spread * spread.T)
    rows = [(a, cols[j], float(product[i, j] / scale[i, j]) if scale[i, j] > 0 else None)
            for i, a in enumerate(cols) for j in range(i + 1, k)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def strongest_pairs(matrix: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most positive and the ``k`` most negative correlations, each side ranked."""
    up = Window.partitionBy("side").orderBy(F.abs("r").desc(), "a", "b")
    sides = matrix.where("r <> 0").withColumn("side", F.when(F.col("r") > 0, "positive").otherwise("negative"))
    return sides.withColumn("place", F.row_number().over(up)).where(F.col("place") <= k)


def spearman(df: DataFrame, cols: Sequence[str], y: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rank correlation with ``y`` per column, over the rows that have both.

    Approximate quantiles cut ``y`` and every column into buckets, a quantile being a bucket of its own, so that a value with very
    many rows needs no order. Counts by bucket say where ranks begin. Rows meet once by their bucket of ``y``, where all columns get
    the ranks of ``y``, and once, summed by value there, by the bucket of their column.
    """
    k, at = len(cols), [f"x{i}" for i in range(len(cols))]
    rows = written(df.select(*[F.col(c).cast("double").alias(a) for c, a in zip(cols, at)], F.col(y).cast("double").alias("y"))
                   .where(F.col("y").isNotNull()))  # read several times
    parts = -(-rows.count() // bucket_rows)
    edges = [np.zeros(0)] * (k + 1)
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        cuts = rows.agg(*[F.percentile_approx(a, shares, max(10_000, 8 * parts)) for a in [*at, "y"]]).first()
        edges = [np.unique(np.array(c or [], dtype=float)) + 0.0 for c in cuts]

    def known(table: pa.RecordBatch | pa.Table, i: int) -> tuple[np.ndarray, np.ndarray]:
        column = table.column(i)
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        return column.is_valid().to_numpy(zero_copy_only=False), column.fill_null(0.0).to_numpy(zero_copy_only=False) + 0.0

    def slots(values: np.ndarray, i: int) -> np.ndarray:
        return np.searchsorted(edges[i], values, "left") + np.searchsorted(edges[i], values, "right")  # odd: a quantile itself

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((2, 2 * max(len(edges[i]), len(edges[k])) + 1), dtype="int64") for i in range(k)]
        for batch in batches:
            own = slots(known(batch, k)[1], k)
            for i in range(k):
                have, x = known(batch, i)
                for side, found in enumerate((slots(x[have], i), own[have])):
                    sums[i][side] += np.bincount(found, minlength=sums[i].shape[1])
        for i, table in enumerate(sums):
            side, slot = np.nonzero(table)
            yield pa.RecordBatch.from_pydict({"c": pa.array(np.full(len(slot), i), pa.int32()), "side": pa.array(side, pa.int32()),
                                              "slot": pa.array(slot, pa.int32()), "n": pa.array(table[side, slot])})

    n = np.zeros((k, 2, 2 * max(map(len, edges)) + 1))
    for r in rows.mapInArrow(count, "c int, side int, slot int, n long").groupBy("c", "side", "slot").agg(F.sum("n").alias("n")).collect():
        n[r["c"], r["side"], r["slot"]] = r["n"]
    before = n.cumsum(axis=2) - n

    def ranks(values: np.ndarray) -> np.ndarray:
        _, of, m = np.unique(values, return_inverse=True, return_counts=True)
        return (m.cumsum() - m + (m + 1) / 2)[of]

    def by_value(table: pa.RecordBatch | pa.Table, rank_of: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i in range(k):
            have, x = known(table, i)
            if not have.any():
                continue
            rank = rank_of(i, have)
            value, of, m = np.unique(x[have], return_inverse=True, return_counts=True)
            size = len(value)
            yield pa.RecordBatch.from_pydict({  # slot -1: the squares of the ranks of y
                "c": pa.array(np.full(size + 1, i), pa.int32()), "slot": pa.array(np.r_[slots(value, i), -1], pa.int32()),
                "x": pa.array(np.r_[value, 0.0]), "m": pa.array(np.r_[m, len(rank)]),
                "s": pa.array(np.r_[np.bincount(of, rank, size), rank @ rank])})

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = slots(known(batch, k)[1], k)
            batch, slot = batch.filter(pa.array(slot % 2 == 1)), slot[slot % 2 == 1]
            yield from by_value(batch, lambda i, have, slot=slot: before[i, 1, slot[have]] + (n[i, 1, slot[have]] + 1) / 2)

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = slots(known(batch, k)[1], k)
            kept = slot % 2 == 0
            yield pa.RecordBatch.from_arrays([*batch.filter(pa.array(kept)).columns, pa.array(slot[kept], pa.int32())], [*at, "y", "slot"])

    def by_y(table: pa.Table) -> pa.Table:
        slot, target = table["slot"][0].as_py(), known(table, k)[1]
        return pa.Table.from_batches(list(by_value(table, lambda i, have: before[i, 1, slot] + ranks(target[have]))), schema=summed)

    def by_x(table: pa.Table) -> pa.Table:
        i, slot = table["c"][0].as_py(), table["slot"][0].as_py()
        x, m, s = (table[c].to_numpy() for c in ("x", "m", "s"))
        found = [0.0, 0.0, float(s.sum())]
        if slot >= 0:
            value, of = np.unique(x, return_inverse=True)
            m, s = np.bincount(of, m, len(value)), np.bincount(of, s, len(value))
            rank = before[i, 0, slot] + m.cumsum() - m + (m + 1) / 2
            found = [float(rank @ s), float(m @ (rank * rank)), 0.0]
        return pa.table({"c": pa.array([i], pa.int32()), "ab": [found[0]], "aa": [found[1]], "bb": [found[2]]})

    summed = pa.schema([("c", pa.int32()), ("slot", pa.int32()), ("x", pa.float64()), ("m", pa.int64()), ("s", pa.float64())])
    fields = "c int, slot int, x double, m long, s double"
    some = ", ".join(f"{a} double" for a in [*at, "y"])
    long = rows.mapInArrow(between, f"{some}, slot int").groupBy("slot").applyInArrow(by_y, fields)
    if len(edges[k]):
        long = long.unionByName(rows.mapInArrow(often, fields))
    parts_of = long.groupBy("c", "slot").applyInArrow(by_x, "c int, ab double, aa double, bb double")
    total = n[:, 0].sum(axis=1)  # ranks add up to the same on both sides, whatever is tied
    square = F.get(F.lit((total * (total + 1) ** 2 / 4).tolist()), F.col("c"))
    var = (F.sum("aa") - F.first(square)) * (F.sum("bb") - F.first(square))
    return parts_of.groupBy(F.get(F.lit(list(cols)), F.col("c")).alias("name")).agg(
        F.try_divide(F.sum("ab") - F.first(square), F.sqrt(var)).alias("rho"))


def fractional_ranks(df: DataFrame, id_col: str, col: str, out: str) -> DataFrame:
    """Average rank divided by the number of ranked rows."""
    n = df.select(F.count(col).alias("n")).scalar()
    ranks = average_rank(df, col).select(F.col(col).alias("__v"), F.col("rank").alias("__rank"))
    return (level_join(df.select(id_col, F.col(col).alias("__value")), ranks, {"__v": "__value"})
            .select(id_col, F.try_divide(F.col("__rank"), n).alias(out)))


# -------------------------------------------------------------- per-column tables
def overview(df: DataFrame, text: Sequence[str] = (), target: str | None = None) -> DataFrame:
    """Column, type, role and number of known values; row and column counts beside them."""
    def role(f):
        if f.name == target:
            return "target"
        if f.name in text:
            return "text"
        return "numeric" if isinstance(f.dataType, NumericType) else "categorical"
    fields = {f.name: f for f in df.schema}
    return sideways(df, {c: {
        "type": F.first(F.lit(fields[c].dataType.simpleString())), "role": F.first(F.lit(role(fields[c]))),
        "known": F.count(c), "n_rows": F.count(F.lit(1)),
        "n_columns": F.first(F.lit(len(df.columns)))} for c in df.columns})


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """How many rows repeat an earlier one, and their share."""
    groups = df.groupBy(*(cols or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.sum(F.col("n") - 1).alias("duplicates"),
                      F.try_divide(F.sum(F.col("n") - 1).cast("double"), F.sum("n")).alias("ratio"))


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule; a row where a rule is unknown does not break it."""
    return sideways(df, {name: {"violations": F.sum(F.coalesce(broken.cast("long"), F.lit(0)))}
                         for name, broken in rules.items()}, "rule")


def applicant_rules(year: str = "application_year") -> dict[str, Column]:
    c = F.col
    negatives = [c(n) < 0 for n in ("cgpa", "attendance_rate", "failed_courses_count",
                                    "applications_sent", "interviews_attended",
                                    "github_repo_count", "internship_count")]
    negative = negatives[0]
    for n in negatives[1:]:
        negative = negative | n
    return {"graduation_after_application": c("graduation_year") > c(year),
            "attendance_over_100": c("attendance_rate") > 100,
            "cgpa_out_of_range": (c("cgpa") < 0) | (c("cgpa") > 4),
            "interviews_over_applications": c("interviews_attended") > c("applications_sent"),
            "awards_over_hackathons": c("hackathon_awards") > c("hackathon_count"),
            "negative_value": negative}


def univariate(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Moments in one pass over (column, value) rows, exact quartiles beside them."""
    quartiles = exact_quantiles(df, {c: (F.col(c), [0.25, 0.5, 0.75]) for c in cols})
    cuts = df.sparkSession.createDataFrame([(c, *quartiles[c]) for c in cols], "__c string, q1 double, median double, q3 double")
    x = F.col("x")
    moments = _long(df, cols).groupBy("name").agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
        F.max(x).alias("max"), F.skewness(x).alias("skewness"), F.kurtosis(x).alias("kurtosis"))
    return moments.join(F.broadcast(cuts), F.col("name") == F.col("__c")).select(
        "name", "n", "mean", "median", "std", "min", "max", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
        "skewness", "kurtosis")


def _long(df: DataFrame, cols: Sequence[str], y: str | None = None) -> DataFrame:
    from foldwise.operators.features import long_pairs
    return long_pairs(df, {c: F.col(c) for c in cols}, F.col(y) if y else F.lit(None))


def category_shares(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Frequency and share of every level of several columns in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("level"))
                                for c in cols]))
    counts = (df.select(pairs.alias("p")).select("p.*").where(F.col("level").isNotNull())
              .groupBy("name", "level").agg(F.count(F.lit(1)).alias("n")))
    totals = fitted(counts.groupBy("name").agg(F.sum("n").alias("__t"),
                                               F.count(F.lit(1)).alias("n_levels")))
    return counts.join(totals, "name").select("name", "level", "n",
                                              (F.col("n") / F.col("__t")).alias("share"), "n_levels")


def target_by_category(df: DataFrame, col: str, y: str) -> DataFrame:
    """Mean and exact median of the target per level, for any number of levels.

    Equal targets are counted per level first; the median is then read off the
    running counts, so a level that holds most rows crowds no task.
    """
    counts = (df.where(F.col(y).isNotNull()).groupBy(col, F.col(y).cast("double").alias("__y"))
              .agg(F.count(F.lit(1)).alias("__c")))
    totals = counts.groupBy(col).agg(F.sum("__c").alias("n"),
                                     (F.sum(F.col("__y") * F.col("__c")) / F.sum("__c")).alias("mean"))
    named = totals.withColumnRenamed(col, "__k")
    ranked = running_before(counts, "__y", ["__c"], [col])
    both = ranked.join(named, F.col(col).eqNullSafe(F.col("__k")))
    covers = lambda at: (at >= F.col("__c_before")) & (at < F.col("__c_before") + F.col("__c"))
    low, high = F.floor((F.col("n") - 1) / 2), F.ceil((F.col("n") - 1) / 2)
    return both.groupBy(col).agg(
        F.first("n").alias("n"), F.first("mean").alias("mean"),
        ((F.max(F.when(covers(low), F.col("__y"))) + F.max(F.when(covers(high), F.col("__y")))) / 2)
        .alias("median"))


def outliers(df: DataFrame, cols: Sequence[str], y: str | None = None) -> DataFrame:
    """Counts outside 1.5 IQR and beyond 3 deviations, per column."""
    quartiles = exact_quantiles(df, {c: (F.col(c), [0.25, 0.75]) for c in cols})
    long = _long(df, cols, y)
    moments = {r["name"]: r for r in long.groupBy("name").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd")).collect()}
    limits = []
    for c in cols:
        (q1, q3), r = quartiles[c], moments.get(c)
        reach = None if q1 is None else 1.5 * (q3 - q1)
        limits.append((c, None if q1 is None else q1 - reach, None if q1 is None else q3 + reach,
                       r and r["mean"], r and r["sd"]))
    limits = df.sparkSession.createDataFrame(limits, "__c string, low double, high double, mean double, sd double")
    x = F.col("x")
    by_iqr = (x < F.col("low")) | (x > F.col("high"))
    by_z = F.abs(x - F.col("mean")) > 3 * F.col("sd")
    share = lambda hit: F.try_divide(F.count(F.when(hit, 1)).cast("double"), F.count(x))
    found = [F.count(F.when(by_iqr, 1)).alias("iqr_count"), F.count(F.when(by_z, 1)).alias("z_count"),
             share(by_iqr).alias("iqr_ratio"), share(by_z).alias("z_ratio")]
    if y is not None:
        found.append(F.avg(F.when(by_iqr, F.col("y"))).alias("outlier_target_mean"))
    return long.join(F.broadcast(limits), F.col("name") == F.col("__c")).groupBy("name").agg(*found)


def inflation_factors(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """VIF per column: the diagonal of the inverse correlation matrix.

    Rows with a null in any column are left out. Only the column-by-column
    correlations reach the driver.
    """
    whole = df.dropna(subset=list(cols))
    found = {(r["a"], r["b"]): r["r"] for r in correlation_matrix(whole, cols).collect()}
    m = np.eye(len(cols))
    for i, a in enumerate(cols):
        for j in range(i + 1, len(cols)):
            m[i, j] = m[j, i] = found[(a, cols[j])] if found[(a, cols[j])] is not None else 0.0
    diagonal = np.diag(np.linalg.pinv(m, hermitian=True))
    if np.linalg.matrix_rank(m) == len(cols):
        diagonal = np.diag(np.linalg.inv(m))
    rows = [(c, float(v), bool(v > 5), bool(v > 10)) for c, v in zip(cols, diagonal)]
    return df.sparkSession.createDataFrame(rows, "name string, vif double, over_5 boolean, over_10 boolean")


def mutual_information(df: DataFrame, cols: Sequence[str], y: str, bins: int = 10) -> DataFrame:
    """Plug-in mutual information (nats) of quantile-binned columns and target.

    A null is a bin of its own: missingness carries information too. Rows are
    binned and counted where they lie, a table of bins by bins for each column.
    """
    probs = [i / bins for i in range(bins + 1)]
    edges = {c: sorted({e for e in found if e is not None})
             for c, found in exact_quantiles(df, {c: (F.col(c), probs) for c in [*cols, y]}).items()}
    inner = {c: np.array(e[1:-1] if len(e) > 2 else [], dtype=float) for c, e in edges.items()}
    names, width = list(cols), bins + 1  # bin -1 is the nulls'

    def binned(values: pa.Array, c: str) -> np.ndarray:
        at = np.searchsorted(inner[c], values.to_numpy(zero_copy_only=False), side="left")
        return np.where(values.is_null().to_numpy(zero_copy_only=False), -1, at) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(names), width, width), dtype="int64")
        for batch in batches:
            by = binned(batch.column(0), y)
            for i, c in enumerate(names):
                n[i] += np.bincount(binned(batch.column(i + 1), c) * width + by, minlength=width * width).reshape(width, width)
        i, bx, by = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([names[j] for j in i], pa.string()), pa.array(bx.astype("int32") - 1),
                                          pa.array(by.astype("int32") - 1), pa.array(n[i, bx, by])], ["name", "bx", "by", "n"])

    doubles = df.select(F.col(y).cast("double").alias("y"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    cells = (doubles.mapInArrow(count, "name string, bx int, by int, n long")
             .groupBy("name", "bx", "by").agg(F.sum("n").cast("double").alias("n")))
    total = F.sum("n").over(Window.partitionBy("name"))
    nx = F.sum("n").over(Window.partitionBy("name", "bx"))
    ny = F.sum("n").over(Window.partitionBy("name", "by"))
    part = F.col("n") / total * F.log(F.col("n") * total / (nx * ny))
    return cells.select("name", part.alias("part")).groupBy("name").agg(F.sum("part").alias("mi"))


def text_lengths(df: DataFrame, text: str) -> DataFrame:
    length = F.char_length(F.coalesce(text, F.lit("")))
    p95 = exact_quantiles(df, {"n": (length, [0.95])})["n"][0]
    return df.agg(F.avg(length).alias("mean"), F.first(F.lit(p95)).alias("p95"))


def scorecard(nulls: DataFrame, correlation: DataFrame, information: DataFrame,
              importances: Mapping[str, DataFrame], types: DataFrame) -> DataFrame:
    """All measures of a feature on one row; the tables have one row per column."""
    out = (types.select("name", "type").join(nulls.select("name", "rate"), "name", "left")
           .join(correlation, "name", "left").join(information, "name", "left"))
    for label, table in importances.items():
        out = out.join(table.select(F.col("feature").alias("name"),
                                    F.col("importance").alias(label)), "name", "left")
    return out


def actual_against_predicted(oof: DataFrame, y: str = "y", pred: str = "pred", width: float = 5.0,
                             by: Sequence[str] = ()) -> DataFrame:
    """Chart data: per cell of the actual target the rows, and mean and deviation of what was predicted."""
    cell = F.floor(F.col(y) / F.lit(width)).cast("int").alias("cell")
    return oof.groupBy(*by, cell).agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean_actual"),
                                      F.avg(pred).alias("mean_pred"), F.stddev_samp(pred).alias("sd_pred"))
