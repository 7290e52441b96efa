"""Combining predictions, and an honest choice between the ways to do it.

Blends and linear stacks need only second-moment sums of predictions and
target. Those are summed once per fold cell; the training part of any fold is
the total minus its cell, and a held-out error is a quadratic form of the
cell's own sums. The whole referee thus reads the rows once for the sums and
once for the leave-one-out choice of the ridge penalty.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise import fixed
from foldwise.operators.cross import run_all
from foldwise.operators.folds import make_folds, repeated_folds
from foldwise.operators.metrics import weighted_mse
from foldwise.scratch import written

ALPHAS = tuple(np.logspace(*fixed.RIDGE_STACK_ALPHAS))
EPS = 1e-9


# ---------------------------------------------------------------- moment sums
@dataclass
class Moments:
    """Weighted sums of z, y and their products, and plain sums of z and z squared."""

    names: tuple[str, ...]
    n: float
    w: float
    wz: np.ndarray
    wzz: np.ndarray
    wzy: np.ndarray
    wy: float
    wyy: float
    z: np.ndarray
    zz: np.ndarray

    def _with(self, other: "Moments", sign: float) -> "Moments":
        parts = [getattr(self, f) + sign * getattr(other, f)
                 for f in ("n", "w", "wz", "wzz", "wzy", "wy", "wyy", "z", "zz")]
        return Moments(self.names, *parts)

    def __add__(self, other):
        return self._with(other, 1.0)

    def __sub__(self, other):
        return self._with(other, -1.0)

    def mse(self, coef: np.ndarray, intercept: float = 0.0) -> float:
        """Weighted squared error of ``intercept + coef . z`` over these rows."""
        total = (self.wyy + coef @ self.wzz @ coef + intercept ** 2 * self.w
                 - 2 * coef @ self.wzy - 2 * intercept * self.wy + 2 * intercept * coef @ self.wz)
        return float(total / self.w)

    def part(self, keep: Sequence[int]) -> "Moments":
        k = list(keep)
        return Moments(tuple(self.names[i] for i in k), self.n, self.w, self.wz[k],
                       self.wzz[np.ix_(k, k)], self.wzy[k], self.wy, self.wyy, self.z[k], self.zz[k])


def moments(df: DataFrame, names: Sequence[str], y: str, w: str | None = None,
            by: Sequence[str] = ()) -> dict[tuple, Moments]:
    """Sums per group in one aggregation; a handful of numbers reaches the driver."""
    weight = F.col(w).cast("double") if w else F.lit(1.0)
    m = len(names)
    pairs = [(i, j) for i in range(m) for j in range(i, m)]
    c = [F.col(n).cast("double") for n in names]
    target = F.col(y).cast("double")
    aggs = [F.count(F.lit(1)).cast("double"), F.sum(weight), F.sum(weight * target),
            F.sum(weight * target * target)]
    aggs += [F.sum(weight * v) for v in c] + [F.sum(weight * v * target) for v in c]
    aggs += [F.sum(v) for v in c] + [F.sum(v * v) for v in c]
    aggs += [F.sum(weight * c[i] * c[j]) for i, j in pairs]
    named = [a.alias(f"a{i}") for i, a in enumerate(aggs)]
    out = {}
    for row in (df.groupBy(*by).agg(*named) if by else df.agg(*named)).collect():
        v = [row[f"a{i}"] for i in range(len(aggs))]
        block = lambda k: np.array(v[4 + k * m:4 + (k + 1) * m], dtype=float)
        wzz = np.zeros((m, m))
        for (i, j), x in zip(pairs, v[4 + 4 * m:]):
            wzz[i, j] = wzz[j, i] = x
        out[tuple(row[b] for b in by)] = Moments(
            tuple(names), v[0], v[1], block(0), wzz, block(1), v[2], v[3], block(2), block(3))
    return out


# ------------------------------------------------------------------- combiners
@dataclass
class Linear:
    """A weighted sum of columns."""

    names: Sequence[str]
    coef: Sequence[float]
    intercept: float = 0.0
    kind: str = "linear"
    details: dict = field(default_factory=dict)

    def column(self) -> Column:
        out = F.lit(float(self.intercept))
        for n, c in zip(self.names, self.coef):
            out = out + F.lit(float(c)) * F.col(n).cast("double")
        return out

    def predict(self, df: DataFrame, out: str = "pred") -> DataFrame:
        return df.withColumn(out, self.column())


@dataclass
class Boosted:
    names: Sequence[str]
    model: Any
    kind: str = "boosted"

    def predict(self, df: DataFrame, out: str = "pred") -> DataFrame:
        made = df.withColumn("__f", _vector(self.names))
        return self.model.transform(made).withColumn(out, F.col("__p")).drop("__f", "__p")


def _vector(names):
    return array_to_vector(F.array(*[F.col(n).cast("double") for n in names]))


def equal_blend(names: Sequence[str]) -> Linear:
    return Linear(names, [1.0 / len(names)] * len(names), kind="blend_equal")


def single(name: str) -> Linear:
    return Linear([name], [1.0], kind=f"single_{name}")


def convex_weights(m: Moments) -> np.ndarray:
    """Weights >= 0 that sum to 1 with the least weighted squared error.

    Exact active-set search: solve on the free set, step back to the boundary
    when a weight turns negative, free a column whose gradient says so.
    """
    g, b = m.wzz / m.w, m.wzy / m.w
    k = len(b)
    g = g + np.eye(k) * 1e-12 * max(np.trace(g) / k, 1e-300)
    start = int(np.argmin(np.diag(g) - 2 * b))
    x = np.zeros(k)
    x[start] = 1.0
    free = [start]
    for _ in range(50 * k + 50):
        n = len(free)
        kkt = np.zeros((n + 1, n + 1))
        kkt[:n, :n], kkt[:n, n], kkt[n, :n] = g[np.ix_(free, free)], 1.0, 1.0
        best = np.linalg.lstsq(kkt, np.r_[b[free], 1.0], rcond=None)[0][:n]
        now = x[free]
        if (best >= -1e-15).all():
            x[free] = np.maximum(best, 0.0)
            gradient = g @ x - b
            level = gradient[free].mean()
            gain = level - gradient
            gain[free] = 0.0
            worst = int(np.argmax(gain))
            if gain[worst] <= 1e-12 * max(1.0, np.abs(gradient).max()):
                break
            free.append(worst)
        else:
            falling = best < now
            step = min(1.0, *[now[i] / (now[i] - best[i]) for i in range(n)
                              if falling[i] and best[i] < 0])
            x[free] = now + step * (best - now)
            drop = [f for f in free if x[f] <= 1e-14]
            x[drop] = 0.0
            free = [f for f in free if f not in drop] or [int(np.argmax(x))]
    return x / x.sum()


def convex_blend(m: Moments) -> Linear:
    return Linear(m.names, convex_weights(m).tolist(), kind="blend_optimized")


@dataclass
class _Basis:
    """Standardised, weighted-centred coordinates in which every penalty is diagonal."""

    shift: np.ndarray
    scale: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    target: np.ndarray
    mean_y: float
    w: float

    def linear(self, names, alpha: float) -> Linear:
        beta = self.vectors @ (self.target / (self.values + alpha))
        coef = beta / self.scale
        return Linear(names, coef.tolist(), float(self.mean_y - coef @ self.shift),
                      kind="stack_ridge", details={"alpha": float(alpha)})


def _basis(m: Moments) -> _Basis:
    mean = m.z / m.n
    scale = np.sqrt(np.maximum(m.zz / m.n - mean ** 2, 0.0)) + EPS
    centre, mean_y = m.wz / m.w, m.wy / m.w
    cov = (m.wzz - m.w * np.outer(centre, centre)) / np.outer(scale, scale)
    cross = (m.wzy - m.w * centre * mean_y) / scale
    values, vectors = np.linalg.eigh(cov)
    return _Basis(centre, scale, np.maximum(values, 0.0), vectors, vectors.T @ cross, mean_y, m.w)


def _loo_sums(b: _Basis, z: np.ndarray, y: np.ndarray, w: np.ndarray, alphas: np.ndarray) -> np.ndarray:
    """Weighted squared leave-one-out errors of a batch, summed, for every penalty."""
    u = ((z - b.shift) / b.scale) @ b.vectors
    inverse = 1.0 / (b.values[:, None] + alphas[None, :])
    fitted = b.mean_y + u @ (b.target[:, None] * inverse)
    leverage = w[:, None] * (1.0 / b.w + (u * u) @ inverse)
    gap = (y[:, None] - fitted) / (1.0 - leverage)
    return (w[:, None] * gap * gap).sum(axis=0)


def ridge_alphas(df: DataFrame, train: Mapping[tuple, Moments], y: str, w: str | None,
                 fold_columns: Sequence[str] = (), alphas: Sequence[float] = ALPHAS) -> dict[tuple, float]:
    """Best penalty per training part by exact leave-one-out, in one pass.

    ``train`` maps ``(column position, fold)`` to the moments of the rows whose
    fold in that column differs; the key ``()`` stands for all rows.
    """
    names = next(iter(train.values())).names
    grid = np.asarray(alphas)
    bases = {k: _basis(m) for k, m in train.items()}
    keys = list(bases)
    sums, cols = _loo_sums, list(names)
    weight = F.col(w).cast("double") if w else F.lit(1.0)

    def batch(frames):
        for pdf in frames:
            z, yy, ww = pdf[cols].to_numpy(float), pdf["__y"].to_numpy(float), pdf["__w"].to_numpy(float)
            for i, key in enumerate(keys):
                rows = np.ones(len(pdf), bool) if not key else \
                    pdf[f"__f{key[0]}"].to_numpy() != key[1]
                if rows.any():
                    got = sums(bases[key], z[rows], yy[rows], ww[rows], grid)
                    yield pd.DataFrame({"key": np.int32(i), "a": np.arange(len(grid), dtype="int32"),
                                        "s": got})

    sent = df.select(*[F.col(n).cast("double").alias(n) for n in names],
                     F.col(y).cast("double").alias("__y"), weight.alias("__w"),
                     *[F.col(c).alias(f"__f{i}") for i, c in enumerate(fold_columns)])
    totals = (sent.mapInPandas(batch, "key int, a int, s double").groupBy("key", "a")
              .agg(F.sum("s").alias("s")).collect())
    table = np.full((len(keys), len(grid)), np.inf)
    for r in totals:
        table[r["key"], r["a"]] = r["s"]
    return {k: float(grid[table[i].argmin()]) for i, k in enumerate(keys)}


def ridge_stack(df: DataFrame, names: Sequence[str], y: str, w: str | None = None) -> Linear:
    m = moments(df, names, y, w)[()]
    alpha = ridge_alphas(df, {(): m}, y, w)[()]
    return _basis(m).linear(names, alpha)


def boosted_stack(df: DataFrame, names: Sequence[str], y: str, w: str | None = None,
                  rounds: int = 500, step: float = 0.04, seed: int = fixed.SEED) -> Boosted:
    """Shallow trees on the predictions: trust a model in some regimes only."""
    est = GBTRegressor(featuresCol="__f", labelCol=y, predictionCol="__p", maxDepth=2,
                       maxIter=rounds, stepSize=step, seed=seed,
                       minInstancesPerNode=10)
    made = df.select(F.col(y).cast("double").alias(y), _vector(names).alias("__f"),
                     *([F.col(w)] if w else []))
    return Boosted(list(names), (est.setWeightCol(w) if w else est).fit(made))


#: Combiners by name: ``(rows, model columns, extra columns, target, weight, rounds) -> a combiner``. Add your own here.
COMBINERS: dict[str, Callable] = {
    "blend_equal": lambda df, names, extra, y, w, rounds: equal_blend(names),
    "blend_optimized": lambda df, names, extra, y, w, rounds: convex_blend(moments(df, names, y, w)[()]),
    "stack_ridge": lambda df, names, extra, y, w, rounds: ridge_stack(df, [*names, *extra], y, w),
    "stack_boosted": lambda df, names, extra, y, w, rounds: boosted_stack(df, [*names, *extra], y, w, rounds),
}


def fit_combiner(method: str, df: DataFrame, names: Sequence[str], y: str, w: str | None = None,
                 extra: Sequence[str] = (), rounds: int = 500) -> Linear | Boosted:
    """Fit the named combiner on all rows; ``single_<model>`` stands for that model alone."""
    if method.startswith("single_"):
        return single(method.removeprefix("single_"))
    return COMBINERS[method](df, names, extra, y, w, rounds)


# --------------------------------------------------------------------- referee
def honest_comparison(df: DataFrame, id_col: str, names: Sequence[str], y: str,
                      w: str | None = None, extra: Sequence[str] = (), repeats: int = 3,
                      splits: int = fixed.N_FOLDS, rounds: int = 500, parallel: int = 4,
                      boosted: bool = True) -> DataFrame:
    """Mean held-out weighted error of every combiner: ``(method, repeat, fold, wmse)``.

    Each combiner is fitted on four fifths of the out-of-fold rows and judged on
    the remaining fifth; nothing is judged on rows it was fitted on.
    """
    seeds = [fixed.SEED + fixed.REFEREE_SEED_STEP * r for r in range(repeats)]
    dealt = repeated_folds(df, id_col, y, seeds, splits)
    wide = dealt.groupBy(id_col).pivot("repeat", list(range(repeats))).agg(F.first("fold"))
    wide = wide.withColumnsRenamed({str(r): f"__rep{r}" for r in range(repeats)})
    columns = [f"__rep{r}" for r in range(repeats)]
    every = [*names, *extra]
    # read twice, and several times more by every boosted fold
    folded = written(df.join(wide, id_col).select(*every, y, *([w] if w else []), *columns))
    by_rep = F.explode(F.array(*[F.struct(F.lit(r).alias("rep"), F.col(c).alias("fold"))
                                 for r, c in enumerate(columns)]))
    long = folded.select(*every, y, *([w] if w else []), by_rep.alias("__s")).select("*", "__s.*")
    cells = moments(long, every, y, w, ["rep", "fold"])
    totals = {r: _total([m for k, m in cells.items() if k[0] == r]) for r in range(repeats)}
    train = {k: totals[k[0]] - m for k, m in cells.items()}
    alphas = ridge_alphas(folded, train, y, w, columns)
    models = range(len(names))
    rows = []
    for key, held in sorted(cells.items()):
        part, own = train[key].part(models), held.part(models)
        for i, n in enumerate(names):
            rows.append((f"single_{n}", *key, own.mse(np.eye(len(names))[i])))
        rows.append(("blend_equal", *key, own.mse(np.full(len(names), 1.0 / len(names)))))
        rows.append(("blend_optimized", *key, own.mse(convex_weights(part))))
        stack = _basis(train[key]).linear(every, alphas[key])
        rows.append(("stack_ridge", *key, held.mse(np.array(stack.coef), stack.intercept)))

    def judge(key):
        c = F.col(columns[key[0]])
        model = boosted_stack(folded.where(c != key[1]), every, y, w, rounds)
        scored = model.predict(folded.where(c == key[1]), "__pred")
        return ("stack_boosted", *key, float(scored.agg(weighted_mse(y, "__pred", w)).first()[0]))

    if boosted:
        rows += run_all([lambda k=k: judge(k) for k in sorted(cells)], parallel)
    return df.sparkSession.createDataFrame(rows, "method string, repeat int, fold int, wmse double")


def _total(parts: Sequence[Moments]) -> Moments:
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def referee_means(scores: DataFrame) -> DataFrame:
    return scores.groupBy("method").agg(F.avg("wmse").alias("wmse"))


def referee_winner(scores: DataFrame) -> str:
    return referee_means(scores).orderBy("wmse", "method").first()["method"]


def referee_folds(df: DataFrame, id_col: str, y: str, repeat: int = 0) -> DataFrame:
    """The referee's own folds: target bins only, a seed per repeat."""
    return make_folds(df, id_col, y, seed=fixed.SEED + fixed.REFEREE_SEED_STEP * repeat)
