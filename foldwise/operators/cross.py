"""Fold views, nested features and cross-validated training."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from threading import Lock

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from foldwise import fixed
from foldwise.operators import folds as fold_ops
from foldwise.operators import learners
from foldwise.scratch import written

Predictor = Callable[[DataFrame], DataFrame]


def run_all(jobs: Sequence[Callable], parallel: int = 4) -> list:
    """Run independent Spark jobs from a few driver threads; results in order."""
    if parallel <= 1 or len(jobs) <= 1:
        return [job() for job in jobs]
    with ThreadPoolExecutor(parallel) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


# ------------------------------------------------------------------- fold views
def dynamic_table(columns: Mapping[str, DataFrame], id_col: str, outer: str = "outer",
                  value: str = "value", repeat: int = 0) -> DataFrame:
    """Long table of fold-aware columns: ``(id, repeat, outer, name, value)``."""
    return union([df.select(id_col, F.lit(repeat).alias("repeat"), outer,
                            F.lit(name).alias("name"), value) for name, df in columns.items()])


def with_dynamic(static: DataFrame, dyn: DataFrame, id_col: str, k: int, names: Sequence[str],
                 repeat: int = 0, outer: str = "outer") -> DataFrame:
    """Static columns plus the dynamic ones that are valid when fold ``k`` is held out."""
    one = dyn.where((F.col("repeat") == repeat) & (F.col(outer) == k))
    if "value" in dyn.columns:
        one = one.where(F.col("name").isin(list(names))).groupBy(id_col).pivot("name", list(names)).agg(F.first("value"))
    return static.join(one.select(id_col, *names), id_col)


def wide_dynamic(dyn: DataFrame, id_col: str, names: Sequence[str], outer: str = "outer") -> DataFrame:
    """The fold-aware columns side by side, stored by repeat and outer fold: a view reads its part and joins once."""
    wide = dyn.groupBy(id_col, "repeat", outer).pivot("name", list(names)).agg(F.first("value"))
    return written(wide, by=["repeat", outer])


def fold_view(static: DataFrame, dyn: DataFrame | None, id_col: str, k: int,
              names: Sequence[str] = (), repeat: int = 0, fold: str = "fold"
              ) -> tuple[DataFrame, DataFrame]:
    """(training part, validation part) of one outer fold, dynamic columns attached."""
    df = with_dynamic(static, dyn, id_col, k, names, repeat) if dyn is not None and names else static
    return df.where(F.col(fold) != k), df.where(F.col(fold) == k)


# --------------------------------------------------------------- nested features
def train_schema(train: DataFrame, marks: str) -> StructType:
    """The schema of a table with an array of fold marks at its end."""
    return StructType([*train.schema.fields, StructField(marks, ArrayType(IntegerType()))])


def marked_rows(train: DataFrame, id_col: str, y: str, fold: str, splits: int, inner: int, seed: int) -> DataFrame:
    """The training rows with ``__inner``: for every outer fold the inner fold of the row, -1 if the outer one holds it out."""
    dealt = fold_ops.inner_folds(train.select(id_col, y, fold), id_col, y, fold, splits, inner, seed)
    marks = dealt.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("outer", "inner"))).alias("__o"))
    marks = marks.select(F.col(id_col).alias("__id"), F.transform("__o", lambda x: x["inner"]).alias("__inner"))
    # one wide row per training row, marked with its inner fold for every outer one; a part is a filter
    return written(train.join(marks, F.col(id_col) == F.col("__id")).drop("__id"), train_schema(train, "__inner"))


def nested_feature(train: DataFrame, build: Callable[[DataFrame], Predictor], id_col: str, y: str,
                   fold: str = "fold", splits: int = fixed.N_FOLDS,
                   inner: int = fixed.INNER_SPLITS, seed: int = fixed.SEED,
                   test: DataFrame | None = None, parallel: int = 4
                   ) -> tuple[DataFrame, DataFrame | None]:
    """Leak-free column from any learner.

    ``build(fit)`` learns from ``fit`` and returns a function that maps a table
    to ``(id, value)``. A validation row is predicted from its outer training
    part, a training row from the other inner folds of that part, and test rows
    from all training rows. Returns ``(id, outer, value)`` and ``(id, value)``.
    """
    nested = marked_rows(train, id_col, y, fold, splits, inner, seed)

    def fit_one(k: int, j: int) -> DataFrame:
        own = F.get("__inner", F.lit(k))
        predict = build(nested.where((own >= 0) & (own != j)).drop("__inner"))
        target = nested.where(own == j).drop("__inner")
        return predict(target).withColumn("outer", F.lit(k)).select(id_col, "outer", "value")

    jobs = [lambda k=k, j=j: fit_one(k, j) for k in range(splits) for j in (-1, *range(inner))]
    values = union(run_all(jobs, parallel))
    if test is None:
        return values, None
    return values, build(train)(test).select(id_col, "value")


# ------------------------------------------------------------------ cross-fitting
def out_of_fold(df: DataFrame, fit: Callable[[DataFrame, int], Callable[[DataFrame], DataFrame]],
                splits: int, fold: str = "fold", parallel: int = 4
                ) -> tuple[DataFrame, list[Callable[[DataFrame], DataFrame]]]:
    """Predict each fold by a model of the others; also returns the fold models."""
    models = run_all([lambda k=k: fit(df.where(F.col(fold) != k), k) for k in range(splits)], parallel)
    return union([m(df.where(F.col(fold) == k)) for k, m in enumerate(models)]), models


# ------------------------------------------------------------------- repeated CV
@dataclass
class Bundle:
    """What fold training needs.

    ``static`` has the id, the target and the fixed features; ``folds`` is
    ``(id, repeat, fold)``; ``dyn`` holds the fold-aware columns and
    ``test_dyn`` their test values. All are written tables, so folds never
    change when a task is run again.
    """

    static: DataFrame
    folds: DataFrame
    id_col: str
    y: str
    names: list[str]
    dyn: DataFrame | None = None
    dyn_names: list[str] = field(default_factory=list)
    test: DataFrame | None = None
    weight: str | None = None
    splits: int = fixed.N_FOLDS
    seeds: Sequence[int] = fixed.REPEAT_SEEDS
    codes: list[str] = field(default_factory=list)
    _inputs: dict = field(default_factory=dict)
    _joined: dict = field(default_factory=dict, init=False)
    _lock: Lock = field(default_factory=Lock, init=False, repr=False, compare=False)

    def __post_init__(self):
        if self.dyn is not None and self.dyn_names and "value" in self.dyn.columns:
            self.dyn = wide_dynamic(self.dyn, self.id_col, self.dyn_names)

    @property
    def feature_names(self) -> list[str]:
        return [*self.names, *self.dyn_names]

    def view(self, r: int, k: int, names: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
        names = list(names or self.feature_names)
        static = [n for n in names if n not in self.dyn_names]
        keep = [self.id_col, self.y, *([self.weight] if self.weight else []), *static]
        base = self._dealt(r).select(*keep, "fold")
        return fold_view(base, self.dyn, self.id_col, k, [n for n in names if n in self.dyn_names], r)

    def _dealt(self, r: int) -> DataFrame:
        """The fixed features beside the folds of one repeat, stored once: every learner reads them several times a fold."""
        with self._lock:
            if r not in self._joined:
                keep = [self.id_col, self.y, *([self.weight] if self.weight else []), *self.names]
                dealt = self.folds.where(F.col("repeat") == r).select(self.id_col, "fold")
                self._joined[r] = written(self.static.select(*dict.fromkeys(keep)).join(dealt, self.id_col))
            return self._joined[r]

    def inputs(self, r: int, k: int, scaled: bool, names: Sequence[str] | None = None):
        """Fill values and scales of one training part, shared by the learners."""
        if (r, k, scaled) not in self._inputs:
            train, _ = self.view(r, k)
            codes = self.codes if scaled else ()
            other = self._inputs.get((r, k, False))
            self._inputs[(r, k, scaled)] = learners.fit_inputs(
                train, self.feature_names, scaled, codes, other.mids if other else None)
        found = self._inputs[(r, k, scaled)]
        return found if names is None else found.subset(names)


def fit_fold(bundle: Bundle, name: str, params: dict, r: int, k: int,
             names: Sequence[str] | None = None, seed: int | None = None):
    """One fold model and its validation predictions."""
    train, held = bundle.view(r, k, names)
    learner = learners.LEARNERS[name]
    seed = bundle.seeds[r] + fixed.FOLD_SEED_STEP * k if seed is None else seed
    model = learners.fit(name, params, train, bundle.id_col, bundle.y,
                         list(names or bundle.feature_names), seed, bundle.weight,
                         inputs=bundle.inputs(r, k, learner.scaled, names))
    keep = [bundle.y] + ([bundle.weight] if bundle.weight else [])
    pred = model.predict(held, keep).withColumns(
        {"repeat": F.lit(r), "fold": F.lit(k), "model": F.lit(name)})
    return model, pred


def cross_validate(bundle: Bundle, name: str, params: dict, repeats: int, parallel: int = 4
                   ) -> tuple[DataFrame, DataFrame | None, dict]:
    """Out-of-fold predictions of every repeat, averaged test predictions, fold models."""
    grid = [(r, k) for r in range(repeats) for k in range(bundle.splits)]
    done = run_all([lambda g=g: fit_fold(bundle, name, params, *g) for g in grid], parallel)
    models = {g: d[0] for g, d in zip(grid, done)}
    preds = written(union([d[1] for d in done]))
    if bundle.test is None:
        return preds, None, models
    mean = learners.mean_prediction(list(models.values()), bundle.test, [bundle.id_col], "pred")
    return preds, mean.withColumn("model", F.lit(name)), models


def quick_score(bundle: Bundle, name: str, params: dict, names: Sequence[str] | None = None,
                weight: str | None = None, parallel: int = 4) -> float:
    """Error of one fixed learner on a set of columns, first repeat."""
    from foldwise.operators.metrics import weighted_mse
    done = run_all([lambda k=k: fit_fold(bundle, name, params, 0, k, names)[1]
                    for k in range(bundle.splits)], parallel)
    return float(union(done).agg(weighted_mse(bundle.y, "pred", weight)).first()[0])


# ------------------------------------------------------------------------ search
TRIAL_SCHEMA = ("model string, trial int, params string, steps array<double>, value double, "
                "state string")


def draw(space: dict[str, tuple], seed: int, trial: int) -> dict:
    """Parameters of a numbered trial; the same number always gives the same draw."""
    rng = np.random.RandomState([seed, trial])
    out = {}
    for name, (kind, low, high) in space.items():
        if kind == "int":
            out[name] = int(rng.randint(low, high + 1))
        elif kind == "log":
            out[name] = float(np.exp(rng.uniform(np.log(low), np.log(high))))
        else:
            out[name] = float(rng.uniform(low, high))
    return out


def search(spark, model: str, space: dict[str, tuple], score: Callable[[dict, int], float],
           steps: int, trials: int, seconds: float, path: str, seed: int = fixed.SEED,
           startup: int = 12) -> DataFrame:
    """Seeded random search whose finished trials are rows of a table.

    Trials found in the table are not run again. From the second step on, a
    trial that is behind the median of earlier ones is given up.
    """
    finished = [r for r in read_trials(spark, path).where(F.col("model") == model).collect()]
    done = {r["trial"] for r in finished}
    started = time.monotonic()
    for trial in range(trials):
        if trial in done:
            continue
        if time.monotonic() - started > seconds:
            break
        params, means, state = draw(space, seed, trial), [], "complete"
        total = 0.0
        for k in range(steps):
            total += float(score(params, k))
            means.append(total / (k + 1))
            earlier = [r["steps"][k] for r in finished if len(r["steps"]) > k]
            if 1 <= k < steps - 1 and len(finished) >= startup and means[-1] > float(np.median(earlier)):
                state = "pruned"
                break
        row = (model, trial, json.dumps(params), means, means[-1], state)
        spark.createDataFrame([row], TRIAL_SCHEMA).coalesce(1).write.mode("append").json(path)
        finished.append({"steps": means})
    return read_trials(spark, path).where(F.col("model") == model)


def read_trials(spark, path: str) -> DataFrame:
    try:
        return spark.read.schema(TRIAL_SCHEMA).json(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], TRIAL_SCHEMA)


def best_params(trials: DataFrame) -> dict[str, dict]:
    best = (trials.where("state = 'complete'").groupBy("model")
            .agg(F.min_by("params", F.struct("value", "trial")).alias("params")).collect())
    return {r["model"]: json.loads(r["params"]) for r in best}
