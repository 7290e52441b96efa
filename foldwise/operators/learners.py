"""Learners by name, and how a table becomes their input.

Every learner gets a filled numeric vector: Spark's trees take no nulls, so the
medians of the training part stand in, and the missing-value indicators among
the features keep the information.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (FMRegressionModel, FMRegressor, GBTRegressionModel,
                                   GBTRegressor, LinearRegression, LinearRegressionModel,
                                   RandomForestRegressionModel, RandomForestRegressor)
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise import fixed
from foldwise.operators import features
from foldwise.operators.quantiles import medians

HOLDOUT = 0.08


# ------------------------------------------------------------------------ inputs
@dataclass
class Inputs:
    """Fitted numbers that turn named columns into a feature vector."""

    names: list[str]
    mids: dict[str, float | None]
    stats: dict[str, tuple[float, float]] | None = None
    levels: dict[str, int] = field(default_factory=dict)

    @property
    def vector_names(self) -> list[str]:
        plain = [n for n in self.names if n not in self.levels]
        return plain + [f"{c}={i}" for c, n in self.levels.items() for i in range(n)]

    def subset(self, names: Sequence[str]) -> "Inputs":
        """The same fitted numbers for fewer columns."""
        stats = None if self.stats is None else {n: v for n, v in self.stats.items() if n in names}
        return Inputs([n for n in names], {n: v for n, v in self.mids.items() if n in names}, stats,
                      {n: v for n, v in self.levels.items() if n in names})

    def vector(self):
        plain = [n for n in self.names if n not in self.levels]
        filled = features.median_fill(plain, self.mids)
        cells = []
        for n in plain:
            cell = filled[n]
            if self.stats is not None:
                mean, sd = self.stats[n]
                clamp = fixed.STANDARD_CLAMP
                cell = F.least(F.greatest((cell - F.lit(mean)) / F.lit(sd), F.lit(-clamp)), F.lit(clamp))
            cells.append(cell)
        return array_to_vector(F.array(*cells) if cells else F.array().cast("array<double>"))

    def apply(self, df: DataFrame, keep: Sequence) -> DataFrame:
        """The kept columns and the feature vector; levels are a sparse block as wide as their dictionary."""
        if not self.levels:
            return df.select(*keep, self.vector().alias("features"))
        n = range(len(self.levels))
        # unseen counts as the first level
        codes = [F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0)).cast("double").alias(f"__code{i}")
                 for i, c in enumerate(self.levels)]
        made = df.select(*keep, self.vector().alias("__plain"), *codes)
        kept = [c for c in made.columns if c != "__plain" and not c.startswith("__code")]
        widest = df.sparkSession.createDataFrame([tuple(float(w - 1) for w in self.levels.values())],
                                                 ", ".join(f"__code{i} double" for i in n))
        hot = OneHotEncoder(inputCols=[f"__code{i}" for i in n], outputCols=[f"__hot{i}" for i in n],
                            handleInvalid="keep").fit(widest)
        joined = VectorAssembler(inputCols=["__plain", *[f"__hot{i}" for i in n]], outputCol="features")
        return joined.transform(hot.transform(made)).select(*kept, "features")


def fit_inputs(df: DataFrame, names: Sequence[str], scaled: bool = False,
               codes: Sequence[str] = (), mids: dict[str, float | None] | None = None) -> Inputs:
    plain = [n for n in names if n not in codes]
    levels = {}
    if scaled and codes:
        row = df.agg(*[F.max(c) for c in codes]).first()
        levels = {c: int(row[i] or 0) + 1 for i, c in enumerate(codes)}
    else:
        plain = list(names)
    mids = medians(df, plain) if mids is None else {c: mids[c] for c in plain}
    inputs = Inputs(list(names), mids, None, levels)
    if scaled:
        filled = df.select(*[e.alias(c) for c, e in features.median_fill(plain, mids).items()])
        inputs.stats = features.standard_stats(filled, plain)
    return inputs


# ----------------------------------------------------------------------- learners
@dataclass(frozen=True)
class Learner:
    """A family: how to make its estimator, its search space and its defaults."""

    make: Callable[[dict, int, bool], Any]
    space: dict[str, tuple]
    defaults: dict[str, Any]
    model: type
    scaled: bool = False
    early_stop: bool = False
    weighted: bool = True


def _boosted(p: dict, seed: int, weighted: bool) -> GBTRegressor:
    est = GBTRegressor(featuresCol="features", labelCol="__y", seed=seed,
                       maxIter=p["rounds"], maxDepth=p["depth"], stepSize=p["step"],
                       subsamplingRate=p["rows"], featureSubsetStrategy=str(p["columns"]),
                       minInstancesPerNode=p["leaf"], validationIndicatorCol="__stop",
                       validationTol=0.01)
    return est.setWeightCol("__w") if weighted else est


def _forest(p: dict, seed: int, weighted: bool) -> RandomForestRegressor:
    est = RandomForestRegressor(featuresCol="features", labelCol="__y", seed=seed,
                                numTrees=p["trees"], maxDepth=p["depth"],
                                featureSubsetStrategy=str(p["columns"]),
                                minInstancesPerNode=p["leaf"])
    return est.setWeightCol("__w") if weighted else est


def _factor(p: dict, seed: int, weighted: bool) -> FMRegressor:
    return FMRegressor(featuresCol="features", labelCol="__y", seed=seed, factorSize=p["factors"],
                       maxIter=p["rounds"], stepSize=p["step"], regParam=p["l2"])


@dataclass
class RidgeModel:
    """A linear model on a vector column."""

    coefficients: np.ndarray
    intercept: float
    features_col: str = "features"

    def transform(self, df: DataFrame) -> DataFrame:
        coef = F.array(*[F.lit(float(c)) for c in self.coefficients])
        products = F.zip_with(vector_to_array(self.features_col), coef, lambda x, b: x * b)
        total = F.aggregate(products, F.lit(float(self.intercept)), lambda s, x: s + x)
        return df.withColumn("prediction", total)


LEARNERS: dict[str, Learner] = {
    "boosted": Learner(_boosted, {"rounds": ("int", 20, 200), "depth": ("int", 3, 7),
                                  "step": ("log", 0.02, 0.2), "rows": ("float", 0.6, 1.0),
                                  "columns": ("float", 0.3, 1.0), "leaf": ("int", 1, 50)},
                       {"rounds": 60, "depth": 5, "step": 0.1, "rows": 0.85, "columns": 0.8, "leaf": 20},
                       GBTRegressionModel, early_stop=True),
    "forest": Learner(_forest, {"trees": ("int", 50, 300), "depth": ("int", 6, 14),
                                "columns": ("float", 0.3, 1.0), "leaf": ("int", 1, 20)},
                      {"trees": 100, "depth": 10, "columns": 0.6, "leaf": 3},
                      RandomForestRegressionModel),
    "factor": Learner(_factor, {"factors": ("int", 2, 16), "rounds": ("int", 20, 100),
                                "step": ("log", 0.001, 0.1), "l2": ("log", 1e-6, 1e-1)},
                      {"factors": 4, "rounds": 60, "step": 0.05, "l2": 1e-3},
                      FMRegressionModel, scaled=True, weighted=False),
    "ridge": Learner(lambda p, seed, weighted: p["alpha"], {"alpha": ("log", 1e-3, 1e3)},
                     {"alpha": 2.0}, RidgeModel, scaled=True),
}


def mean_prediction(models: Sequence["Fitted | FittedClass"], df: DataFrame, keep: Sequence[str], out: str) -> DataFrame:
    """The models' mean prediction for every row, in one projection over one scan."""
    kept, made = list(keep), df
    for i, model in enumerate(models):
        made = model.append(made, f"__p{i}")
    mean = sum((F.col(f"__p{i}") for i in range(1, len(models))), F.col("__p0")) / F.lit(float(len(models)))
    return made.select(*kept, mean.alias(out))


@dataclass
class Fitted:
    """A fitted learner together with the numbers that prepare its input."""

    name: str
    inputs: Inputs
    model: Any
    id_col: str
    shift: float = 0.0
    scale: float = 1.0

    def append(self, df: DataFrame, out: str) -> DataFrame:
        """All columns of ``df`` and the prediction."""
        scored = self.model.transform(self.inputs.apply(df, df.columns))
        return scored.select(*df.columns, (F.col("prediction") * F.lit(self.scale) + F.lit(self.shift)).alias(out))

    def predict(self, df: DataFrame, keep: Sequence[str] = (), out: str = "pred") -> DataFrame:
        return self.append(df, out).select(self.id_col, *keep, out)


def fit_ridge(df: DataFrame, y: str, alpha: float, weight: str | None = None, features_col: str = "features",
              solver: str = "exact", rounds: int = 500, tol: float = 1e-6) -> RidgeModel | LinearRegressionModel:
    """Least squares plus ``alpha`` times the squared coefficients, intercept free.

    ``solver="exact"`` sums the products of all columns in one pass and solves the normal equations from those sums:
    the choice for table columns. ``"iterative"`` is for sparse text, too wide for a matrix of products; it goes on until
    its loss changes by less than ``tol``, for ``rounds`` rounds at most. Its penalty is scaled by the target deviation
    and the weight sum, which the factor below undoes.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    if solver == "exact":
        return _normal_equations(df, y, alpha, w, features_col)
    if solver != "iterative":
        raise ValueError(solver)
    mean, square, total = df.agg(F.sum(w * F.col(y)) / F.sum(w),
                                 F.sum(w * F.col(y) * F.col(y)) / F.sum(w), F.sum(w)).first()
    deviation = max(square - mean * mean, 0.0) ** 0.5
    est = LinearRegression(featuresCol=features_col, labelCol=y, elasticNetParam=0.0,
                           standardization=False, regParam=alpha * deviation / total,
                           solver="l-bfgs", maxIter=rounds, tol=tol)
    return (est.setWeightCol(weight) if weight else est).fit(df)


def _normal_equations(df, y, alpha, w, features_col) -> RidgeModel:
    """Products are summed around the means: columns with a large offset keep their digits."""
    centre = df.select(Summarizer.mean(F.col(features_col)).alias("x"), F.avg(F.col(y).cast("double")).alias("y")).first()
    middle = np.append(centre["x"].toArray(), centre["y"])
    width = len(middle) - 1
    cells = F.zip_with(F.concat(vector_to_array(features_col), F.array(F.col(y).cast("double"))),
                       F.lit(middle.tolist()), lambda v, m: v - m)
    root = F.sqrt(w)
    cells = F.concat(cells, F.array(F.lit(1.0)))
    rows = df.select(array_to_vector(F.transform(cells, lambda x: x * root)).alias("v"))
    sums = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "v")).computeGramianMatrix().toArray()
    x, t, one = slice(0, width), width, width + 1
    total = sums[one, one]
    mean, mean_y = sums[x, one] / total, sums[t, one] / total
    covariance = sums[x, x] - total * np.outer(mean, mean)
    cross = sums[x, t] - total * mean * mean_y
    coef = np.linalg.lstsq(covariance + alpha * np.eye(width), cross, rcond=None)[0]
    return RidgeModel(coef, float(middle[-1] + mean_y - coef @ (middle[:-1] + mean)), features_col)


def fit(name: str, params: dict, df: DataFrame, id_col: str, y: str, names: Sequence[str],
        seed: int = fixed.SEED, weight: str | None = None, codes: Sequence[str] = (),
        inputs: Inputs | None = None) -> Fitted:
    """Fit a learner on a training part; early stopping looks only at a hashed
    slice of that part, never at the rows it will be judged on."""
    learner = LEARNERS[name]
    p = learner.defaults | params
    inputs = inputs or fit_inputs(df, names, learner.scaled, codes if learner.scaled else ())
    extra = [F.col(y).cast("double").alias("__y")]
    if weight:
        extra.append(F.col(weight).alias("__w"))
    if learner.early_stop:
        extra.append((features.hash_share(id_col, seed) < HOLDOUT).alias("__stop"))
    made = inputs.apply(df, extra)
    if name == "ridge":
        model = fit_ridge(made, "__y", p["alpha"], "__w" if weight else None)
        return Fitted(name, inputs, model, id_col)
    shift, scale = 0.0, 1.0
    if name == "factor":  # its solver takes small steps from zero: standardise the target
        shift, scale = df.agg(F.avg(y), F.stddev_pop(y)).first()
        scale = scale or 1.0
        made = made.withColumn("__y", (F.col("__y") - F.lit(shift)) / F.lit(scale))
    model = learner.make(p, seed, bool(weight) and learner.weighted).fit(made)
    return Fitted(name, inputs, model, id_col, shift, scale)


def fit_classifier(df: DataFrame, id_col: str, label, names: Sequence[str], rounds: int = 60,
                   depth: int = 5, step: float = 0.1, seed: int = fixed.SEED,
                   weight: str | None = None, inputs: Inputs | None = None) -> "FittedClass":
    inputs = inputs or fit_inputs(df, names)
    extra = [label.cast("double").alias("__y"),
             (features.hash_share(id_col, seed) < HOLDOUT).alias("__stop")]
    if weight:
        extra.append(F.col(weight).alias("__w"))
    est = GBTClassifier(featuresCol="features", labelCol="__y", maxIter=rounds, maxDepth=depth,
                        stepSize=step, seed=seed, validationIndicatorCol="__stop")
    made = inputs.apply(df, extra)
    return FittedClass(inputs, (est.setWeightCol("__w") if weight else est).fit(made), id_col)


@dataclass
class FittedClass:
    inputs: Inputs
    model: GBTClassificationModel
    id_col: str

    def append(self, df: DataFrame, out: str) -> DataFrame:
        """All columns of ``df`` and the chance of the label."""
        scored = self.model.transform(self.inputs.apply(df, df.columns))
        return scored.select(*df.columns, F.get(vector_to_array("probability"), F.lit(1)).alias(out))

    def predict(self, df: DataFrame, keep: Sequence[str] = (), out: str = "pred") -> DataFrame:
        return self.append(df, out).select(self.id_col, *keep, out)


# ------------------------------------------------------------------ saved models
def save(model: Fitted | FittedClass, path: str, spark) -> None:
    i = model.inputs
    linear = isinstance(model.model, RidgeModel)
    if not linear:
        model.model.write().overwrite().save(f"{path}/model")
    meta = {"kind": "class" if isinstance(model, FittedClass) else model.name, "id_col": model.id_col,
            "linear": [model.model.coefficients.tolist(), model.model.intercept] if linear else None,
            "shift": getattr(model, "shift", 0.0), "scale": getattr(model, "scale", 1.0), "names": i.names, "mids": i.mids,
            "stats": i.stats, "levels": i.levels}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(
        "overwrite").json(f"{path}/inputs")


def load(path: str, spark) -> Fitted | FittedClass:
    meta = json.loads(spark.read.schema("meta string").json(f"{path}/inputs").first()[0])
    stats = None if meta["stats"] is None else {k: tuple(v) for k, v in meta["stats"].items()}
    inputs = Inputs(meta["names"], meta["mids"], stats, meta["levels"])
    if meta["kind"] == "class":
        return FittedClass(inputs, GBTClassificationModel.load(f"{path}/model"), meta["id_col"])
    if meta["linear"] is not None:
        model = RidgeModel(np.array(meta["linear"][0]), meta["linear"][1])
        return Fitted(meta["kind"], inputs, model, meta["id_col"])
    kind = LEARNERS[meta["kind"]].model
    return Fitted(meta["kind"], inputs, kind.load(f"{path}/model"), meta["id_col"], meta["shift"],
                  meta["scale"])
