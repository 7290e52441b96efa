"""Regression metrics, exact AUC, fold tables and prediction summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.operators.ranks import BUCKET_ROWS, running_before


def squared_error(y: str, p: str) -> Column:
    return (F.col(y) - F.col(p)) * (F.col(y) - F.col(p))


def weighted_mse(y: str, p: str, w: str | None = None) -> Column:
    if w is None:
        return F.avg(squared_error(y, p))
    return F.try_divide(F.sum(F.col(w) * squared_error(y, p)), F.sum(w))


def metric_columns(y: str = "y", p: str = "pred", w: str | None = None) -> dict[str, Column]:
    mse = F.avg(squared_error(y, p))
    out = {"mse": mse, "rmse": F.sqrt(mse), "mae": F.avg(F.abs(F.col(y) - F.col(p))),
           "r2": 1 - F.try_divide(mse, F.var_pop(y))}
    if w is not None:
        out |= {"wmse": weighted_mse(y, p, w), "wrmse": F.sqrt(weighted_mse(y, p, w))}
    return out


def regression_metrics(df: DataFrame, y: str = "y", p: str = "pred", w: str | None = None,
                       by: Sequence[str] = ()) -> DataFrame:
    aggs = [e.alias(n) for n, e in metric_columns(y, p, w).items()]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def fold_metrics(preds: DataFrame, y: str = "y", p: str = "pred", w: str | None = None) -> DataFrame:
    """One row per model, repeat and fold."""
    return regression_metrics(preds, y, p, w, ["model", "repeat", "fold"])


def fold_summary(folds: DataFrame, names: Sequence[str] = ("mse", "rmse", "mae")) -> DataFrame:
    return folds.groupBy("model").agg(*[
        e for n in names for e in (F.avg(n).alias(f"{n}_mean"), F.stddev_samp(n).alias(f"{n}_std"))])


def mean_predictions(preds: DataFrame, keys: Sequence[str], p: str = "pred") -> DataFrame:
    """Average over repeats and fold models; missing predictions do not count."""
    return preds.groupBy(*keys).agg(F.avg(p).alias(p))


def fold_matrix(folds: DataFrame, repeats: int, splits: int, metric: str = "rmse") -> DataFrame:
    """Models by folds, columns named r<repeat>f<fold>."""
    label = F.concat(F.lit("r"), F.col("repeat"), F.lit("f"), F.col("fold"))
    names = [f"r{r}f{f}" for r in range(repeats) for f in range(splits)]
    return (folds.withColumn("__rf", label).groupBy("model").pivot("__rf", names)
            .agg(F.first(metric)))


def model_ranking(oof: DataFrame, folds: DataFrame, y: str = "y", p: str = "pred") -> DataFrame:
    """Overall error of the averaged predictions beside its spread over folds."""
    overall = regression_metrics(oof, y, p, by=["model"]).select("model", "rmse")
    spread = folds.groupBy("model").agg(F.stddev_samp("rmse").alias("rmse_std"))
    return overall.join(spread, "model").orderBy("rmse", "model")


def best_name(scores: DataFrame, name: str = "model", score: str = "rmse") -> DataFrame:
    """Name with the lowest score, ties by name."""
    return scores.agg(F.min(F.struct(score, name)).alias("b")).select(f"b.{name}", f"b.{score}")


def best_residuals(oof: DataFrame, id_col: str, y: str = "y", p: str = "pred") -> DataFrame:
    """Residuals of the model with the lowest error; the ranking is read once."""
    best = best_name(regression_metrics(oof, y, p, by=["model"])).first()["model"]
    return oof.where(F.col("model") == best).select(
        id_col, "model", y, p, (F.col(y) - F.col(p)).alias("residual"))


def prediction_summary(df: DataFrame, p: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count(p).alias("n"), F.avg(p).alias("mean"),
                               F.stddev_pop(p).alias("std"))


def auc(df: DataFrame, score: str, label: str, by: Sequence[str] = (),
        bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Exact area under the ROC curve with mid-ranks for ties.

    Rows are first counted per distinct score, so equal scores cannot crowd a
    task, and the running count is taken in ordered buckets.
    """
    by = list(by)
    hit = (F.col(label).cast("int") == 1).cast("long")
    counts = (df.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).alias("__s"))
              .agg(F.sum(hit).alias("__p"), F.sum(1 - hit).alias("__n")))
    ranked = running_before(counts, "__s", ["__n"], by, bucket_rows)
    pos, neg = F.col("__p").cast("double"), F.col("__n").cast("double")
    wins = F.sum(pos * (F.col("__n_before") + neg / 2))
    area = F.try_divide(wins, F.sum(pos) * F.sum(neg)).alias("auc")
    return ranked.groupBy(*by).agg(area) if by else ranked.agg(area)
