"""Aggregations, sorts and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise import fixed
from foldwise.catalog import query
from foldwise.catalog.bind import WITH_APPLICANTS, WITH_CASES
from foldwise.catalog.rowwise import NUMERIC, TRAIN_SQL, r6
from foldwise.catalog.sqltext import (MODELS, TRAIN_CASES, WEIGHT_CTES, WITH_PREDS)
from foldwise.functions.rows import rounded
from foldwise.operators import cross, encode, features, folds, metrics, profile, quantiles
from foldwise.scratch import written

METRIC_SQL = {"mse": "avg((y - pred) * (y - pred))", "rmse": "sqrt(avg((y - pred) * (y - pred)))",
              "mae": "avg(abs(y - pred))",
              "r2": "1 - avg((y - pred) * (y - pred)) / var_pop(y)"}


def all_rounded(df, keys=(), digits=6):
    doubles = {f.name for f in df.schema if f.dataType.typeName() == "double"}
    return df.select(*[rounded(c, digits).alias(c) if c in doubles and c not in keys else F.col(c)
                       for c in df.columns])


@query("d01_z_statistics", f"""{TRAIN_SQL} SELECT {", ".join(
    f"{r6(f'avg({e})')} AS {n}__mean, {r6(f'stddev_samp({e})')} AS {n}__sd" for n, e in
    [(c, c) for c in fixed.Z_RAW] + [(f"log1p_{c}", f"ln(1 + {c})") for c in fixed.Z_LOG])} FROM train""")
def _(t):
    return all_rounded(features.z_statistics(t.applicants("train")))


@query("d02_group_means", f"""{WITH_CASES}
  SELECT dept, {r6("avg(y)")} AS y, {r6("avg(avg_qty)")} AS avg_qty, {r6("avg(max_tax)")} AS max_tax
  FROM cases WHERE dept IS NOT NULL GROUP BY dept""")
def _(t):
    return all_rounded(encode.group_means(t.cases(), "dept", ["y", "avg_qty", "max_tax"]))


@query("d03_relative_frequencies", f"""{WITH_CASES}
  SELECT n_items, {r6("count(*) / (SELECT count(n_items) FROM cases)::DOUBLE")} AS share
  FROM cases WHERE n_items IS NOT NULL GROUP BY n_items""")
def _(t):
    return all_rounded(folds.shares(t.cases(), "n_items"))


@query("d04_sorted_dictionary", f"""{WITH_CASES}
  SELECT v AS n_items, CAST(row_number() OVER (ORDER BY v) - 1 AS INT) AS code
  FROM (SELECT DISTINCT coalesce(CAST(n_items AS VARCHAR), 'nan') AS v FROM cases)""")
def _(t):
    return encode.dictionary(t.cases(), "n_items")


@query("d05_smoothed_target_mean", f"""{TRAIN_CASES}
  SELECT n_items, {r6("(s + p * 20) / (n + 20)")} AS te FROM (
    SELECT coalesce(CAST(n_items AS VARCHAR), 'nan') AS n_items, sum(y) AS s, count(*) AS n,
      (SELECT avg(y) FROM train) AS p FROM train GROUP BY 1)""")
def _(t):
    return all_rounded(encode.smoothed_means(t.cases("train"), "n_items", "y"))


@query("d05_encoding_of_new_rows", f"""{TRAIN_CASES},
  e AS (SELECT dept AS k, (sum(y) + (SELECT avg(y) FROM train) * 20) / (count(*) + 20) AS te
    FROM train GROUP BY dept)
  SELECT row_id, {r6("coalesce(te, (SELECT avg(y) FROM train))")} AS te_dept
  FROM cases LEFT JOIN e ON dept = k WHERE split = 'test'""")
def _(t):
    df = encode.smoothed_lookup(t.cases("train"), t.cases("test"), "dept", "y")
    return all_rounded(df.select("row_id", "te_dept"))


@query("d06_target_profile", f"""{TRAIN_CASES}
  SELECT {r6("avg(y)")} AS mean, {r6("stddev_samp(y)")} AS sd, {r6("min(y)")} AS min, {r6("max(y)")} AS max,
    {r6("avg(CAST(y >= 100 AS INT))")} AS at_ceiling, {r6("var_samp(y)")} AS variance FROM train""")
def _(t):
    return all_rounded(profile.target_profile(t.cases("train"), "y"))


@query("d07_target_by_year", f"""{TRAIN_CASES}
  SELECT yr, {r6("avg(y)")} AS mean, {r6("stddev_samp(y)")} AS std FROM train GROUP BY yr""")
def _(t):
    return all_rounded(profile.target_by(t.cases("train"), "y", "yr"))


@query("d08_histogram", f"""{TRAIN_CASES},
  r AS (SELECT min(y) AS lo, max(y) AS hi FROM train)
  SELECT CAST(least(floor((y - lo) / (hi - lo) * 60), 59) AS INT) AS bin, count(*) AS n
  FROM train, r GROUP BY 1""")
def _(t):
    return profile.histogram(t.cases("train"), "y", 60).select("bin", "n")


@query("d09_null_rates", f"""{TRAIN_SQL}
  SELECT name, {r6("rate")} AS rate FROM (UNPIVOT (SELECT {", ".join(
    f"1 - count({c}) / count(*)::DOUBLE AS {c}" for c in NUMERIC)} FROM train)
    ON {", ".join(NUMERIC)} INTO NAME name VALUE rate) WHERE rate > 0""")
def _(t):
    return all_rounded(profile.null_rates(t.applicants("train"), NUMERIC))


NULLS = list(fixed.NULL_BEARING)


@query("d10_target_by_missingness", f"""{TRAIN_SQL} {" UNION ALL ".join(
    f"SELECT '{c}' AS name, {r6(f'avg(score) FILTER (WHERE {c} IS NULL)')} AS missing, "
    f"{r6(f'avg(score) FILTER (WHERE {c} IS NOT NULL)')} AS present FROM train" for c in NULLS)}""")
def _(t):
    return all_rounded(profile.informative_nulls(t.applicants("train"), NULLS, "score"))


@query("d11_correlations_with_target", f"""{TRAIN_SQL} {" UNION ALL ".join(
    f"SELECT '{c}' AS name, {r6(f'corr({c}, score)')} AS r FROM train" for c in NUMERIC)}""")
def _(t):
    return all_rounded(profile.correlations(t.applicants("train"), NUMERIC, "score"))


def med(c):
    return f"(SELECT median(CAST({c} AS DOUBLE)) FROM train)"


@query("d12_correlations_after_median_fill", f"""{TRAIN_SQL} {" UNION ALL ".join(
    f"SELECT '{c}' AS name, {r6(f'abs(corr(coalesce(CAST({c} AS DOUBLE), {med(c)}), score))')} AS r FROM train"
    for c in NUMERIC)}""")
def _(t):
    found = features.filled_correlations(t.stored_applicants(*NUMERIC, "score"), NUMERIC, "score")
    df = t.spark.createDataFrame(list(found.items()), "name string, r double")
    return all_rounded(df)


@query("d13_exact_medians", f"""{WITH_APPLICANTS} {" UNION ALL ".join(
    f"SELECT '{c}' AS name, {r6(f'median(CAST({c} AS DOUBLE))')} AS v FROM applicants" for c in NUMERIC)}""")
def _(t):
    found = quantiles.medians(written(t.applicants().select(*NUMERIC)), NUMERIC)
    return all_rounded(t.spark.createDataFrame(list(found.items()), "name string, v double"))


@query("d13_exact_quartiles_of_lines", f"""
  SELECT p, {r6("v")} AS v FROM (SELECT unnest([0.0, 0.25, 0.5, 0.75, 0.95, 1.0])::DOUBLE AS p,
    unnest(quantile_cont(l_extendedprice, [0.0, 0.25, 0.5, 0.75, 0.95, 1.0])) AS v FROM lineitem)""")
def _(t):
    probs = [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]
    # a low limit on purpose: this takes the sketch-and-bracket path
    found = quantiles.exact_quantiles(t("lineitem"), {"v": (F.col("l_extendedprice"), probs)},
                                      direct_cells=2000)["v"]
    return all_rounded(t.spark.createDataFrame(list(zip(probs, found)), "p double, v double"))


@query("d14_text_lengths", f"""
  SELECT {r6("avg(length(text))")} AS mean, {r6("quantile_cont(CAST(length(text) AS DOUBLE), 0.95)")} AS p95
  FROM documents""")
def _(t):
    return all_rounded(profile.text_lengths(t("documents"), "text"))


@query("d15_regression_metrics", f"""{WITH_PREDS}
  SELECT model, {", ".join(f"{r6(e)} AS {n}" for n, e in METRIC_SQL.items())} FROM preds GROUP BY model""")
def _(t):
    return all_rounded(metrics.regression_metrics(t.predictions(), by=["model"]))


@query("d15_d16_weighted_metrics", f"""{WITH_PREDS}, {WEIGHT_CTES}
  SELECT model, {r6("sum(w * (y - pred) * (y - pred)) / sum(w)")} AS wmse,
    {r6("sqrt(sum(w * (y - pred) * (y - pred)) / sum(w))")} AS wrmse
  FROM preds JOIN weights USING (row_id) GROUP BY model""")
def _(t):
    w = folds.year_weights(t.stored_cases("train"), t.stored_cases("test"), "yr").select("row_id", "w")
    df = t.predictions().join(w, "row_id")
    return all_rounded(metrics.regression_metrics(df, w="w", by=["model"]).select("model", "wmse", "wrmse"))


FOLD_SQL = f"""{WITH_PREDS}, fm AS (SELECT model, repeat, fold,
  {", ".join(f"{e} AS {n}" for n, e in METRIC_SQL.items())} FROM preds GROUP BY model, repeat, fold)"""


@query("d17_fold_metrics", f"""{FOLD_SQL} SELECT model, repeat, fold,
  {", ".join(f"{r6(n)} AS {n}" for n in METRIC_SQL)} FROM fm""")
def _(t):
    return all_rounded(metrics.fold_metrics(t.predictions()))


@query("d18_fold_summary", f"""{FOLD_SQL} SELECT model, {", ".join(
    f"{r6(f'avg({n})')} AS {n}_mean, {r6(f'stddev_samp({n})')} AS {n}_std" for n in ("mse", "rmse", "mae"))}
  FROM fm GROUP BY model""")
def _(t):
    return all_rounded(metrics.fold_summary(metrics.fold_metrics(t.predictions())))


@query("d19_mean_over_repeats", f"""{WITH_PREDS}
  SELECT row_id, model, {r6("avg(pred)")} AS pred FROM preds GROUP BY row_id, model""")
def _(t):
    return all_rounded(metrics.mean_predictions(t.predictions(), ["row_id", "model"]))


@query("d20_exact_auc", f"""{WITH_CASES},
  c AS (SELECT n_items AS s, count(*) FILTER (WHERE y >= 60)::DOUBLE AS p, count(*) FILTER (WHERE y < 60)::DOUBLE AS n
    FROM cases WHERE n_items IS NOT NULL GROUP BY n_items),
  r AS (SELECT *, sum(n) OVER (ORDER BY s) - n AS below FROM c)
  SELECT {r6("sum(p * (below + n / 2)) / (sum(p) * sum(n))")} AS auc FROM r""")
def _(t):
    df = t.cases().withColumn("hit", F.col("y") >= 60)
    return all_rounded(metrics.auc(df, "n_items", "hit"))


@query("d20_auc_by_group", f"""{WITH_CASES},
  c AS (SELECT dept, bal AS s, count(*) FILTER (WHERE y >= 60)::DOUBLE AS p, count(*) FILTER (WHERE y < 60)::DOUBLE AS n
    FROM cases GROUP BY dept, bal),
  r AS (SELECT *, sum(n) OVER (PARTITION BY dept ORDER BY s) - n AS below FROM c)
  SELECT dept, {r6("sum(p * (below + n / 2)) / (sum(p) * sum(n))")} AS auc FROM r GROUP BY dept""")
def _(t):
    df = t.cases().withColumn("hit", F.col("y") >= 60)
    # small buckets on purpose: this takes the bucketed running count
    return all_rounded(metrics.auc(df, "bal", "hit", ["dept"], bucket_rows=500))


CELLS = ", ".join(f"{r6(f'max(rmse) FILTER (WHERE repeat = {r} AND fold = {f})')} AS r{r}f{f}"
                  for r in range(2) for f in range(5))


@query("d21_fold_matrix", f"{FOLD_SQL} SELECT model, {CELLS} FROM fm GROUP BY model")
def _(t):
    return all_rounded(metrics.fold_matrix(metrics.fold_metrics(t.predictions()), 2, 5))


OOF_SQL = f"""{FOLD_SQL}, oof AS (SELECT row_id, model, any_value(y) AS y, avg(pred) AS pred
  FROM preds GROUP BY row_id, model),
  total AS (SELECT model, sqrt(avg((y - pred) * (y - pred))) AS rmse FROM oof GROUP BY model)"""


def oof_of(preds):
    return metrics.mean_predictions(preds, ["row_id", "model", "y"])


@query("d22_model_ranking", f"""{OOF_SQL} SELECT model, {r6("rmse")} AS rmse, {r6("std")} AS rmse_std
  FROM total JOIN (SELECT model, stddev_samp(rmse) AS std FROM fm GROUP BY model) USING (model)""")
def _(t):
    preds = written(t.predictions())
    return all_rounded(metrics.model_ranking(oof_of(preds), metrics.fold_metrics(preds)))


@query("d23_year_weights", f"""{TRAIN_CASES}, {WEIGHT_CTES}
  SELECT row_id, {r6("w")} AS w FROM weights""")
def _(t):
    return all_rounded(folds.year_weights(t.cases("train"), t.cases("test"), "yr").select("row_id", "w"))


@query("d23_weights_with_absent_year", f"""{WITH_CASES}, train AS (SELECT * FROM cases WHERE split = 'train'),
  mix AS (SELECT yr, count(*) / (SELECT count(*) FROM train)::DOUBLE AS p FROM train GROUP BY yr),
  other AS (SELECT yr, count(*) / (SELECT count(*) FROM cases WHERE split = 'test' AND yr <> 1996)::DOUBLE AS q
    FROM cases WHERE split = 'test' AND yr <> 1996 GROUP BY yr),
  ratios AS (SELECT mix.yr, p, least(greatest(coalesce(q / p, 1.0), 0.25), 3.0) AS r
    FROM mix LEFT JOIN other ON mix.yr = other.yr)
  SELECT yr, {r6("r / (SELECT sum(p * r) FROM ratios)")} AS w, {r6("p")} AS share FROM ratios""")
def _(t):
    # a year is taken away from the test side on purpose
    test = t.cases("test").where("yr <> 1996")
    df = folds.year_weights(t.cases("train"), test, "yr")
    n = df.count()
    return all_rounded(df.groupBy("yr").agg(F.max("w").alias("w"),
                                            (F.count(F.lit(1)) / F.lit(float(n))).alias("share")))


@query("d24_prediction_summary", f"""{WITH_PREDS}
  SELECT model, count(pred) AS n, {r6("avg(pred)")} AS mean, {r6("stddev_pop(pred)")} AS std FROM preds GROUP BY model""")
def _(t):
    return all_rounded(metrics.prediction_summary(t.predictions(), by=["model"]))


@query("d25_residuals_of_best", f"""{OOF_SQL}
  SELECT row_id, model, {r6("y")} AS y, {r6("pred")} AS pred, {r6("y - pred")} AS residual FROM oof
  WHERE model = (SELECT model FROM total ORDER BY rmse, model LIMIT 1)""")
def _(t):
    return all_rounded(metrics.best_residuals(oof_of(written(t.predictions())), "row_id"))


@query("f01_strongest_columns", f"""{TRAIN_SQL}, c AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS name, corr({c}, score) AS r FROM train" for c in NUMERIC)})
  SELECT name, {r6("r")} AS r FROM c ORDER BY abs(r) DESC, name LIMIT 15""")
def _(t):
    found = profile.correlations(t.applicants("train"), NUMERIC, "score")
    return all_rounded(found.orderBy(F.abs("r").desc(), "name").limit(15))


@query("f05_best_model", f"""{OOF_SQL} SELECT model, {r6("rmse")} AS rmse FROM total ORDER BY rmse, model LIMIT 1""")
def _(t):
    scores = metrics.regression_metrics(oof_of(t.predictions()), by=["model"])
    return all_rounded(metrics.best_name(scores))


@query("g01_union_with_origin", f"""{WITH_CASES}
  SELECT split AS origin, row_id, CASE WHEN split = 'train' THEN {r6("y")} END AS y FROM cases""")
def _(t):
    train = t.cases("train").select("row_id", rounded("y").alias("y"), F.lit("train").alias("origin"))
    test = t.cases("test").select("row_id", F.lit("test").alias("origin"))
    return train.unionByName(test, allowMissingColumns=True)


@query("g02_union_of_fold_outputs", f"""{WITH_PREDS}
  SELECT row_id, repeat, model, {r6("pred")} AS pred FROM preds""")
def _(t):
    preds = written(t.predictions())
    parts = [preds.where((F.col("fold") == k) & (F.col("model") == m)).select("row_id", "repeat", "model", "pred")
             for m in MODELS for k in range(5)]
    return all_rounded(cross.union(parts))


@query("a05_a10_prediction_table_with_external", f"""{WITH_PREDS},
  ext AS (SELECT row_id, repeat, fold, 'external' AS model, y, 50 + bal / 400 AS pred
    FROM folds), every AS (SELECT row_id, repeat, fold, model, y, pred FROM preds UNION ALL SELECT * FROM ext),
  m AS (SELECT row_id, model, avg(pred) AS pred FROM every GROUP BY row_id, model)
  SELECT row_id, {", ".join(f"{r6(f'''max(pred) FILTER (WHERE model = '{m}')''')} AS {m}" for m in (*MODELS, "external"))}
  FROM m GROUP BY row_id""")
def _(t):
    ext = t.train_folds((42, 2025)).select(
        "row_id", "repeat", "fold", F.lit("external").alias("model"), "y",
        (50 + F.col("bal") / 400).alias("pred"))
    every = t.predictions().unionByName(ext)
    means = metrics.mean_predictions(every, ["row_id", "model"])
    return all_rounded(means.groupBy("row_id").pivot("model", [*MODELS, "external"]).agg(F.first("pred")))
