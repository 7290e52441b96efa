"""What jobs leave behind and take in: sinks, saved parameters, budgets, outside models, own combiners."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foldwise import fixed
from foldwise.catalog import query
from foldwise.catalog.aggregates import all_rounded
from foldwise.catalog.combining import CANDIDATES, REF_FOLDS, WIDE, oof_table
from foldwise.catalog.sqltext import MODELS, TRAIN_CASES, folds_ctes, r6
from foldwise.functions.rows import rounded
from foldwise.operators import ensemble, folds, metrics
from foldwise.scratch import scratch_root
from foldwise.sources import records
from foldwise.sources.tables import write_submission
from foldwise.spec import BUDGETS


def folder(t, name):
    return f"{scratch_root(t.spark)}/{name}-{uuid.uuid4().hex}"


@query("a02_score_sinks", f"""{WIDE} SELECT CAST(row_id AS VARCHAR) AS row_id, {r6("by_group")} AS from_csv, {r6("by_group")} AS from_parquet
  FROM oof""")
def _(t):
    scored, path = oof_table(t).select("row_id", F.col("by_group").alias("pred")), folder(t, "sink")
    for fmt in ("csv", "parquet"):
        write_submission(scored, "row_id", "pred", f"from_{fmt}", f"{path}/{fmt}", fmt)
    csv = t.spark.read.schema("row_id string, from_csv double").option("header", True).csv(f"{path}/csv")
    stored = t.spark.read.parquet(f"{path}/parquet").select(F.col("row_id").cast("string").alias("row_id"), "from_parquet")
    return all_rounded(csv.join(stored, "row_id"))


SHARES = (0.0, 0.25, 0.5, 0.75, 1.0)
MIXED = "(share * {m} + (1 - share) * overall)"


@query("a11_best_parameters_reused", f"""{WIDE}, grid AS (SELECT CAST(unnest({list(SHARES)}) AS DOUBLE) AS share),
  tried AS ({" UNION ALL ".join(
    f"SELECT '{m}' AS model, share, sum(w * (y - {MIXED.format(m=m)}) ** 2) / sum(w) AS wmse FROM oof, grid GROUP BY share" for m in MODELS[:2])}),
  best AS (SELECT model, share FROM tried QUALIFY row_number() OVER (PARTITION BY model ORDER BY wmse, share) = 1)
  {" UNION ALL ".join(f"SELECT row_id, model, share, {r6(MIXED.format(m=m))} AS pred FROM oof, best WHERE model = '{m}'" for m in MODELS[:2])}""")
def _(t):
    df, path = oof_table(t), folder(t, "params")
    mixes = {f"{m}__{i}": F.lit(s) * F.col(m) + F.lit(1 - s) * F.col("overall") for m in MODELS[:2] for i, s in enumerate(SHARES)}
    tried = df.withColumns(mixes).agg(*[metrics.weighted_mse("y", c, "w").alias(c) for c in mixes]).first()
    best = {m: {"share": SHARES[min(range(len(SHARES)), key=lambda i, m=m: tried[f"{m}__{i}"])]} for m in MODELS[:2]}
    records.save_params(t.spark, best, path)
    saved = records.saved_params(t.spark, path)  # what a later run does
    parts = []
    for m in MODELS[:2]:
        share = records.params_or_default(saved, {m: {"share": 1.0}}, m)["share"]
        mixed = F.lit(share) * F.col(m) + F.lit(1 - share) * F.col("overall")
        parts.append(df.select("row_id", F.lit(m).alias("model"), F.lit(share).alias("share"), rounded(mixed).alias("pred")))
    return parts[0].unionByName(parts[1])


def _budget_sql(name):
    b = BUDGETS[name]
    return f"SELECT '{name}' AS budget, CAST(repeat AS INT) AS repeat, fold, count(*) AS n, {r6('avg(y)')} AS mean_y FROM folds{name} GROUP BY repeat, fold"


@query("m18_folds_by_budget", f"""{TRAIN_CASES}, {", ".join(
    folds_ctes("train", tag=n, splits=b.folds, seeds=fixed.REPEAT_SEEDS[:b.repeats]) for n, b in BUDGETS.items())}
  {" UNION ALL ".join(_budget_sql(n) for n in BUDGETS)}""")
def _(t):
    train, parts = t.stored_cases("train"), []
    for name, budget in BUDGETS.items():
        dealt = folds.repeated_folds(train, "row_id", "y", fixed.REPEAT_SEEDS[:budget.repeats], budget.folds, "yr")
        parts.append(train.join(dealt, "row_id").groupBy(F.lit(name).alias("budget"), "repeat", "fold").agg(
            F.count(F.lit(1)).alias("n"), rounded(F.avg("y")).alias("mean_y")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


OUTSIDE = "0.9 * by_group + 5"
WITH_OUTSIDE = {**{k: v for k, v in CANDIDATES.items() if k.startswith("single_")}, "single_outside": OUTSIDE,
                "blend_equal": f"(by_group + by_year + overall + {OUTSIDE}) / 4"}


@query("v09_outside_model_in_referee", f"""{WIDE}, {REF_FOLDS},
  cells AS ({" UNION ALL ".join(
    f"SELECT '{n}' AS method, sum(w * (o.y - ({e})) * (o.y - ({e}))) / sum(w) AS wmse "
    f"FROM oof o JOIN (SELECT row_id, repeat, fold FROM foldsr) USING (row_id) GROUP BY repeat, fold"
    for n, e in WITH_OUTSIDE.items())})
  SELECT method, {r6("avg(wmse)", 4)} AS wmse FROM cells GROUP BY method""")
def _(t):
    df = oof_table(t)
    outside = df.select(F.col("row_id").alias("id"), (F.col("by_group") * 0.9 + 5).alias("outside"))  # another tool's table
    joined = df.join(outside, F.col("row_id") == F.col("id")).drop("id")
    scores = ensemble.honest_comparison(joined, "row_id", [*MODELS, "outside"], "y", "w", boosted=False)
    return all_rounded(ensemble.referee_means(scores.where(F.col("method").isin(list(WITH_OUTSIDE)))), digits=4)


def inverse_error(df, names, extra, y, w, rounds):
    """A combiner of one's own: weights in proportion to one over the weighted squared error."""
    row = df.agg(*[metrics.weighted_mse(y, n, w).alias(n) for n in names]).first()
    total = sum(1 / row[n] for n in names)
    return ensemble.Linear(names, [1 / row[n] / total for n in names], kind="inverse_error")


@query("u03_own_combiner", f"""{WIDE}, e AS (SELECT {", ".join(f"sum(w) / sum(w * (y - {m}) * (y - {m})) AS i_{m}" for m in MODELS)} FROM oof)
  SELECT row_id, {r6(f"({' + '.join(f'i_{m} * {m}' for m in MODELS)}) / ({' + '.join(f'i_{m}' for m in MODELS)})")} AS pred FROM oof, e""")
def _(t):
    df = oof_table(t)
    ensemble.COMBINERS["inverse_error"] = inverse_error
    try:
        made = ensemble.fit_combiner("inverse_error", df, MODELS, "y", "w")
    finally:
        del ensemble.COMBINERS["inverse_error"]
    return all_rounded(made.predict(df).select("row_id", "pred"))


LOG_FROM, LOG_TO, POINTS = fixed.RIDGE_STACK_ALPHAS
DETERMINANT = "((c11 + a) * (c22 + a) - c12 * c12)"


@query("e03_e08_ridge_stack_of_one_model_and_year", f"""{WIDE},
  u AS (SELECT sum(w * by_group) / sum(w) AS m1, sum(w * yr) / sum(w) AS m2, sum(w * y) / sum(w) AS mt,
    stddev_pop(by_group) + 1e-9 AS s1, stddev_pop(yr) + 1e-9 AS s2, sum(w) AS sw FROM oof),
  z AS (SELECT row_id, w, y - mt AS d, (by_group - m1) / s1 AS z1, (yr - m2) / s2 AS z2, mt, sw FROM oof, u),
  c AS (SELECT sum(w * z1 * z1) AS c11, sum(w * z1 * z2) AS c12, sum(w * z2 * z2) AS c22, sum(w * z1 * d) AS b1, sum(w * z2 * d) AS b2 FROM z),
  grid AS (SELECT k, pow(10.0, {LOG_FROM} + k * ({LOG_TO} - {LOG_FROM}) / {POINTS - 1}) AS a FROM range({POINTS}) AS g(k)),
  fits AS (SELECT k, a, c.*, {DETERMINANT} AS det, ((c22 + a) * b1 - c12 * b2) / {DETERMINANT} AS k1,
    ((c11 + a) * b2 - c12 * b1) / {DETERMINANT} AS k2 FROM grid, c),
  loo AS (SELECT k, sum(w * ((d - k1 * z1 - k2 * z2) / (1 - w * (1 / sw
      + ((c22 + a) * z1 * z1 - 2 * c12 * z1 * z2 + (c11 + a) * z2 * z2) / det))) ** 2) AS err FROM z, fits GROUP BY k),
  best AS (SELECT k FROM loo ORDER BY err, k LIMIT 1)
  SELECT row_id, {r6("mt + k1 * z1 + k2 * z2", 4)} AS pred FROM z, fits JOIN best USING (k)""")
def _(t):
    df = oof_table(t)
    stack = ensemble.fit_combiner("stack_ridge", df, ["by_group"], "y", "w", ["yr"])
    return all_rounded(stack.predict(df).select("row_id", "pred"), digits=4)
