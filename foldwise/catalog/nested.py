"""Leak-free nested features and fold views."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.catalog import query
from foldwise.catalog.sqltext import TRAIN_CASES, WEIGHT_CTES, folds_ctes, inner_ctes, r6
from foldwise.functions.rows import rounded
from foldwise.operators import cross, encode, folds, metrics
from foldwise.scratch import written


def te_sql(col, name):
    return f"""{name} AS (
    SELECT row_id, outer_k, yr, y, inner_j, {col} AS cat,
      coalesce(sum(y) FILTER (WHERE inner_j >= 0) OVER (PARTITION BY outer_k, {col}), 0)
        - CASE WHEN inner_j >= 0 THEN sum(y) OVER (PARTITION BY outer_k, inner_j, {col}) ELSE 0 END AS s,
      count(*) FILTER (WHERE inner_j >= 0) OVER (PARTITION BY outer_k, {col})
        - CASE WHEN inner_j >= 0 THEN count(*) OVER (PARTITION BY outer_k, inner_j, {col}) ELSE 0 END AS n,
      sum(y) FILTER (WHERE inner_j >= 0) OVER (PARTITION BY outer_k)
        - CASE WHEN inner_j >= 0 THEN sum(y) OVER (PARTITION BY outer_k, inner_j) ELSE 0 END AS ps,
      count(*) FILTER (WHERE inner_j >= 0) OVER (PARTITION BY outer_k)
        - CASE WHEN inner_j >= 0 THEN count(*) OVER (PARTITION BY outer_k, inner_j) ELSE 0 END AS pn
    FROM nested)"""


TE = "(s + ps / pn * 20) / (n + 20)"
NESTED = f"{TRAIN_CASES}, {folds_ctes('train')}, {inner_ctes('folds')}"


def nested_rows(t, *keep):
    """Training rows in all fold roles, with the columns ``keep``; no other column is copied five times."""
    train = t.stored_cases("train").select(*dict.fromkeys(["row_id", "y", "yr", *keep]))
    df = written(folds.make_folds(train, "row_id", "y", year="yr"))
    return written(folds.inner_folds(df, "row_id", "y", keep=keep))


@query("m02_nested_target_encoding", f"""{NESTED}, {te_sql("grp", "te")}
  SELECT row_id, outer_k, {r6(TE)} AS value FROM te""")
def _(t):
    values = encode.nested_means(nested_rows(t, "grp"), "row_id", "grp", "y")
    return values.select("row_id", F.col("outer").alias("outer_k"), rounded("value").alias("value"))


@query("m02_nested_encoding_quality", f"""{NESTED}, {te_sql("grp", "te")}, {WEIGHT_CTES}
  SELECT outer_k AS fold, {r6("avg((y - p) * (y - p))")} AS mse, {r6("sqrt(avg((y - p) * (y - p)))")} AS rmse,
    {r6("avg(abs(y - p))")} AS mae, {r6("1 - avg((y - p) * (y - p)) / var_pop(y)")} AS r2,
    {r6("sum(w * (y - p) * (y - p)) / sum(w)")} AS wmse, {r6("sqrt(sum(w * (y - p) * (y - p)) / sum(w))")} AS wrmse
  FROM (SELECT *, {TE} AS p FROM te WHERE inner_j = -1) JOIN weights USING (row_id) GROUP BY outer_k""")
def _(t):
    nested = nested_rows(t, "grp", "yr")
    values = encode.nested_means(nested, "row_id", "grp", "y")
    held = (nested.where("inner = -1").select("row_id", "outer", "yr", "y")
            .join(values, ["row_id", "outer"]).withColumnsRenamed({"value": "pred", "outer": "fold"}))
    weighted = folds.year_weights(held, t.stored_cases("test"), "yr")
    scored = metrics.regression_metrics(weighted, w="w", by=["fold"])
    return scored.select("fold", *[rounded(c).alias(c) for c in scored.columns if c != "fold"])


@query("m03_fold_view_with_nested_columns", f"""{NESTED}, {te_sql("grp", "tg")}, {te_sql("dept", "td")}
  SELECT row_id, outer_k AS fold, CAST(tg.inner_j = -1 AS INT) AS held,
    {r6("(tg.s + tg.ps / tg.pn * 20) / (tg.n + 20)")} AS te_grp,
    {r6("(td.s + td.ps / td.pn * 20) / (td.n + 20)")} AS te_dept
  FROM tg JOIN td USING (row_id, outer_k)""")
def _(t):
    nested = nested_rows(t, "grp", "dept")
    dyn = cross.dynamic_table({f"te_{c}": encode.nested_means(nested, "row_id", c, "y")
                               for c in ("grp", "dept")}, "row_id")
    dyn = cross.wide_dynamic(dyn, "row_id", ["te_grp", "te_dept"])  # one pass, read by fold
    static = written(nested.where("inner = -1").select("row_id", "fold").distinct())  # every row is held out once
    views = []
    for k in range(5):
        train, held = cross.fold_view(static, dyn, "row_id", k, ["te_grp", "te_dept"])
        both = train.withColumn("held", F.lit(0)).unionByName(held.withColumn("held", F.lit(1)))
        views.append(both.select("row_id", F.lit(k).alias("fold"), "held", rounded("te_grp").alias("te_grp"),
                                 rounded("te_dept").alias("te_dept")))
    return cross.union(views)
