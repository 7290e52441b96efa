"""Quantile bins, stratified folds, repeats and inner folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise import fixed
from foldwise.catalog import query
from foldwise.catalog.bind import WITH_CASES
from foldwise.catalog.sqltext import TRAIN_CASES, bin_sql, folds_ctes, grid, inner_ctes, r6
from foldwise.functions.rows import rounded
from foldwise.operators import explain, folds
from foldwise.scratch import written


@query("w01_quantile_bins", f"""{TRAIN_CASES},
  e AS (SELECT list_distinct(quantile_cont(y, {grid(20)})) AS e20, list_distinct(quantile_cont(y, {grid(10)})) AS e10 FROM train)
  SELECT row_id, CAST({bin_sql("y", "e20")} AS INT) AS bin20, CAST({bin_sql("y", "e10")} AS INT) AS bin10
  FROM train, e""")
def _(t):
    train = t.stored_cases("train")
    df = folds.with_bins(folds.with_bins(train, "y", 20, "bin20"), "y", 10, "bin10")
    return df.select("row_id", "bin20", "bin10")


@query("w02_stratified_folds", f"""{TRAIN_CASES}, {folds_ctes("train")} SELECT row_id, fold FROM folds""")
def _(t):
    return folds.make_folds(t.stored_cases("train"), "row_id", "y", year="yr").select("row_id", "fold")


@query("w02_folds_by_hash_buckets",
       f"""{TRAIN_CASES}, {folds_ctes("train", bins=20, year=None)} SELECT row_id, fold FROM folds""")
def _(t):
    # small buckets on purpose: hot strata are cut by hash prefix
    binned = folds.with_bins(t.stored_cases("train"), "y", 20)
    return folds.assign(binned, "row_id", ["bin"], 5, 42, bucket_rows=40).select("row_id", "fold")


@query("w03_repeated_folds", f"""{TRAIN_CASES}, {folds_ctes("train", seeds=fixed.REPEAT_SEEDS)}
  SELECT row_id, repeat, fold FROM folds""")
def _(t):
    return folds.repeated_folds(t.stored_cases("train"), "row_id", "y", year="yr")


@query("w04_inner_folds", f"""{TRAIN_CASES}, {folds_ctes("train")}, {inner_ctes("folds")}
  SELECT row_id, outer_k, inner_j FROM nested""")
def _(t):
    df = written(folds.make_folds(t.stored_cases("train").select("row_id", "y", "yr"), "row_id", "y", year="yr"))
    return folds.inner_folds(df, "row_id", "y", keep=()).select(
        "row_id", F.col("outer").alias("outer_k"), F.col("inner").alias("inner_j"))


@query("w05_low_middle_high_rows", f"""{WITH_CASES},
  r AS (SELECT row_id, y, row_number() OVER (ORDER BY y, row_id) - 1 AS i, count(*) OVER () AS n FROM cases)
  SELECT 'low' AS tag, row_id, {r6("y")} AS pred FROM r WHERE i = 0
  UNION ALL SELECT 'median', row_id, {r6("y")} FROM r WHERE i = n // 2
  UNION ALL SELECT 'high', row_id, {r6("y")} FROM
    (SELECT * FROM r WHERE y = (SELECT max(y) FROM r) ORDER BY row_id LIMIT 1)""")
def _(t):
    df = t.cases().select("row_id", F.col("y").alias("pred"))
    return explain.spread_rows(df, "row_id", "pred").select("tag", "row_id", rounded("pred").alias("pred"))


@query("w07_plain_folds", """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5(concat('0:', doc_id)), doc_id) - 1 AS i
  FROM documents) SELECT doc_id, CAST(i % 5 AS INT) AS fold FROM r""")
def _(t):
    return folds.assign(t("documents").select("doc_id"), "doc_id", [], 5, 0).select("doc_id", "fold")
