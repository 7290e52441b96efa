"""Learners, cross-validation, nested learners and the two-part model.

Folds are the full five by four, tables are always whole; trees have few rounds here.
"""

from __future__ import annotations

import uuid

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from foldwise import fixed
from foldwise.catalog import query
from foldwise.catalog.aggregates import all_rounded
from foldwise.catalog.bind import WITH_CASES
from foldwise.catalog.sqltext import TRAIN_CASES, r6
from foldwise.functions.rows import rounded
from foldwise.functions.vectors import unit
from foldwise.operators import (cross, features, folds, hurdle, learners, metrics, neighbors, reduce,
                                textlearn, tfidf)
from foldwise.scratch import scratch_root, written

SMALL = {"boosted": {"rounds": 6, "depth": 3, "leaf": 10},
         "forest": {"trees": 8, "depth": 5},
         "factor": {"rounds": 15, "factors": 2},
         "ridge": {"alpha": 2.0}}
SPLITS = 5
INNER = 4


def numeric_names(t):
    return features.numeric_columns(t.applicants("train"), ("student_id", "score"))


def bundle(t, names=None, weight=False, test=False):
    """Numeric columns of the applicants with five folds."""
    names = names or numeric_names(t)
    train = t.stored_applicants(*dict.fromkeys(["student_id", "score", "application_year", *names]))
    dealt = written(folds.repeated_folds(train, "student_id", "score", (fixed.SEED,), SPLITS,
                                         "application_year"))
    if weight:
        train = folds.year_weights(train, t.applicants("test"), "application_year")
    return cross.Bundle(train, dealt, "student_id", "score", list(names), weight="w" if weight else None,
                        test=t.applicants("test") if test else None, splits=SPLITS)


def unit_documents(t, target="n_chars"):
    return t("documents").withColumn("y", F.col(target).cast("double"))


# ------------------------------------------------------------- reduced dimensions
@query("t07_svd_of_tfidf")
def _(t):
    docs = t("documents")
    made = tfidf.fit_vectoriser(docs, "doc_id", "text", [tfidf.WORDS])
    cells = written(made.cells(docs, "doc_id", "text"))
    basis = reduce.fit_cells_svd(cells, made.width)
    return all_rounded(basis.transform(cells, "doc_id"), digits=4)


@query("t08_pca_of_embeddings")
def _(t):
    model = reduce.fit_pca(t("embeddings"), "embedding")
    return all_rounded(model.transform(t("embeddings")).drop("embedding"), digits=4)


def _power_sql(k):
    """One round: every word becomes the weighted sum of its neighbours' vectors, of length one."""
    start = "CASE WHEN substr(md5(b), j + 1, 1) < '8' THEN 1.0 ELSE -1.0 END"
    source = "ppmi, range(16) AS r(j)" if k == 1 else f"ppmi JOIN v{k - 1} ON v{k - 1}.word = b"
    return f"""s{k} AS (SELECT a AS word, j, sum(m * {start if k == 1 else 'x'}) AS x FROM {source} GROUP BY a, j),
  v{k} AS (SELECT word, j, x / coalesce(nullif(sqrt(sum(x * x) OVER (PARTITION BY word)), 0), 1) AS x FROM s{k})"""


@query("t09_a09_cached_text_vectors", f"""WITH toks AS (SELECT conv_id, turn,
    regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM conversations WHERE text IS NOT NULL),
  near AS (SELECT unnest(list_concat(
    list_transform(range(1, greatest(len(t), 1)), lambda i: {{'a': t[i], 'b': t[i + 1]}}),
    list_transform(range(1, greatest(len(t) - 1, 1)), lambda i: {{'a': t[i], 'b': t[i + 2]}}))) AS p FROM toks),
  pairs AS (SELECT a, b, count(*) AS n FROM (SELECT p.a AS a, p.b AS b FROM near UNION ALL SELECT p.b, p.a FROM near) GROUP BY a, b),
  words AS (SELECT a AS word, sum(n)::DOUBLE AS n FROM pairs GROUP BY a),
  whole AS (SELECT sum(n) AS total FROM words),
  ppmi AS (SELECT a, b, ln(p.n * total / (x.n * y.n)) AS m FROM pairs p JOIN words x ON x.word = a JOIN words y ON y.word = b, whole
    WHERE ln(p.n * total / (x.n * y.n)) > 0),
  {_power_sql(1)}, {_power_sql(2)},
  weighted AS (SELECT v2.word, j, x * 0.001 / (0.001 + n / total) AS x FROM v2 JOIN words ON words.word = v2.word, whole),
  said AS (SELECT conv_id, turn, unnest(t) AS word FROM toks),
  sums AS (SELECT conv_id, turn, j, sum(x) AS x FROM said JOIN weighted USING (word) GROUP BY conv_id, turn, j),
  scaled AS (SELECT conv_id, turn, j, x / coalesce(nullif(sqrt(sum(x * x) OVER (PARTITION BY conv_id, turn)), 0), 1) AS x FROM sums)
  SELECT conv_id, turn, CAST(j AS INT) AS j, {r6("x")} AS x FROM scaled""")
def _(t):
    talks = t("conversations").where("text is not null")
    model = reduce.fit_text_vectors(talks, "text", dims=16)
    path = f"{scratch_root(t.spark)}/vectors-{folder_tag()}"
    from foldwise.sources.records import cached_results
    made = cached_results(talks, "text", lambda fresh: model.transform(fresh), path)
    known = made.where(F.exists("embedding", lambda x: x != 0))
    return known.select("conv_id", "turn", F.posexplode("embedding").alias("j", "x")).withColumn("x", rounded("x"))


def folder_tag() -> str:
    return uuid.uuid4().hex


# ---------------------------------------------------------------------- learners
RIDGE = """m AS (SELECT avg(bal) AS mb, avg(yr) AS my, avg(y) AS mt, count(*) AS n FROM train),
  s AS (SELECT sum((bal - mb) * (bal - mb)) + 2.0 AS bb, sum((yr - my) * (yr - my)) + 2.0 AS yy,
    sum((bal - mb) * (yr - my)) AS by_, sum((bal - mb) * (y - mt)) AS bt, sum((yr - my) * (y - mt)) AS yt
    FROM train, m),
  k AS (SELECT (bt * yy - yt * by_) / (bb * yy - by_ * by_) AS cb,
    (yt * bb - bt * by_) / (bb * yy - by_ * by_) AS cy FROM s)"""


def two_column_ridge(t):
    train = t.cases("train").withColumn(
        "features", learners.Inputs(["bal", "yr"], {}).vector())
    return learners.fit_ridge(train, "y", 2.0)


@query("m06_ridge_two_columns", f"""{TRAIN_CASES}, {RIDGE}
  SELECT row_id, {r6("mt + cb * (bal - mb) + cy * (yr - my)")} AS pred FROM cases, m, k""")
def _(t):
    model = two_column_ridge(t)
    df = t.cases().withColumn("features", learners.Inputs(["bal", "yr"], {}).vector())
    return model.transform(df).select("row_id", rounded("prediction").alias("pred"))


@query("m04_m05_m07_m08_learner_registry")
def _(t):
    b = bundle(t)
    scores = [(name, cross.quick_score(b, name, SMALL[name])) for name in learners.LEARNERS]
    return t.spark.createDataFrame(scores, "model string, mse double")


@query("m09_repeated_cross_validation")
def _(t):
    b = bundle(t, weight=True, test=True)
    preds, test, _ = cross.cross_validate(b, "boosted", SMALL["boosted"], 1)
    scored = metrics.fold_metrics(preds, "score", "pred", "w")
    n, mean = test.agg(F.count("pred"), F.avg("pred")).first()
    return scored.withColumns({"n_test": F.lit(n), "test_mean": F.lit(mean)})


@query("m10_random_search")
def _(t):
    b = bundle(t)
    path = f"{scratch_root(t.spark)}/trials-{folder_tag()}"

    def score(params, k):
        _, pred = cross.fit_fold(b, "ridge", params, 0, k)
        return pred.agg(metrics.weighted_mse("score", "pred")).first()[0]
    cross.search(t.spark, "ridge", learners.LEARNERS["ridge"].space, score, SPLITS, 2, 600, path)
    found = cross.search(t.spark, "ridge", learners.LEARNERS["ridge"].space, score, SPLITS, 3, 600, path)
    return found.select("model", "trial", "state", "value")


@query("m11_ceiling_chance")
def _(t):
    b = bundle(t)
    df = b.static.join(b.folds, "student_id")
    oof, test, _ = hurdle.ceiling_chance(df, "student_id", "score", b.names, SPLITS,
                                         test=t.applicants("test"), rounds=4, depth=3)
    return oof.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query("m12_isotonic_calibration", f"""{WITH_CASES},
  g AS (SELECT n_items AS s, sum(CAST(y >= 60 AS INT))::DOUBLE AS h, count(*)::DOUBLE AS n
    FROM cases WHERE n_items IS NOT NULL GROUP BY n_items),
  spans AS (SELECT a.s AS lo, b.s AS hi, sum(c.h) / sum(c.n) AS v
    FROM g a JOIN g b ON a.s <= b.s JOIN g c ON c.s BETWEEN a.s AND b.s GROUP BY a.s, b.s),
  inner_min AS (SELECT x.s, p.lo, min(p.v) AS v FROM g x JOIN spans p ON p.lo <= x.s AND p.hi >= x.s GROUP BY x.s, p.lo),
  iso AS (SELECT s, max(v) AS p FROM inner_min GROUP BY s)
  SELECT row_id, {r6("p")} AS p FROM cases JOIN iso ON n_items = s""")
def _(t):
    df = t.cases().where("n_items is not null").withColumn("hit", (F.col("y") >= 60).cast("int"))
    model = hurdle.fit_calibration(df, "n_items", "hit")
    return model.transform(df, "n_items", "p").select("row_id", rounded("p").alias("p"))


@query("m13_two_part_combination", f"""{TRAIN_CASES},
  g AS (SELECT grp AS k, avg(CAST(y >= 100 AS INT)) AS p, avg(y) FILTER (WHERE y < 100) AS below FROM train GROUP BY grp)
  SELECT row_id, {r6("least(greatest((1 - p) * least(greatest(below, 0), 100) + p * 100, 0), 100)")} AS pred
  FROM cases JOIN g ON grp = k""")
def _(t):
    from foldwise.operators import encode
    from foldwise.scratch import fitted
    train = t.cases("train")
    parts = fitted(train.groupBy("grp").agg(
        F.avg(hurdle.at_ceiling("y").cast("int")).alias("p"),
        F.avg(F.when(~hurdle.at_ceiling("y"), F.col("y"))).alias("below")))
    df = encode.lookup(t.cases(), parts, "grp", how="inner")
    return df.select("row_id", rounded(hurdle.combine("p", "below")).alias("pred"))


@query("m13_two_part_study")
def _(t):
    b = bundle(t, weight=True)
    df = b.static.join(b.folds, "student_id")
    study = hurdle.hurdle_study(df, "student_id", "score", b.names, SPLITS, weight="w",
                                params=SMALL["boosted"], rounds=4, depth=3)
    chance = metrics.auc(study, "p", "hit").first()["auc"]
    return hurdle.hurdle_scores(study, "score", "w").withColumn("auc", F.lit(chance))


@query("m14_adversarial_auc")
def _(t):
    from foldwise.operators.drift import drift_auc
    both = t.applicants()
    names = features.numeric_columns(both, ("student_id", "score"))
    return drift_auc(both.where("split = 'train'"), both.where("split = 'test'"), "student_id",
                     names, splits=SPLITS, rounds=4, depth=3)


# ------------------------------------------------------------------ nested columns
@query("m01_nested_learner_column")
def _(t):
    b = bundle(t)
    train = b.static.join(b.folds.where("repeat = 0").select("student_id", "fold"), "student_id")
    names = ["project_quality_score", "technical_interview_score", "presentation_score"]

    def build(fit):
        model = learners.fit("ridge", {"alpha": 1.0}, fit, "student_id", "score", names)
        return lambda rows: model.predict(rows, out="value")
    values, test = cross.nested_feature(train, build, "student_id", "score", splits=SPLITS, inner=INNER,
                                        test=t.applicants("test"))
    return values.unionByName(test.withColumn("outer", F.lit(-1)))


@query("t10_nested_ridge_on_tfidf")
def _(t):
    docs = unit_documents(t)
    made = tfidf.fit_vectoriser(docs, "doc_id", "text", [tfidf.WORDS])
    vectors = made.vectors(docs, "doc_id", "text").join(docs.select("doc_id", "y"), "doc_id")
    train = written(folds.make_folds(vectors, "doc_id", "y", SPLITS))
    return textlearn.nested_ridge(train, "doc_id", "y", fixed.TFIDF_RIDGE_ALPHA, 100, SPLITS, INNER)


def text_ridge(alpha, rounds=100, id_col="doc_id", solver="iterative"):
    def build(fit):
        model = learners.fit_ridge(fit, "y", alpha, solver=solver, rounds=rounds)
        return lambda rows: model.transform(rows).select(id_col, F.col("prediction").alias("value"))
    return build


@query("t10_nested_neighbours_on_embeddings")
def _(t):
    df = t("embeddings").select("vec_id", "embedding", F.col("label").cast("double").alias("y"))
    train = folds.assign(df, "vec_id", [], SPLITS, 0)
    return neighbors.nested_neighbours(train, "vec_id", "embedding", "y", splits=SPLITS, inner=INNER)


@query("t10_nested_ridge_on_embeddings")
def _(t):
    df = t("embeddings").select("vec_id", F.col("label").cast("double").alias("y"),
                                vector_of("embedding").alias("features"))
    train = written(folds.make_folds(df, "vec_id", "y", SPLITS))
    values, _ = cross.nested_feature(train, text_ridge(fixed.EMBED_RIDGE_ALPHA, id_col="vec_id", solver="exact"),
                                     "vec_id", "y", splits=SPLITS, inner=INNER)
    return values


def vector_of(c):
    return array_to_vector(unit(c))


@query("t11_text_representation_bakeoff")
def _(t):
    from foldwise.operators.textlearn import compare_representations
    docs = written(folds.make_folds(unit_documents(t), "doc_id", "y", SPLITS))
    made = tfidf.fit_vectoriser(docs, "doc_id", "text", [tfidf.WORDS])
    sparse = made.vectors(docs, "doc_id", "text")
    dense = reduce.fit_text_vectors(docs, "text", dims=16).transform(docs).select(
        "doc_id", vector_of("embedding").alias("features"))
    return compare_representations(
        docs, {"tfidf_word": (sparse, fixed.TFIDF_RIDGE_ALPHA, "iterative"),
               "word_vectors": (dense, fixed.EMBED_RIDGE_ALPHA, "exact")},
        "doc_id", "y", SPLITS, rounds=100)


@query("t12_text_signal")
def _(t):
    from foldwise.operators.textlearn import text_signal
    r2, terms = text_signal(unit_documents(t), "doc_id", "text", "y", splits=SPLITS, rounds=100)
    return terms.withColumn("oof_r2", F.lit(r2))


# ---------------------------------------------------------------- imputation by k
@query("b25_neighbour_imputation", f"""{TRAIN_CASES},
  q AS (SELECT DISTINCT bal, avg_qty, max_tax, n_items FROM cases WHERE avg_qty IS NULL),
  d AS (SELECT q.bal AS qb, t.row_id, t.avg_qty, t.max_tax, t.n_items, (q.bal - t.bal) * (q.bal - t.bal) * 4 AS dist
    FROM q, train t WHERE t.avg_qty IS NOT NULL),
  r AS (SELECT *, row_number() OVER (PARTITION BY qb ORDER BY dist, row_id) AS rk FROM d),
  f AS (SELECT qb, avg(avg_qty) AS fq, avg(max_tax) AS ft, avg(CAST(n_items AS DOUBLE)) AS fn FROM r WHERE rk <= 10 GROUP BY qb)
  SELECT row_id, {r6("bal")} AS bal, {r6("coalesce(avg_qty, fq)")} AS avg_qty, {r6("coalesce(max_tax, ft)")} AS max_tax,
    {r6("coalesce(n_items, fn)")} AS n_items FROM cases LEFT JOIN f ON avg_qty IS NULL AND bal = qb""")
def _(t):
    cols = ["bal", "avg_qty", "max_tax", "n_items"]
    cases = written(t.cases().select("row_id", *cols, "split"))  # read several times
    filled = neighbors.knn_impute(cases.drop("split"), cases.where("split = 'train'"), "row_id", cols)
    return all_rounded(filled.select("row_id", *cols))

