"""Chart data and profiling tables that are not aggregates of one column."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise import fixed
from foldwise.catalog import query
from foldwise.catalog.aggregates import all_rounded
from foldwise.catalog.bind import WITH_APPLICANTS
from foldwise.catalog.rowwise import NUMERIC, TRAIN_SQL
from foldwise.catalog.sqltext import WITH_PREDS, r6
from foldwise.functions.rows import rounded
from foldwise.operators import folds, metrics, profile

COLS = NUMERIC


def per_column(cols, cells, src="train"):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS name, {', '.join(f'{e} AS {n}' for n, e in cells(c).items())} FROM {src}" for c in cols)


@query("m15_v07_year_mix", f"""{WITH_APPLICANTS},
  a AS (SELECT application_year AS yr, count(*) / (SELECT count(*) FROM applicants WHERE split = 'train')::DOUBLE AS p
    FROM applicants WHERE split = 'train' GROUP BY 1),
  b AS (SELECT application_year AS yr, count(*) / (SELECT count(*) FROM applicants WHERE split = 'test')::DOUBLE AS q
    FROM applicants WHERE split = 'test' GROUP BY 1)
  SELECT coalesce(a.yr, b.yr) AS application_year, {r6("p")} AS train, {r6("q")} AS test FROM a FULL JOIN b USING (yr)""")
def _(t):
    return all_rounded(folds.year_mix(t.applicants("train"), t.applicants("test"), "application_year"))


@query("p01_overview", f"""{TRAIN_SQL} {per_column(NUMERIC + ["department", "target_role", "feedback"], lambda c: {
    "known": f"count({c})", "n_rows": "count(*)",
    "role": "'text'" if c == "feedback" else "'numeric'" if c in NUMERIC else "'categorical'"})}""")
def _(t):
    df = t.applicants("train").select(*NUMERIC, "department", "target_role", "feedback")
    return profile.overview(df, ["feedback"]).select("name", "role", "known", "n_rows")


@query("p02_null_counts", f"""{TRAIN_SQL} {per_column(NUMERIC + ["department", "feedback"], lambda c: {
    "nulls": f"count(*) - count({c})", "rate": r6(f"1 - count({c}) / count(*)::DOUBLE")})}""")
def _(t):
    return all_rounded(profile.null_table(t.applicants("train"), NUMERIC + ["department", "feedback"]))


@query("p03_duplicate_rows", f"""WITH g AS (SELECT *, count(*) AS n FROM (SELECT * EXCLUDE (doc_id) FROM documents) GROUP BY ALL)
  SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates, {r6("sum(n - 1) / sum(n)::DOUBLE")} AS ratio FROM g""")
def _(t):
    return all_rounded(profile.duplicate_rows(t("documents").drop("doc_id")))


RULES = {"graduation_after_application": "graduation_year > application_year",
         "attendance_over_100": "attendance_rate > 100", "cgpa_out_of_range": "cgpa < 0 OR cgpa > 4",
         "interviews_over_applications": "interviews_attended > applications_sent",
         "awards_over_hackathons": "hackathon_awards > hackathon_count",
         "negative_value": "cgpa < 0 OR attendance_rate < 0 OR failed_courses_count < 0 OR applications_sent < 0 "
                           "OR interviews_attended < 0 OR github_repo_count < 0 OR internship_count < 0"}


@query("p04_consistency_rules", f"""{WITH_APPLICANTS} {" UNION ALL ".join(
    f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {e}) AS violations FROM applicants" for n, e in RULES.items())}""")
def _(t):
    return profile.rule_violations(t.applicants(), profile.applicant_rules())


def moments_sql(c):
    x = f"CAST({c} AS DOUBLE)"
    m = f"(SELECT avg({x}) FROM train)"
    return {"n": f"count({c})", "mean": r6(f"avg({x})"), "median": r6(f"median({x})"),
            "std": r6(f"stddev_samp({x})"), "min": r6(f"min({x})"), "max": r6(f"max({x})"),
            "q1": r6(f"quantile_cont({x}, 0.25)"), "q3": r6(f"quantile_cont({x}, 0.75)"),
            "iqr": r6(f"quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)"),
            "skewness": r6(f"avg(power({x} - {m}, 3)) / power(var_pop({x}), 1.5)"),
            "kurtosis": r6(f"avg(power({x} - {m}, 4)) / power(var_pop({x}), 2) - 3")}


@query("p05_univariate", f"{TRAIN_SQL} {per_column(COLS, moments_sql)}")
def _(t):
    return all_rounded(profile.univariate(t.stored_applicants(*COLS), COLS))


LEVELS = [*fixed.CATEGORIES, *fixed.NOISE_CATEGORIES]


@query("p06_category_shares", f"""{TRAIN_SQL}, g AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS name, {c} AS level, count(*) AS n FROM train WHERE {c} IS NOT NULL GROUP BY {c}" for c in LEVELS)})
  SELECT name, level, n, {r6("n / sum(n) OVER (PARTITION BY name)")} AS share,
    count(*) OVER (PARTITION BY name) AS n_levels FROM g""")
def _(t):
    return all_rounded(profile.category_shares(t.applicants("train"), LEVELS))


PAIRS = [(a, b) for i, a in enumerate(COLS) for b in COLS[i + 1:]]


@query("p07_correlation_matrix", f"""{TRAIN_SQL} {" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr({a}, {b})')} AS r FROM train" for a, b in PAIRS)}""")
def _(t):
    return all_rounded(profile.correlation_matrix(t.stored_applicants(*COLS), COLS))


@query("p07_strongest_pairs", f"""{TRAIN_SQL}, m AS ({" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr({a}, {b})')} AS r FROM train" for a, b in PAIRS)}),
  s AS (SELECT *, CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS side FROM m WHERE isfinite(r) AND r <> 0)
  SELECT a, b, r, side, CAST(row_number() OVER (PARTITION BY side ORDER BY abs(r) DESC, a, b) AS INT) AS place FROM s
  QUALIFY row_number() OVER (PARTITION BY side ORDER BY abs(r) DESC, a, b) <= 10""")
def _(t):
    return profile.strongest_pairs(all_rounded(profile.correlation_matrix(t.stored_applicants(*COLS), COLS)))


def spearman_sql(c):
    return f"""SELECT '{c}' AS name, {r6("corr(rx, ry)")} AS rho FROM (
    SELECT (rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0)::DOUBLE AS rx,
      (rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0)::DOUBLE AS ry
    FROM train WHERE {c} IS NOT NULL)"""


@query("p07_spearman", f"{TRAIN_SQL} {' UNION ALL '.join(spearman_sql(c) for c in COLS)}")
def _(t):
    return all_rounded(profile.spearman(t.applicants("train"), COLS, "score"))


@query("p08_target_by_category", f"""{TRAIN_SQL}
  SELECT target_role, count(score) AS n, {r6("avg(score)")} AS mean, {r6("median(score)")} AS median
  FROM train GROUP BY target_role""")
def _(t):
    return all_rounded(profile.target_by_category(t.stored_applicants("target_role", "score"), "target_role", "score"))


def outlier_sql(c):
    q1, q3 = (f"(SELECT quantile_cont(CAST({c} AS DOUBLE), {p}) FROM train)" for p in (0.25, 0.75))
    out = f"({c} < {q1} - 1.5 * ({q3} - {q1}) OR {c} > {q3} + 1.5 * ({q3} - {q1}))"
    z = f"abs({c} - (SELECT avg({c}) FROM train)) > 3 * (SELECT stddev_samp({c}) FROM train)"
    return {"iqr_count": f"count(*) FILTER (WHERE {out})", "z_count": f"count(*) FILTER (WHERE {z})",
            "iqr_ratio": r6(f"count(*) FILTER (WHERE {out}) / count({c})::DOUBLE"),
            "z_ratio": r6(f"count(*) FILTER (WHERE {z}) / count({c})::DOUBLE"),
            "outlier_target_mean": r6(f"avg(score) FILTER (WHERE {out})")}


@query("p11_outliers", f"{TRAIN_SQL} {per_column(COLS, outlier_sql)}")
def _(t):
    return all_rounded(profile.outliers(t.stored_applicants(*COLS, "score"), COLS, "score"))


@query("p10_inflation_factors")
def _(t):
    return all_rounded(profile.inflation_factors(t.stored_applicants(*COLS), COLS), digits=4)


THREE = ("coding_score", "sql_score", "presentation_score")


def vif_sql(i):
    a, b, c = (THREE[(i + j) % 3] for j in range(3))
    corr = lambda x, y: f"corr({x}, {y})"
    r2 = (f"(power({corr(a, b)}, 2) + power({corr(a, c)}, 2) - 2 * {corr(a, b)} * {corr(a, c)} * {corr(b, c)})"
          f" / (1 - power({corr(b, c)}, 2))")
    return f"SELECT '{a}' AS name, {r6(f'1 / (1 - {r2})', 4)} AS vif FROM whole"


@query("p10_inflation_of_three", f"""{TRAIN_SQL}, whole AS (SELECT {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in THREE)}
  FROM train WHERE {" AND ".join(f"{c} IS NOT NULL" for c in THREE)}) {" UNION ALL ".join(vif_sql(i) for i in range(3))}""")
def _(t):
    return all_rounded(profile.inflation_factors(t.stored_applicants(*THREE), THREE), digits=4).select("name", "vif")


def mi_bin(c):
    e = f"(SELECT list_distinct(quantile_cont(CAST({c} AS DOUBLE), [{', '.join(f'{i}.0/10' for i in range(11))}])) FROM train)"
    return f"CASE WHEN {c} IS NULL THEN -1 ELSE greatest(len(list_filter(list_sort({e})[2:-2], lambda q: q < {c})), 0) END"


def mi_sql(c):
    return f"""SELECT '{c}' AS name, {r6("sum(n / t * ln(n * t / (nx * ny)))")} AS mi FROM (
    SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY bx) AS nx, sum(n) OVER (PARTITION BY b_y) AS ny
    FROM (SELECT {mi_bin(c)} AS bx, {mi_bin("score")} AS b_y, count(*)::DOUBLE AS n FROM train GROUP BY 1, 2))"""


@query("p12_mutual_information", f"{TRAIN_SQL} {' UNION ALL '.join(mi_sql(c) for c in COLS)}")
def _(t):
    return all_rounded(profile.mutual_information(t.stored_applicants(*COLS, "score"), COLS, "score"))


@query("p15_fractional_ranks", f"""{TRAIN_SQL}
  SELECT student_id, {r6("(rank() OVER (ORDER BY applications_sent) + (count(*) OVER (PARTITION BY applications_sent) - 1) / 2.0) / (SELECT count(*) FROM train)")} AS rank
  FROM train""")
def _(t):
    made = profile.fractional_ranks(t.applicants("train"), "student_id", "applications_sent", "rank")
    return made.select("student_id", rounded("rank").alias("rank"))


@query("v07_actual_against_predicted", f"""{WITH_PREDS}, oof AS (SELECT row_id, model, max(y) AS y, avg(pred) AS pred FROM preds GROUP BY 1, 2)
  SELECT model, CAST(floor(y / 5) AS INT) AS cell, count(*) AS n, {r6("avg(y)")} AS mean_actual, {r6("avg(pred)")} AS mean_pred,
    {r6("stddev_samp(pred)")} AS sd_pred FROM oof GROUP BY 1, 2""")
def _(t):
    means = metrics.mean_predictions(t.predictions(), ["row_id", "model", "y"])
    return all_rounded(profile.actual_against_predicted(means, by=["model"]))
