"""Scans, projections and row features."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foldwise import fixed
from foldwise.catalog import query
from foldwise.catalog.bind import NOT_FEATURES, SPEC, WITH_APPLICANTS, WITH_CASES
from foldwise.catalog.sqltext import r6
from foldwise.functions import rows as R
from foldwise.functions import text as X
from foldwise.operators import encode, features
from foldwise.scratch import scratch_root, written
from foldwise.sources import tables as T


# ---------------------------------------------------------------- SQL fragments
def sql_mean(cols):
    total = " + ".join(f"coalesce({c}, 0)" for c in cols)
    count = " + ".join(f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)" for c in cols)
    return f"(({total}) / nullif({count}, 0))"


def sql_std(cols):
    listed = ", ".join(f"CAST({c} AS DOUBLE)" for c in cols)
    return f"list_aggregate([{listed}], 'stddev_samp')"


def sql_match():
    whens = " ".join(f"WHEN '{r}' THEN {sql_mean(c)}" for r, c in fixed.ROLE_SKILLS.items())
    return f"(CASE target_role {whens} END)"


def pick(df, names, digits=6, key="student_id"):
    doubles = {f.name for f in df.schema if f.dataType.typeName() == "double"}
    return df.select(key, *[(R.rounded(c, digits) if c in doubles else F.col(c)).alias(c)
                            for c in names])


def applicants_sql(exprs: dict[str, str], where: str = "") -> str:
    body = ", ".join(f"{e} AS {n}" for n, e in exprs.items())
    return f"{WITH_APPLICANTS} SELECT student_id, {body} FROM applicants {where}"


# ------------------------------------------------------------------------ scans
@query("a01_train_table_null_counts", f"""{WITH_APPLICANTS}
  SELECT split, count(*) AS n_rows, count(portfolio_score) AS portfolio_known,
    count(github_avg_stars) AS stars_known, count(score) AS scored
  FROM applicants GROUP BY split""")
def _(t):
    return t.applicants().groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("portfolio_score").alias("portfolio_known"),
        F.count("github_avg_stars").alias("stars_known"), F.count("score").alias("scored"))


@query("a01_repeated_row_ids", """
  SELECT l_orderkey * 8 + l_linenumber AS line_id, count(*) AS n FROM lineitem
  GROUP BY 1 HAVING count(*) > 1""")
def _(t):
    line = t("lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_id"))
    return T.repeated_ids(line, "line_id")


@query("a03_submission", f"""{WITH_CASES}
  SELECT row_id, {r6("least(greatest(50 + bal / 100, 0), 100)")} AS y FROM cases WHERE split = 'test'""")
def _(t):
    df = t.cases("test").withColumn("pred", R.rounded(R.clip(50 + F.col("bal") / 100, *fixed.CLIP)))
    return T.submission(df, "row_id", "pred", "y")


@query("a09_texts_without_cached_result", """
  SELECT DISTINCT md5(text) AS text_key, length(text) AS n_chars FROM documents
  WHERE md5(text) NOT IN (SELECT md5(text) FROM benchmark)""")
def _(t):
    from foldwise.sources.records import uncached_texts
    cache = t("benchmark").select(F.md5("text").alias("text_key"))
    return uncached_texts(t("documents"), "text", cache).select(
        "text_key", F.char_length("text").cast("long").alias("n_chars"))


@query("a09_results_of_a_filled_cache", """
  WITH known AS (SELECT DISTINCT md5(text) AS k FROM documents JOIN labels USING (doc_id) WHERE text IS NOT NULL)
  SELECT doc_id, len(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS n_words,
    CASE WHEN text IS NULL THEN NULL WHEN md5(text) IN (SELECT k FROM known) THEN 'earlier' ELSE 'later' END AS made_by
  FROM documents""")
def _(t):
    """An earlier run has stored the results of labelled documents; a later one takes all documents and computes the others only."""
    from foldwise.sources.cache import TextCache
    cache, docs = TextCache(f"{scratch_root(t.spark)}/cache-{uuid.uuid4().hex}"), t("documents")

    def words_by(run):
        return lambda fresh: fresh.withColumns({"n_words": F.size(X.word_tokens("text")).cast("long"), "made_by": F.lit(run)})
    cache.attach(docs.join(t("labels").select("doc_id"), "doc_id"), "text", words_by("earlier"))
    return cache.attach(docs, "text", words_by("later")).select("doc_id", "n_words", "made_by")


# ------------------------------------------------------------------ projections
FAMILY_SQL = {
    "technical_strength": sql_mean(fixed.TECH_CORE),
    "engineering_strength": sql_mean(fixed.ENGINEERING),
    "interview_strength": sql_mean(fixed.INTERVIEW),
    "soft_strength": sql_mean(fixed.SOFT),
    "data_ml_strength": sql_mean(fixed.DATA_ML),
    "all_tech_mean": sql_mean(fixed.ALL_TECH),
    "tech_score_std": sql_std(fixed.ALL_TECH),
    "tech_score_max": "greatest(" + ", ".join(fixed.ALL_TECH) + ")",
}


@query("b01_tech_family_columns", f"""{WITH_APPLICANTS} SELECT student_id,
  {", ".join(r6(c) + " AS " + c for c in fixed.TECH_CORE)} FROM applicants""")
def _(t):
    return pick(t.applicants(), fixed.TECH_CORE)


NUMERIC = ["application_year", "age", "graduation_year", "cgpa", "english_exam_score",
           "attendance_rate", "failed_courses_count", "coding_score", "problem_solving_score",
           "data_structures_score", "sql_score", "machine_learning_score", "backend_score",
           "frontend_score", "cloud_score", "devops_score", "project_quality_score",
           "real_client_project_count", "internship_count", "internship_duration_months",
           "freelance_project_count", "hackathon_count", "hackathon_awards", "portfolio_score",
           "github_repo_count", "github_avg_stars", "open_source_contribution_count",
           "linkedin_profile_score", "cv_quality_score", "technical_interview_score",
           "hr_interview_score", "communication_score", "teamwork_score", "leadership_score",
           "presentation_score", "certification_count", "bootcamp_count", "applications_sent",
           "interviews_attended"]
INTS = {"application_year", "age", "graduation_year", "failed_courses_count",
        "real_client_project_count", "internship_count", "freelance_project_count",
        "hackathon_count", "hackathon_awards", "github_repo_count",
        "open_source_contribution_count", "certification_count", "bootcamp_count",
        "applications_sent", "interviews_attended"}


@query("b02_numeric_columns", f"""{WITH_APPLICANTS} SELECT student_id,
  {", ".join((c if c in INTS else r6(c)) + " AS " + c for c in NUMERIC)} FROM applicants""")
def _(t):
    df = t.applicants()
    return pick(df, features.numeric_columns(df, ("student_id", "score")))


@query("b03_b04_family_reductions",
       applicants_sql({n: r6(e) for n, e in FAMILY_SQL.items()}))
def _(t):
    return pick(t.applicants().withColumns(features.family_features()), list(FAMILY_SQL))


@query("b03_null_skipping_mean", f"""{WITH_CASES}
  SELECT row_id, {r6(sql_mean(["avg_qty", "avg_disc", "max_tax", "bal"]))} AS m,
    {r6(sql_std(["avg_qty", "avg_disc", "max_tax", "bal"]))} AS s FROM cases""")
def _(t):
    cols = ["avg_qty", "avg_disc", "max_tax", "bal"]
    return t.cases().select("row_id", R.rounded(R.row_mean(cols)).alias("m"),
                            R.rounded(R.row_std(cols)).alias("s"))


@query("b05_product_aggregate", applicants_sql({"academic_strength": r6("cgpa * attendance_rate")}))
def _(t):
    df = t.applicants().withColumn("academic_strength", F.col("cgpa") * F.col("attendance_rate"))
    return pick(df, ["academic_strength"])


@query("b06_role_skill_match", applicants_sql({
    "role_skill_match": r6(sql_match()),
    "role_skill_gap": r6(f"{sql_match()} - {FAMILY_SQL['all_tech_mean']}")}))
def _(t):
    df = features.row_features(t.applicants(), SPEC)
    return pick(df, ["role_skill_match", "role_skill_gap"])


RATIO_SQL = {
    "interview_conversion": "interviews_attended / (applications_sent + 1.0)",
    "hackathon_win_rate": "hackathon_awards / (hackathon_count + 1.0)",
    "osc_per_repo": "open_source_contribution_count / (github_repo_count + 1.0)",
    "months_per_internship": "internship_duration_months / (internship_count + 1.0)",
    "failed_ratio": "failed_courses_count / (cgpa + 0.1)",
}


@query("b07_ratios_with_offset", applicants_sql({n: r6(e) for n, e in RATIO_SQL.items()}))
def _(t):
    return pick(t.applicants().withColumns(features.ratio_features()), list(RATIO_SQL))


TIME_SQL = {"years_since_graduation": "application_year - graduation_year",
            "age_at_graduation": "age - (application_year - graduation_year)"}


@query("b08_timeline", applicants_sql(TIME_SQL))
def _(t):
    return pick(t.applicants().withColumns(features.timeline_features(SPEC.year)), list(TIME_SQL))


CURATED_SQL = {
    "academic_strength": "cgpa * attendance_rate",
    "stars_total": "github_repo_count * github_avg_stars",
    "pq_x_tech_interview": "project_quality_score * technical_interview_score",
    "pq_x_portfolio": "project_quality_score * portfolio_score",
    "pq_x_real_clients": "project_quality_score * ln(1 + real_client_project_count)",
    "tech_x_interview": f"{FAMILY_SQL['technical_strength']} * {FAMILY_SQL['interview_strength']}",
    "tech_x_portfolio": f"{FAMILY_SQL['technical_strength']} * portfolio_score",
    "soft_x_interview": f"{FAMILY_SQL['soft_strength']} * hr_interview_score",
    "acad_x_tech": f"cgpa * attendance_rate * {FAMILY_SQL['technical_strength']}",
    "tech_interview_minus_tech": f"technical_interview_score - {FAMILY_SQL['all_tech_mean']}",
    "role_skill_gap": f"{sql_match()} - {FAMILY_SQL['all_tech_mean']}",
}


@query("b09_curated_interactions", applicants_sql({n: r6(e) for n, e in CURATED_SQL.items()}))
def _(t):
    return pick(features.row_features(t.applicants(), SPEC), list(CURATED_SQL))


MISSING_SQL = {f"{c}_missing": f"CAST({c} IS NULL AS INT)" for c in fixed.NULL_BEARING} | {
    "github_profile_missing": "CAST(github_avg_stars IS NULL AS INT)",
    "intern_dur_missing_but_has_intern":
        "CAST(internship_duration_months IS NULL AND internship_count > 0 AS INT)",
    "n_missing": " + ".join(f"CAST({c} IS NULL AS INT)" for c in fixed.NULL_BEARING)}


@query("b10_b11_b12_missing_indicators", applicants_sql(MISSING_SQL))
def _(t):
    return pick(t.applicants().withColumns(features.missing_features()), list(MISSING_SQL))


# ------------------------------------------------- features of fitted statistics
def z_sql(c, logged):
    e = f"ln(1 + {c})" if logged else c
    return (f"(({e}) - (SELECT avg({e}) FROM train))"
            f" / ((SELECT stddev_samp({e}) FROM train) + 1e-9)")


def z_mean_sql(parts):
    return sql_mean([f"({z_sql(*p)})" for p in parts])


TRAIN_SQL = f"{WITH_APPLICANTS}, train AS (SELECT * FROM applicants WHERE split = 'train')"
Z_SQL = {c: z_sql(c, False) for c in fixed.Z_RAW} | {f"log1p_{c}": z_sql(c, True)
                                                    for c in fixed.Z_LOG}
COMPOSITE_SQL = {"portfolio_strength": z_mean_sql(fixed.PORTFOLIO_Z),
                 "experience_strength": z_mean_sql(fixed.EXPERIENCE_Z)}


@query("b13_z_scores", f"""{TRAIN_SQL} SELECT student_id,
  {", ".join(f"{r6(e)} AS {n}" for n, e in Z_SQL.items())} FROM applicants""")
def _(t):
    model = features.fit_features(t.applicants("train"), SPEC)
    parts = [(c, False) for c in fixed.Z_RAW] + [(c, True) for c in fixed.Z_LOG]
    return t.applicants().select("student_id", *[
        R.rounded(model.z_part(c, logged)).alias(f"log1p_{c}" if logged else c)
        for c, logged in parts])


@query("b14_z_composites", f"""{TRAIN_SQL} SELECT student_id,
  {", ".join(f"{r6(e)} AS {n}" for n, e in COMPOSITE_SQL.items())} FROM applicants""")
def _(t):
    model = features.fit_features(t.applicants("train"), SPEC)
    return t.applicants().select("student_id", *[
        R.rounded(model.composite(p)).alias(n) for n, p in
        (("portfolio_strength", fixed.PORTFOLIO_Z), ("experience_strength", fixed.EXPERIENCE_Z))])


ROLE_COLS = {c: FAMILY_SQL.get(c, sql_match() if c == "role_skill_match" else c)
             for c in fixed.ROLE_RELATIVE}
VS_ROLE = ", ".join(f"avg({e}) AS {c}" for c, e in ROLE_COLS.items())


@query("b15_deviation_from_role_mean", f"""{TRAIN_SQL},
  m AS (SELECT target_role AS role_key, {VS_ROLE.replace(") AS ", ") AS m_")} FROM train
        WHERE target_role IS NOT NULL GROUP BY target_role)
  SELECT student_id, {", ".join(f"{r6(f'{e} - m_{c}')} AS {c}_vs_role" for c, e in ROLE_COLS.items())}
  FROM applicants LEFT JOIN m ON target_role = role_key""")
def _(t):
    model = features.fit_features(t.applicants("train"), SPEC)
    return pick(model.transform(t.applicants()), [f"{c}_vs_role" for c in fixed.ROLE_RELATIVE])


TIER_SQL = "CAST(CASE university_tier WHEN 'Tier 1' THEN 1 WHEN 'Tier 2' THEN 2 " \
           "WHEN 'Tier 3' THEN 3 WHEN 'Tier 4' THEN 4 END AS DOUBLE)"


@query("b16_ordinal", applicants_sql({"university_tier_ord": TIER_SQL}))
def _(t):
    return t.applicants().select("student_id", features.ordinal(
        "university_tier", fixed.TIER_ORDER).alias("university_tier_ord"))


def freq_sql(c):
    return (f"(SELECT count(*) FROM train AS f WHERE f.{c} = a.{c})"
            f" / nullif((SELECT count({c}) FROM train), 0)")


def freq_cte(c):
    return (f"f_{c} AS (SELECT {c} AS k_{c}, CAST(count(*) AS DOUBLE) / (SELECT count({c}) FROM train)"
            f" AS {c}_freq, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INT) AS {c}_code"
            f" FROM train WHERE {c} IS NOT NULL GROUP BY {c})")


CATS = fixed.CATEGORIES
CAT_CTES = ", ".join(freq_cte(c) for c in CATS)
CAT_JOINS = " ".join(f"LEFT JOIN f_{c} ON {c} = k_{c}" for c in CATS)


@query("b17_frequency_encoding", f"""{TRAIN_SQL}, {CAT_CTES}
  SELECT student_id, {", ".join(f"{r6(c + '_freq')} AS {c}_freq" for c in CATS)}
  FROM applicants {CAT_JOINS}""")
def _(t):
    model = features.fit_features(t.applicants("train"), SPEC)
    return pick(model.transform(t.applicants()), [f"{c}_freq" for c in CATS])


@query("b18_category_codes", f"""{WITH_CASES},
  d AS (SELECT grp AS k, CAST(row_number() OVER (ORDER BY grp) - 1 AS INT) AS code
        FROM (SELECT DISTINCT grp FROM cases WHERE yr < 1998 AND grp < '4'))
  SELECT row_id, coalesce(code, -1) AS code, greatest(coalesce(code, -1), 0) AS embedded
  FROM cases LEFT JOIN d ON grp = k""")
def _(t):
    # levels from '4' on are unseen by the dictionary on purpose
    fit = t.cases().where("yr < 1998 AND grp < '4'")
    df = encode.lookup(t.cases(), encode.dictionary(fit, "grp"), "grp")
    code = F.coalesce("code", F.lit(-1))
    return df.select("row_id", code.alias("code"), F.greatest(code, F.lit(0)).alias("embedded"))


TOP_COLUMNS = f"""{TRAIN_SQL},
  long AS (UNPIVOT (SELECT score, {", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM train)) AS {c}" for c in NUMERIC)} FROM train)
           ON {", ".join(NUMERIC)} INTO NAME name VALUE v),
  r AS (SELECT name, abs(corr(v, score)) AS c FROM long GROUP BY name),
  top AS (SELECT name, row_number() OVER (ORDER BY c DESC, name) AS rk FROM r ORDER BY rk LIMIT 8)"""


@query("b19_auto_interactions", f"""{TOP_COLUMNS},
  cells AS (UNPIVOT (SELECT student_id, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC)} FROM applicants)
            ON {", ".join(NUMERIC)} INTO NAME name VALUE v)
  SELECT x.student_id, 'ax_' || a.name || '__x__' || b.name AS name, {r6("x.v * z.v", 4)} AS value
  FROM top a JOIN top b ON a.rk < b.rk JOIN cells x ON x.name = a.name JOIN cells z ON z.name = b.name AND z.student_id = x.student_id""")
def _(t):
    cols = features.numeric_columns(t.applicants("train"), ("student_id", "score"))
    df = written(t.applicants().select("student_id", "split", "score", *cols))  # read several times
    train = df.where("split = 'train'")
    made = features.product_features(features.auto_interactions(train, cols, "score"))
    long = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), R.rounded(e.cast("double"), 4).alias("value")) for n, e in made.items()]))
    return df.select("student_id", long.alias("c")).select("student_id", "c.*").where("value is not null")


@query("b19_auto_interaction_pairs", f"""{TOP_COLUMNS}
  SELECT a.name AS a, b.name AS b FROM top a JOIN top b ON a.rk < b.rk""")
def _(t):
    cols = features.numeric_columns(t.applicants("train"), ("student_id", "score"))
    train = t.stored_applicants("score", *cols)
    return t.spark.createDataFrame(features.auto_interactions(train, cols, "score"), "a string, b string")


@query("b20_ceiling_flag", f"""{WITH_CASES}
  SELECT row_id, CAST(y >= 100 AS INT) AS at_ceiling, CASE WHEN y < 100 THEN {r6("y")} END AS below
  FROM cases""")
def _(t):
    y = F.col("y")
    return t.cases().select("row_id", R.flag(y >= fixed.CEILING).alias("at_ceiling"),
                            F.when(y < fixed.CEILING, R.rounded(y)).alias("below"))


@query("b21_clip", f"""{WITH_CASES}
  SELECT row_id, {r6("least(greatest(bal / 50, 0), 100)")} AS p FROM cases""")
def _(t):
    return t.cases().select("row_id", R.rounded(R.clip(F.col("bal") / 50, *fixed.CLIP)).alias("p"))


B22 = ["avg_qty", "avg_disc", "max_tax", "bal"]


def b22_sql(c):
    return (f"least(greatest((coalesce({c}, (SELECT median({c}) FROM train)) - "
            f"(SELECT avg(coalesce({c}, (SELECT median({c}) FROM train))) FROM train)) / "
            f"((SELECT stddev_samp(coalesce({c}, (SELECT median({c}) FROM train))) FROM train)"
            f" + 1e-6), -8), 8)")


@query("b22_b24_fill_standardise_clamp", f"""{WITH_CASES},
  train AS (SELECT * FROM cases WHERE split = 'train')
  SELECT row_id, {", ".join(f"{r6(b22_sql(c))} AS {c}" for c in B22)} FROM cases""")
def _(t):
    from foldwise.operators.quantiles import medians
    train = t.stored_cases("train")
    fill = features.median_fill(B22, medians(train, B22))
    stats = features.standard_stats(train.select(*[e.alias(c) for c, e in fill.items()]), B22)
    df = t.stored_cases().withColumns(fill).withColumns(features.standardise(B22, stats))
    return pick(df, B22, key="row_id")


@query("b23_columns_by_block", applicants_sql(
    {c: r6(c) for c in NUMERIC if c.endswith("_score") and not c.startswith(("hr_", "cv_"))}))
def _(t):
    df = t.applicants()
    names = features.block(df.columns, suffixes=("_score",))
    drop = features.block(df.columns, prefixes=("hr_", "cv_"))
    return pick(df, [c for c in names if c not in drop])


@query("b26_hash_split", f"""{WITH_CASES},
  h AS (SELECT *, CAST(CAST('0x' || substr(md5('0:' || CAST(row_id AS VARCHAR)), 1, 8) AS BIGINT)
        AS DOUBLE) / 4294967296.0 AS u FROM cases)
  SELECT row_id, CAST(u < 0.2 AS INT) AS held FROM h""")
def _(t):
    rest, held = features.hash_split(t.cases(), "row_id", 0.2)
    return rest.select("row_id", F.lit(0).alias("held")).unionByName(
        held.select("row_id", F.lit(1).alias("held")))


BUILT_SQL = FAMILY_SQL | RATIO_SQL | CURATED_SQL | COMPOSITE_SQL | {
    "role_skill_match": sql_match(),
    "exp_x_tech": f"{COMPOSITE_SQL['experience_strength']} * {FAMILY_SQL['technical_strength']}",
    "portfolio_x_interview":
        f"{COMPOSITE_SQL['portfolio_strength']} * {FAMILY_SQL['interview_strength']}",
    "university_tier_ord": TIER_SQL} | {f"{c}_vs_role": f"{e} - m_{c}" for c, e in ROLE_COLS.items()} \
    | {f"{c}_freq": f"{c}_freq" for c in CATS}
BUILT_INTS = TIME_SQL | MISSING_SQL | {f"{c}_code": f"coalesce({c}_code, -1)" for c in CATS}


@query("b27_whole_feature_transform", f"""{TRAIN_SQL}, {CAT_CTES},
  m AS (SELECT target_role AS role_key, {VS_ROLE.replace(") AS ", ") AS m_")} FROM train
        WHERE target_role IS NOT NULL GROUP BY target_role)
  SELECT student_id, {", ".join(f"{r6(e)} AS {n}" for n, e in BUILT_SQL.items())},
    {", ".join(f"{e} AS {n}" for n, e in BUILT_INTS.items())},
    {", ".join((c if c in INTS else r6(c)) + " AS " + c for c in NUMERIC)}
  FROM applicants {CAT_JOINS} LEFT JOIN m ON target_role = role_key""")
def _(t):
    model = features.fit_features(t.applicants("train"), SPEC)
    df = model.transform(t.applicants())
    return pick(df, [c for c in model.feature_names(df) if c not in NOT_FEATURES])


# ------------------------------------------------------------- scalar functions
@query("h01_h08_scalar_functions", f"""{WITH_CASES}
  SELECT row_id, {r6("ln(1 + n_items)")} AS log_items, {r6("sqrt(y)")} AS root,
    {r6("abs(bal)")} AS magnitude, {r6("bal * bal", 3)} AS square, {r6("log10(y)")} AS decade,
    coalesce(CAST(n_items AS VARCHAR), 'nan') AS items_text, CAST(yr AS DOUBLE) AS yr_float,
    yr - 1995 AS years, md5(grp) AS grp_key, concat('query: ', coalesce(grp, '')) AS prefixed
  FROM cases""")
def _(t):
    c = F.col
    return t.cases().select(
        "row_id", R.rounded(F.log1p("n_items")).alias("log_items"),
        R.rounded(F.sqrt("y")).alias("root"), R.rounded(F.abs("bal")).alias("magnitude"),
        R.rounded(c("bal") * c("bal"), 3).alias("square"), R.rounded(F.log10("y")).alias("decade"),
        R.level("n_items", fixed.NULL_LEVEL).alias("items_text"),
        c("yr").cast("double").alias("yr_float"), (c("yr") - 1995).alias("years"),
        F.md5("grp").alias("grp_key"),
        F.concat(F.lit("query: "), F.coalesce("grp", F.lit(""))).alias("prefixed"))


@query("h10_map_lookup", f"""{WITH_CASES}
  SELECT row_id, CAST(CASE tier WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS DOUBLE) AS tier_ord FROM cases""")
def _(t):
    return t.cases().select("row_id", features.ordinal("tier", {"F": 1, "O": 2}).alias("tier_ord"))
