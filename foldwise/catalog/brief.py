"""What the analysis brief asks for beyond the profile: composites, products, words, scorecard."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise import fixed
from foldwise.catalog import query
from foldwise.catalog.aggregates import all_rounded
from foldwise.catalog.bind import WITH_APPLICANTS
from foldwise.catalog.learning import SMALL, bundle
from foldwise.catalog.rowwise import TRAIN_SQL, applicants_sql, pick
from foldwise.catalog.sqltext import r6
from foldwise.operators import composites, explain, learners, profile, study, words
from foldwise.scratch import written


COMPOSITE_SQL = {  # written out, so that a wrong weight on the other side shows
    "prior_interview_strength": "(0.55 * technical_interview_score + 0.25 * communication_score + 0.12 * problem_solving_score + 0.08 * presentation_score)",
    "cloud_devops_strength": "(0.4 * cloud_score + 0.35 * devops_score + 0.25 * backend_score)",
    "prior_technical_strength": "(0.32 * problem_solving_score + 0.24 * coding_score + 0.2 * data_structures_score + 0.14 * sql_score + 0.1 * machine_learning_score)",
    "prior_portfolio_strength": "(0.35 * portfolio_score + 0.3 * ln(1 + github_repo_count) + 0.25 * open_source_contribution_count + 0.1 * github_avg_stars)",
    "prior_academic_strength": "(0.7 * attendance_rate + 0.2 * english_exam_score + 0.1 * cgpa)",
    "prior_experience_strength": "(0.5 * project_quality_score + 0.25 * ln(1 + internship_duration_months) + 0.15 * real_client_project_count + 0.1 * freelance_project_count)",
    "project_excellence_depth": "project_quality_score * real_client_project_count",
    "project_excellence_breadth": "project_quality_score * open_source_contribution_count",
    "project_excellence_freelance": "project_quality_score * freelance_project_count",
    "interview_communication_synergy": "technical_interview_score * communication_score",
    "interview_problem_synergy": "technical_interview_score * problem_solving_score",
    "infra_stack_score": "cloud_score * devops_score",
    "full_stack_score": "backend_score * frontend_score",
    "portfolio_depth": "portfolio_score * open_source_contribution_count",
    "portfolio_github_sync": "portfolio_score * ln(1 + github_repo_count)",
    "experience_depth": "internship_duration_months * project_quality_score",
    "project_x_interview": "project_quality_score * technical_interview_score",
    "project_x_problemsolve": "project_quality_score * problem_solving_score",
    "project_x_cloud": "project_quality_score * cloud_score",
    "project_x_github": "project_quality_score * ln(1 + github_repo_count)",
    "coding_x_github": "coding_score * ln(1 + github_repo_count)",
    "problem_x_portfolio": "problem_solving_score * portfolio_score",
    "open_source_x_problem": "open_source_contribution_count * problem_solving_score",
    "interview_x_communication": "technical_interview_score * communication_score",
    "cloud_x_devops": "cloud_score * devops_score",
    "backend_x_cloud": "backend_score * cloud_score",
    "internship_x_interview": "internship_duration_months * technical_interview_score",
    "experience_breadth": "ln(1 + internship_count + freelance_project_count + real_client_project_count)",
    "project_excellence_combined": "project_quality_score * ln(1 + real_client_project_count + freelance_project_count + open_source_contribution_count)",
    "github_star_density": "github_avg_stars / nullif(ln(1 + github_repo_count), 0)",
    "tech_portfolio_synergy": "(0.32 * problem_solving_score + 0.24 * coding_score + 0.2 * data_structures_score + 0.14 * sql_score + 0.1 * machine_learning_score) * (0.35 * portfolio_score + 0.3 * ln(1 + github_repo_count) + 0.25 * open_source_contribution_count + 0.1 * github_avg_stars)",
    "experience_x_technical": "(0.5 * project_quality_score + 0.25 * ln(1 + internship_duration_months) + 0.15 * real_client_project_count + 0.1 * freelance_project_count) * (0.32 * problem_solving_score + 0.24 * coding_score + 0.2 * data_structures_score + 0.14 * sql_score + 0.1 * machine_learning_score)",
}


@query("p14_importance_weighted_composites", applicants_sql({n: r6(e) for n, e in COMPOSITE_SQL.items()}))
def _(t):
    return pick(composites.with_composites(t.applicants()), list(COMPOSITE_SQL))


@query("p16_polynomial_terms", applicants_sql({
    n: r6(f"{c} * {c}") for n, c in composites.SQUARES.items()}))
def _(t):
    return pick(t.applicants().withColumns(composites.squares()), list(composites.SQUARES))


TERMS = {composites.pair_name(a, b): f"CAST({a} AS DOUBLE) * {b}" for a, b in composites.prior_pairs()}


@query("p17_pruned_prior_interactions", f"""{TRAIN_SQL}, c AS ({" UNION ALL ".join(
    f"SELECT '{n}' AS name, abs(corr({e}, score)) AS r FROM train" for n, e in TERMS.items())})
  SELECT name, CAST(row_number() OVER (ORDER BY r DESC, name) AS BIGINT) AS place FROM c ORDER BY place LIMIT 20""")
def _(t):
    found = composites.pruned_products(t.applicants("train"), "score", 20)
    return t.spark.createDataFrame([(n, i + 1) for i, n in enumerate(found)], "name string, place long")


STOP = ("the", "and", "of", "in", "un", "le", "de", "la", "der", "die", "und")
STOP_SQL = "[" + ", ".join(f"'{s}'" for s in STOP) + "]"
TOKENS = f"""toks AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
  lambda w: NOT list_contains({STOP_SQL}, w)) AS t FROM documents)"""


@query("p09_frequent_words", f"""WITH {TOKENS}
  SELECT term, count(*) AS n FROM (SELECT unnest(t) AS term FROM toks) GROUP BY term ORDER BY n DESC, term LIMIT 50""")
def _(t):
    return words.frequent_terms(t("documents"), "text", 50, stop=STOP)


@query("p09_frequent_bigrams", f"""WITH {TOKENS}
  SELECT term, count(*) AS n FROM (SELECT unnest(list_transform(range(1, greatest(len(t), 1)),
    lambda i: array_to_string(t[i:i+1], ' '))) AS term FROM toks) GROUP BY term ORDER BY n DESC, term LIMIT 50""")
def _(t):
    return words.frequent_terms(t("documents"), "text", 50, 2, 2, STOP)


@query("p09_words_of_high_and_low_rows", f"""WITH {TOKENS},
  o AS (SELECT unnest(t) AS term, quality FROM toks JOIN labels USING (doc_id)),
  c AS (SELECT term, count(*) FILTER (WHERE quality = 1) AS n_high, count(*) FILTER (WHERE quality = 0) AS n_low FROM o GROUP BY term),
  s AS (SELECT sum(n_high) AS h, sum(n_low) AS l FROM c)
  SELECT term, n_high, n_low, {r6("ln((n_high + 0.5) / (h - n_high + 0.5)) - ln((n_low + 0.5) / (l - n_low + 0.5))")} AS log_odds
  FROM c, s WHERE n_high + n_low >= 5""")
def _(t):
    docs = t("documents").join(t("labels"), "doc_id")
    return all_rounded(words.contrast_terms(docs, "text", F.col("quality") == 1, 5, STOP))


@query("p13_feature_scorecard")
def _(t):
    cols = ["project_quality_score", "technical_interview_score", "portfolio_score", "github_avg_stars", "cgpa"]
    train = written(t.applicants("train"))
    models = {n: learners.fit(n, SMALL[n], train, "student_id", "score", cols).model for n in ("boosted", "forest")}
    native = written(explain.native_importances(models, cols, t.spark))
    permuted = study.permutation_ranking(train, "student_id", "score", cols, params=SMALL["boosted"], repeats=1)
    overall, _, _ = study.attribution_study(bundle(t, cols), "boosted", SMALL["boosted"], 1)
    card = profile.scorecard(
        profile.null_table(train, cols), profile.correlations(train, cols, "score"),
        profile.mutual_information(train, cols, "score"),
        {"forest": native.where("model = 'forest'"), "boosted": native.where("model = 'boosted'"),
         "permutation": permuted, "attribution": overall}, profile.overview(train.select(*cols)))
    return card


@query("p13_importance_beside_prior", f"""{WITH_APPLICANTS}, train AS (SELECT * FROM applicants WHERE split = 'train'),
  c AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, score)) AS importance, CAST({p} AS DOUBLE) AS prior FROM train"
    for c, p in fixed.PRIOR.items() if c != "target_role")})
  SELECT feature, {r6("importance")} AS importance, prior FROM c""")
def _(t):
    cols = [c for c in fixed.PRIOR if c != "target_role"]
    found = profile.correlations(t.applicants("train"), cols, "score").select(
        F.col("name").alias("feature"), F.abs("r").alias("importance"))
    return all_rounded(study.importance_alignment(found))
