"""Importance-weighted composites, polynomial terms and prior-guided products.

The weights are those of the analysis brief; each feature is a weighted sum or
a product, written down as data.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise import fixed
from foldwise.operators import profile
from foldwise.operators.features import pairs, strongest

# Weighted sums (a "log:" column is taken as log1p) ---------------
WEIGHTED = {
    "prior_interview_strength": {"technical_interview_score": 0.55, "communication_score": 0.25,
                                 "problem_solving_score": 0.12, "presentation_score": 0.08},
    "cloud_devops_strength": {"cloud_score": 0.40, "devops_score": 0.35, "backend_score": 0.25},
    "prior_technical_strength": {"problem_solving_score": 0.32, "coding_score": 0.24,
                                 "data_structures_score": 0.20, "sql_score": 0.14,
                                 "machine_learning_score": 0.10},
    "prior_portfolio_strength": {"portfolio_score": 0.35, "log:github_repo_count": 0.30,
                                 "open_source_contribution_count": 0.25, "github_avg_stars": 0.10},
    "prior_academic_strength": {"attendance_rate": 0.70, "english_exam_score": 0.20, "cgpa": 0.10},
    "prior_experience_strength": {"project_quality_score": 0.50, "log:internship_duration_months": 0.25,
                                  "real_client_project_count": 0.15, "freelance_project_count": 0.10},
}
# Products --------------------------------------------------------
PRODUCTS = {
    "project_excellence_depth": ("project_quality_score", "real_client_project_count"),
    "project_excellence_breadth": ("project_quality_score", "open_source_contribution_count"),
    "project_excellence_freelance": ("project_quality_score", "freelance_project_count"),
    "interview_communication_synergy": ("technical_interview_score", "communication_score"),
    "interview_problem_synergy": ("technical_interview_score", "problem_solving_score"),
    "infra_stack_score": ("cloud_score", "devops_score"),
    "full_stack_score": ("backend_score", "frontend_score"),
    "portfolio_depth": ("portfolio_score", "open_source_contribution_count"),
    "portfolio_github_sync": ("portfolio_score", "log:github_repo_count"),
    "experience_depth": ("internship_duration_months", "project_quality_score"),
    "project_x_interview": ("project_quality_score", "technical_interview_score"),
    "project_x_problemsolve": ("project_quality_score", "problem_solving_score"),
    "project_x_cloud": ("project_quality_score", "cloud_score"),
    "project_x_github": ("project_quality_score", "log:github_repo_count"),
    "coding_x_github": ("coding_score", "log:github_repo_count"),
    "problem_x_portfolio": ("problem_solving_score", "portfolio_score"),
    "open_source_x_problem": ("open_source_contribution_count", "problem_solving_score"),
    "interview_x_communication": ("technical_interview_score", "communication_score"),
    "cloud_x_devops": ("cloud_score", "devops_score"),
    "backend_x_cloud": ("backend_score", "cloud_score"),
    "internship_x_interview": ("internship_duration_months", "technical_interview_score"),
}
LOGGED_SUMS = {
    "experience_breadth": ("internship_count", "freelance_project_count", "real_client_project_count"),
    "__project_counts": ("real_client_project_count", "freelance_project_count",
                         "open_source_contribution_count"),
}
SQUARES = {"project_quality_sq": "project_quality_score", "tech_interview_sq": "technical_interview_score"}


def _value(name: str) -> Column:
    kind, _, c = name.rpartition(":")
    return F.log1p(F.col(c)) if kind == "log" else F.col(c).cast("double")


def composite_columns() -> dict[str, Column]:
    out = {n: reduce(add, [F.lit(w) * _value(c) for c, w in parts.items()])
           for n, parts in WEIGHTED.items()}
    out |= {n: reduce(mul, [_value(c) for c in parts]) for n, parts in PRODUCTS.items()}
    sums = {n: F.log1p(reduce(add, [F.col(c) for c in parts])) for n, parts in LOGGED_SUMS.items()}
    out["experience_breadth"] = sums["experience_breadth"]
    out["project_excellence_combined"] = F.col("project_quality_score") * sums["__project_counts"]
    out["github_star_density"] = F.try_divide(F.col("github_avg_stars"), F.log1p("github_repo_count"))
    return out


def second_products() -> dict[str, Column]:
    """Products of composites."""
    return {"tech_portfolio_synergy": F.col("prior_technical_strength") * F.col("prior_portfolio_strength"),
            "experience_x_technical": F.col("prior_experience_strength") * F.col("prior_technical_strength")}


def with_composites(df: DataFrame) -> DataFrame:
    return df.withColumns(composite_columns()).withColumns(second_products())


def squares(names: dict[str, str] | None = None) -> dict[str, Column]:
    return {n: F.col(c) * F.col(c) for n, c in (names or SQUARES).items()}


def prior_pairs(cutoff: float = 0.05, names: Sequence[str] = fixed.PRIOR_INTERACTIONS
                ) -> list[tuple[str, str]]:
    """All pairs of the columns whose prior importance reaches the cutoff."""
    return pairs([n for n in names if fixed.PRIOR[n] >= cutoff])


def pair_name(a: str, b: str) -> str:
    return f"px_{a}__x__{b}"


def pruned_products(df: DataFrame, y: str, top: int, cutoff: float = 0.05, measure: str = "corr") -> list[str]:
    """The strongest prior-guided products by |r| or by mutual information with the target."""
    made = df.select(y, *[(F.col(a).cast("double") * F.col(b).cast("double")).alias(pair_name(a, b))
                          for a, b in prior_pairs(cutoff)])
    names = [c for c in made.columns if c != y]
    if measure == "mi":
        found = {r["name"]: r["mi"] for r in profile.mutual_information(made, names, y).collect()}
    else:
        found = {r["name"]: None if r["r"] is None else abs(r["r"])
                 for r in profile.correlations(made, names, y).collect()}
    return strongest(found, top)
