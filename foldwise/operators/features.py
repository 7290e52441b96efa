"""Row features, features that use fitted statistics, and pairwise products.

``fit`` reads the training table and keeps numbers and small tables;
``transform`` is one chain of projections and lookup joins, so it runs on any
table of the same columns, streaming ones included.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from foldwise import fixed
from foldwise.functions import rows as R
from foldwise.operators import encode, quantiles
from foldwise.scratch import fitted
from foldwise.spec import TableSpec


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def log1p(c: str) -> Column:
    return F.log1p(F.col(c))


# ------------------------------------------------------------------ row features
def family_features() -> dict[str, Column]:
    """Null-skipping reductions over column families."""
    return {
        "technical_strength": R.row_mean(fixed.TECH_CORE),
        "engineering_strength": R.row_mean(fixed.ENGINEERING),
        "interview_strength": R.row_mean(fixed.INTERVIEW),
        "soft_strength": R.row_mean(fixed.SOFT),
        "data_ml_strength": R.row_mean(fixed.DATA_ML),
        "all_tech_mean": R.row_mean(fixed.ALL_TECH),
        "tech_score_std": R.row_std(fixed.ALL_TECH),
        "tech_score_max": R.row_max(fixed.ALL_TECH),
    }


def role_match(role: str, skills: dict[str, Sequence[str]] | None = None) -> Column:
    """Mean of the columns that matter for the row's role; null for other roles."""
    cases = None
    for name, cols in (skills or fixed.ROLE_SKILLS).items():
        start = F if cases is None else cases
        cases = start.when(F.col(role) == name, R.row_mean(cols))
    return cases


def ratio_features() -> dict[str, Column]:
    return {
        "interview_conversion": R.ratio("interviews_attended", "applications_sent", 1.0),
        "hackathon_win_rate": R.ratio("hackathon_awards", "hackathon_count", 1.0),
        "osc_per_repo": R.ratio("open_source_contribution_count", "github_repo_count", 1.0),
        "months_per_internship": R.ratio("internship_duration_months", "internship_count", 1.0),
        "failed_ratio": R.ratio("failed_courses_count", "cgpa", 0.1),
    }


def timeline_features(year: str) -> dict[str, Column]:
    since = F.col(year) - F.col("graduation_year")
    return {"years_since_graduation": since, "age_at_graduation": F.col("age") - since}


def interaction_features() -> dict[str, Column]:
    """Curated products and differences; needs the family features."""
    pq, ti = F.col("project_quality_score"), F.col("technical_interview_score")
    return {
        "academic_strength": F.col("cgpa") * F.col("attendance_rate"),
        "stars_total": F.col("github_repo_count") * F.col("github_avg_stars"),
        "pq_x_tech_interview": pq * ti,
        "pq_x_portfolio": pq * F.col("portfolio_score"),
        "pq_x_real_clients": pq * log1p("real_client_project_count"),
        "tech_x_interview": F.col("technical_strength") * F.col("interview_strength"),
        "tech_x_portfolio": F.col("technical_strength") * F.col("portfolio_score"),
        "soft_x_interview": F.col("soft_strength") * F.col("hr_interview_score"),
        "acad_x_tech": F.col("cgpa") * F.col("attendance_rate") * F.col("technical_strength"),
        "tech_interview_minus_tech": ti - F.col("all_tech_mean"),
        "role_skill_gap": F.col("role_skill_match") - F.col("all_tech_mean"),
    }


def missing_features(null_cols: Sequence[str] = fixed.NULL_BEARING) -> dict[str, Column]:
    out = {f"{c}_missing": R.flag(F.col(c).isNull()) for c in null_cols}
    out["github_profile_missing"] = R.flag(F.col("github_avg_stars").isNull())
    out["intern_dur_missing_but_has_intern"] = R.flag(
        F.col("internship_duration_months").isNull() & (F.col("internship_count") > 0))
    out["n_missing"] = R.null_count(null_cols)
    return out


def row_features(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Everything that needs no fitted statistics, in three projections."""
    first = {**family_features(), "role_skill_match": role_match(spec.role), **ratio_features(),
             **timeline_features(spec.year)}
    return df.withColumns(first).withColumns(interaction_features())


# --------------------------------------------------------------- fitted features
@dataclass
class FeatureModel:
    spec: TableSpec
    z_stats: dict[str, tuple[float | None, float | None]]
    tables: dict[str, DataFrame] = field(default_factory=dict)
    raw: list[str] = field(default_factory=list)

    def z_part(self, column: str, logged: bool) -> Column:
        key = f"log1p_{column}" if logged else column
        return R.z(log1p(column) if logged else column, *self.z_stats[key])

    def composite(self, parts) -> Column:
        return R.row_mean([self.z_part(*p) for p in parts])

    def transform(self, df: DataFrame) -> DataFrame:
        spec = self.spec
        out = row_features(df, spec).withColumns(missing_features(spec.null_cols)).withColumns({
            "portfolio_strength": self.composite(fixed.PORTFOLIO_Z),
            "experience_strength": self.composite(fixed.EXPERIENCE_Z)})
        for c in spec.cats:
            out = encode.lookup(out, self.tables[c], c, null_level=fixed.NULL_LEVEL)
            out = out.withColumnsRenamed({"code": f"{c}_code", "freq": f"{c}_freq"})
        derived = {
            "exp_x_tech": F.col("experience_strength") * F.col("technical_strength"),
            "portfolio_x_interview": F.col("portfolio_strength") * F.col("interview_strength"),
            f"{spec.tier}_ord": ordinal(spec.tier, spec.tier_order),
        }
        for c in spec.cats:
            derived[f"{c}_code"] = F.coalesce(f"{c}_code", F.lit(-1))
        for c in fixed.ROLE_RELATIVE:
            derived[f"{c}_vs_role"] = F.col(c) - F.col(f"__role_{c}")
        return out.withColumns(derived).drop(*[f"__role_{c}" for c in fixed.ROLE_RELATIVE])

    def feature_names(self, df: DataFrame) -> list[str]:
        """Numeric model inputs of a transformed table."""
        skip = {self.spec.id, self.spec.target, *self.spec.ignore, "split"}
        return numeric_columns(df, skip)


def ordinal(c: str, order: dict[str, int]) -> Column:
    pairs = itertools.chain.from_iterable((F.lit(k), F.lit(float(v))) for k, v in order.items())
    return F.element_at(F.create_map(*pairs), F.col(c))


def _z_aggregates(raw: Sequence[str], logged: Sequence[str]) -> list[Column]:
    """Mean and sample deviation of every raw and log1p column."""
    aggs = []
    for name, value in [(c, F.col(c)) for c in raw] + [(f"log1p_{c}", log1p(c)) for c in logged]:
        aggs += [F.avg(value).alias(f"{name}__mean"), F.stddev_samp(value).alias(f"{name}__sd")]
    return aggs


def z_statistics(df: DataFrame, raw: Sequence[str] = fixed.Z_RAW,
                 logged: Sequence[str] = fixed.Z_LOG) -> DataFrame:
    """One row with the statistics that the z features are fitted on."""
    return df.agg(*_z_aggregates(raw, logged))


def fit_features(df: DataFrame, spec: TableSpec) -> FeatureModel:
    """One pass over the training table: grouping sets give the statistics of
    the whole table and of every level of every category together."""
    keys = {c: f"__key_{c}" for c in spec.cats}
    prepared = row_features(df, spec).withColumns(
        {k: R.level(c, fixed.NULL_LEVEL) for c, k in keys.items()})
    grouped = prepared.groupingSets([[k] for k in keys.values()] + [[]], *keys.values())
    stats = fitted(grouped.agg(
        *[F.grouping(k).alias(f"__all{k}") for k in keys.values()],
        *[F.count(c).alias(f"__n_{c}") for c in spec.cats],
        *[F.avg(F.when(F.col(spec.role).isNotNull(), F.col(m))).alias(f"__role_{m}")
          for m in fixed.ROLE_RELATIVE],
        *_z_aggregates(fixed.Z_RAW, fixed.Z_LOG)))
    whole = stats.where(" and ".join(f"__all{k} = 1" for k in keys.values())).first()
    z_stats = {}
    for name in [*fixed.Z_RAW, *(f"log1p_{c}" for c in fixed.Z_LOG)]:
        mean, sd = whole[f"{name}__mean"], whole[f"{name}__sd"]
        z_stats[name] = (mean, None if sd is None else sd + fixed.Z_EPS)
    tables = {}
    for c, k in keys.items():
        levels = stats.where(f"__all{k} = 0")
        codes = encode.sorted_codes(levels, k).withColumnRenamed(k, "__level")
        n = F.col(f"__n_{c}")
        freq = F.when(n > 0, n.cast("double") / F.lit(float(whole[f"__n_{c}"] or 1)))
        means = [f"__role_{m}" for m in fixed.ROLE_RELATIVE] if c == spec.role else []
        tables[c] = fitted(levels.join(codes, F.col(k) == F.col("__level"))
                           .select(F.col(k).alias(c), "code", freq.alias("freq"), *means))
    return FeatureModel(spec, z_stats, tables)


# ------------------------------------------------------------- pairwise products
def long_pairs(df: DataFrame, values: dict[str, Column], y: Column) -> DataFrame:
    """``(name, x, y)`` per row and column. Grouping by name then takes any number
    of columns, where one wide aggregate would outgrow compiled code."""
    cells = F.array(*[F.struct(F.lit(n).alias("name"), v.cast("double").alias("x")) for n, v in values.items()])
    return df.select(y.cast("double").alias("y"), F.explode(cells).alias("c")).select("c.name", "c.x", "y")


def filled_correlations(df: DataFrame, cols: Sequence[str], y: str) -> dict[str, float | None]:
    """|Pearson| with the target after median fill; null for constant columns."""
    mids = quantiles.medians(df, cols)
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(mids[c])) for c in cols}
    rows = (long_pairs(df, filled, F.col(y)).groupBy("name")
            .agg(F.abs(R.pearson("x", "y")).alias("r")).collect())
    return {r["name"]: r["r"] for r in rows}


def strongest(scores: dict[str, float | None], n: int) -> list[str]:
    """Names by falling score, unknown last, ties by name."""
    return sorted(scores, key=lambda c: (scores[c] is None, -(scores[c] or 0.0), c))[:n]


def pairs(names: Sequence[str]) -> list[tuple[str, str]]:
    return list(itertools.combinations(names, 2))


def product_features(names: Sequence[tuple[str, str]]) -> dict[str, Column]:
    return {f"ax_{a}__x__{b}": F.col(a) * F.col(b) for a, b in names}


def auto_interactions(df: DataFrame, cols: Sequence[str], y: str,
                      top_n: int = fixed.AUTO_TOP_N) -> list[tuple[str, str]]:
    """The pairs to multiply: all pairs of the strongest columns of the training table."""
    return pairs(strongest(filled_correlations(df, cols, y), top_n))


# ------------------------------------------------------------------ model inputs
def median_fill(cols: Sequence[str], mids: dict[str, float | None]) -> dict[str, Column]:
    return {c: F.coalesce(F.col(c).cast("double"), F.lit(mids.get(c) or 0.0)) for c in cols}


def standardise(cols: Sequence[str], stats: dict[str, tuple[float, float]],
                clamp: float = fixed.STANDARD_CLAMP) -> dict[str, Column]:
    """z-scores by fitted numbers, clamped so that near-constant columns stay tame."""
    return {c: R.clip(R.z(c, *stats[c]), -clamp, clamp) for c in cols}


def standard_stats(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and sample deviation of filled columns, in one vector aggregate."""
    vector = array_to_vector(F.array(*[F.col(c).cast("double") for c in cols]))
    row = df.select(vector.alias("v")).agg(Summarizer.metrics("mean", "std").summary(F.col("v")).alias("s")
                                           ).select("s.mean", "s.std").first()
    return {c: (float(row[0][i]), float(row[1][i]) + fixed.STANDARD_EPS) for i, c in enumerate(cols)}


# -------------------------------------------------------------- columns by block
def block(columns: Sequence[str], prefixes: Sequence[str] = (), suffixes: Sequence[str] = (),
          names: Sequence[str] = ()) -> list[str]:
    return [c for c in columns if c.startswith(tuple(prefixes)) and prefixes
            or c.endswith(tuple(suffixes)) and suffixes or c in names]


def hash_share(id_col: str, seed: int) -> Column:
    """Uniform number in [0, 1) per row, stable under any repartitioning."""
    head = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))), 1, 8),
                  16, 10)
    return head.cast("double") / F.lit(float(16 ** 8))


def hash_split(df: DataFrame, id_col: str, share: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(rest, held-out share) by a hash of the id; rows keep their side for good."""
    held = hash_share(id_col, seed) < share
    return df.where(~held), df.where(held)
