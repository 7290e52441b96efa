"""Views over the given tables that play the library's table roles.

The view text is shared by both engines: it only prepares inputs. What is
compared are the operators on top of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.sources.tables import read_table
from foldwise.spec import TableSpec

CASES_BODY = """
  SELECT o_orderkey AS row_id, CAST(year(o_orderdate) AS INT) AS yr, o_orderpriority AS grp,
    c_mktsegment AS dept, o_orderstatus AS tier,
    least(CAST(100 AS DOUBLE), o_totalprice / 4600) AS y, c_acctbal AS bal,
    n_items, avg_qty, avg_disc, max_tax,
    CASE WHEN n_regionkey = 0 OR (n_regionkey = 1 AND year(o_orderdate) >= 1999)
      THEN 'test' ELSE 'train' END AS split
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey
  JOIN {nation} ON c_nationkey = n_nationkey
  LEFT JOIN (
    SELECT l_orderkey, count(*) AS n_items, avg(l_quantity) AS avg_qty,
      avg(l_discount) AS avg_disc, max(l_tax) AS max_tax
    FROM {lineitem} GROUP BY l_orderkey) AS li ON o_orderkey = l_orderkey
"""

APPLICANTS_BODY = """
  SELECT *, least(CAST(100 AS DOUBLE), greatest(CAST(0 AS DOUBLE),
      22 + 0.62 * project_quality_score + 0.3 * technical_interview_score
      + 0.08 * coalesce(portfolio_score, 30) + 0.35 * (presentation_score - 50)
      + CASE university_tier WHEN 'Tier 1' THEN 6 WHEN 'Tier 2' THEN 2 ELSE 0 END
      + CASE target_role WHEN 'Backend Developer' THEN 0.08 * backend_score
                         WHEN 'Cloud Engineer' THEN 0.08 * cloud_score ELSE 3 END
      - CASE WHEN application_year >= 1999 THEN 4 ELSE 0 END)) AS score,
    concat('Adayın kodlama ve ', CASE WHEN sql_score > 50 THEN 'sql' ELSE 'problem çözme' END,
      ' alanında ', CASE WHEN project_quality_score > 55 THEN 'güçlü ve etkileyici' ELSE 'umut verici' END,
      ' bir profili var. ', CASE WHEN university_tier = 'Tier 3' THEN 'Ekip içinde olumlu.'
        ELSE concat(CASE WHEN target_role = 'Data Scientist' THEN 'Bununla birlikte ' ELSE 'Ancak ' END,
          CASE WHEN communication_score < 70 THEN 'iletişim' ELSE 'bulut ve devops' END,
          ' konusunda eksik. Teknik görüşme için geliştirmesi gerek.') END) AS feedback
  FROM (
    SELECT o_orderkey AS student_id, CAST(year(o_orderdate) AS INT) AS application_year,
      CAST(floor(c_acctbal / 1000) AS INT) + 24 AS age,
      CAST(year(o_orderdate) AS INT) - CAST(floor(o_totalprice / 125000) AS INT) AS graduation_year,
      c_mktsegment AS department,
      CASE o_orderstatus WHEN 'F' THEN 'Tier 1' WHEN 'O' THEN 'Tier 2' ELSE 'Tier 3' END AS university_tier,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Backend Developer' WHEN '2-HIGH' THEN 'Data Scientist'
        WHEN '3-MEDIUM' THEN 'Cloud Engineer' WHEN '5-LOW' THEN 'Product Analyst'
        ELSE 'Community Manager' END AS target_role,
      n_name AS hobby, r_name AS preferred_social_media_platform,
      coalesce(1 + 37 * t, CAST(2.5 AS DOUBLE)) AS cgpa, 2 * qa AS english_exam_score,
      coalesce(100 - 400 * d, CAST(70 AS DOUBLE)) AS attendance_rate,
      CAST(coalesce(n, 0) AS INT) AS failed_courses_count,
      coalesce(2 * q, CAST(50 AS DOUBLE)) AS coding_score,
      coalesce(2 * q_max, CAST(50 AS DOUBLE)) AS problem_solving_score,
      coalesce(2 * q_min, CAST(50 AS DOUBLE)) AS data_structures_score,
      coalesce(p / 1050, CAST(50 AS DOUBLE)) AS sql_score,
      coalesce(1000 * d, CAST(50 AS DOUBLE)) AS machine_learning_score,
      coalesce(p_max / 1050, CAST(50 AS DOUBLE)) AS backend_score,
      coalesce(p_min / 1050, CAST(50 AS DOUBLE)) AS frontend_score,
      coalesce(14 * ln, CAST(50 AS DOUBLE)) AS cloud_score,
      coalesce(1250 * t, CAST(50 AS DOUBLE)) AS devops_score,
      coalesce(q + p / 2100, CAST(50 AS DOUBLE)) AS project_quality_score,
      CAST(coalesce(n_deal, 0) AS INT) AS real_client_project_count,
      CAST(coalesce(n_f, 0) AS INT) AS internship_count,
      CAST(m_f AS DOUBLE) AS internship_duration_months,
      CAST(coalesce(n_n, 0) AS INT) AS freelance_project_count,
      CAST(coalesce(ln_max, 0) AS INT) AS hackathon_count,
      CAST(coalesce(n_big, 0) AS INT) AS hackathon_awards,
      pn / 1050 AS portfolio_score, CAST(coalesce(n, 0) AS INT) AS github_repo_count,
      1250 * tr AS github_avg_stars, CAST(nullif(nr, 0) AS INT) AS open_source_contribution_count,
      1000 * d_o AS linkedin_profile_score,
      coalesce(q_max + 7 * ln, CAST(50 AS DOUBLE)) AS cv_quality_score,
      coalesce((p_max + p_min) / 2100, CAST(50 AS DOUBLE)) AS technical_interview_score,
      2 * qr AS hr_interview_score, 50 + c_acctbal / 200 AS communication_score,
      coalesce(sqrt(q_max * q_min) * 2, CAST(50 AS DOUBLE)) AS teamwork_score,
      coalesce(sqrt(p_max) / 3.3, CAST(50 AS DOUBLE)) AS leadership_score,
      o_totalprice / 5000 AS presentation_score,
      c_nationkey AS certification_count, n_regionkey AS bootcamp_count,
      CAST(day(o_orderdate) AS INT) AS applications_sent,
      CAST(month(o_orderdate) AS INT) AS interviews_attended,
      CASE WHEN n_regionkey = 0 OR (n_regionkey = 1 AND year(o_orderdate) >= 1999)
        THEN 'test' ELSE 'train' END AS split
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey
    JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
    LEFT JOIN (
      SELECT l_orderkey, count(*) AS n, avg(l_quantity) AS q, max(l_quantity) AS q_max,
        min(l_quantity) AS q_min, avg(l_extendedprice) AS p, max(l_extendedprice) AS p_max,
        min(l_extendedprice) AS p_min, avg(l_discount) AS d, avg(l_tax) AS t,
        avg(CAST(l_linenumber AS DOUBLE)) AS ln, max(l_linenumber) AS ln_max,
        avg(l_quantity) FILTER (WHERE l_returnflag = 'A') AS qa,
        avg(l_extendedprice) FILTER (WHERE l_returnflag = 'N') AS pn,
        avg(l_tax) FILTER (WHERE l_returnflag = 'R') AS tr,
        count(*) FILTER (WHERE l_returnflag = 'R') AS nr,
        avg(l_discount) FILTER (WHERE l_linestatus = 'O') AS d_o,
        min(l_quantity) FILTER (WHERE l_returnflag <> 'N') AS qr,
        max(l_linenumber) FILTER (WHERE l_linestatus = 'F' AND l_returnflag <> 'A') AS m_f,
        count(*) FILTER (WHERE l_linestatus = 'F') AS n_f,
        count(*) FILTER (WHERE l_returnflag = 'N') AS n_n,
        count(*) FILTER (WHERE l_discount > 0.05) AS n_deal,
        count(*) FILTER (WHERE l_quantity > 40) AS n_big
      FROM {lineitem} GROUP BY l_orderkey) AS li ON o_orderkey = l_orderkey) AS a
"""

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
         "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
_AS_IS = {n: n for n in NAMES}
CASES = f"cases AS ({CASES_BODY.format(**_AS_IS)})"
APPLICANTS = f"applicants AS ({APPLICANTS_BODY.format(**_AS_IS)})"
WITH_CASES = "WITH " + CASES
WITH_APPLICANTS = "WITH " + APPLICANTS

SPEC = TableSpec(id="student_id", target="score", year="application_year", text="feedback")
NOT_FEATURES = ("split", "feedback", "hobby", "preferred_social_media_platform")


class Tables:
    """The given tables of one folder, read on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._stored: DataFrame | None = None

    def __call__(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.sf_dir}/{name}.parquet")

    def _view(self, body: str) -> DataFrame:
        used = {n: self(n) for n in NAMES if "{" + n + "}" in body}
        return self.spark.sql(body, **used)

    def cases(self, split: str | None = None) -> DataFrame:
        df = self._view(CASES_BODY)
        return df.where(F.col("split") == split) if split else df

    def applicants(self, split: str | None = None) -> DataFrame:
        df = self._view(APPLICANTS_BODY)
        if split:
            df = df.where(F.col("split") == split)
        return df.drop("score") if split == "test" else df

    def stored_applicants(self, *cols: str) -> DataFrame:
        """These columns of the training applicants written once, for operators that read them several times."""
        from foldwise.scratch import written
        return written(self.applicants("train").select(*cols))

    def stored_cases(self, split: str | None = None) -> DataFrame:
        """The cases view written once, for queries that read it several times."""
        from foldwise.scratch import written
        if self._stored is None:
            self._stored = written(self.cases())
        df = self._stored
        return df.where(F.col("split") == split) if split else df

    def train_folds(self, seeds=(42,), splits: int = 5) -> DataFrame:
        """Training cases with one fold per repeat, strata target bin x year."""
        from foldwise.operators.folds import repeated_folds
        train = self.stored_cases("train")
        dealt = repeated_folds(train, "row_id", "y", seeds, splits, "yr")
        return train.join(dealt, "row_id")

    def predictions(self) -> DataFrame:
        """Out-of-fold predictions of three simple predictors, two repeats."""
        from foldwise.operators.encode import left_out_means
        from foldwise.scratch import written
        df = written(self.train_folds((42, 2025)))
        parts = [left_out_means(df, key, "y", "fold", ["repeat"]).withColumn("model", F.lit(model))
                 for model, key in (("by_group", "grp"), ("by_year", "yr"), ("overall", None))]
        cols = ["row_id", "repeat", "fold", "model", "y", "pred"]
        return parts[0].select(cols).unionByName(parts[1].select(cols)).unionByName(
            parts[2].select(cols))
