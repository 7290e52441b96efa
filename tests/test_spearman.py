"""Rank correlations against pandas, by buckets of few rows; values with very many rows; what is shuffled."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from foldwise.operators import profile


def table(n=3000):
    rng = np.random.default_rng(0)
    y = np.round(np.minimum(rng.normal(size=n) * 30 + 60, 100.0), 1)  # a good part stands at the ceiling
    return pd.DataFrame({
        "plain": y + rng.normal(size=n) * 20, "few": rng.integers(0, 3, n).astype(float), "one": np.ones(n),
        "holes": np.where(rng.random(n) < 0.4, np.nan, -y + rng.normal(size=n)),
        "hot": np.where(rng.random(n) < 0.8, 0.0, y), "none": np.nan, "y": np.where(rng.random(n) < 0.05, np.nan, y)})


@pytest.mark.parametrize("bucket_rows", [100_000, 150])
def test_rank_correlations(spark, bucket_rows):
    pdf = table()
    rows = [tuple(None if v != v else float(v) for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in pdf.columns)).repartition(3)
    cols = list(pdf.columns[:-1])
    got = {r["name"]: r["rho"] for r in profile.spearman(df, cols, "y", bucket_rows).collect()}
    assert set(got) == set(cols) - {"none"} and got["one"] is None
    for c in ("plain", "few", "holes", "hot"):
        both = pdf[[c, "y"]].dropna()
        assert abs(got[c] - both[c].rank().corr(both["y"].rank())) < 1e-12


def test_nan_and_negative_zero_are_values(spark):
    df = spark.createDataFrame([(float(x), float(y)) for x, y in [(0.0, 1), (-0.0, 2), (1, 3), (float("nan"), 4), (float("nan"), 5)]], "a double, y double")
    want = pd.Series([1.5, 1.5, 3, 4.5, 4.5]).corr(pd.Series([1.0, 2, 3, 4, 5]))
    assert abs(profile.spearman(df, ["a"], "y", 2).first()["rho"] - want) < 1e-12


def test_rows_are_shuffled_twice(spark):
    """Once by their target and once by value: the plan has no join and no window."""
    df = spark.createDataFrame([(float(i % 17), float(i)) for i in range(500)], "a double, y double")
    made = profile.spearman(df, ["a"], "y", 50)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and abs(made.first()["rho"]) < 0.2
