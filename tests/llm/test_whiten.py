"""Whitening against an eigendecomposition of the exact covariance."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import whiten
from foldwise.llm.common import Scratch
from foldwise.llm.queries import QUERIES
from tests.oracle import ROOT


def run(spark, rows, k=16):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("component", F.lit("clash")).withColumn("x", F.lit(1))
    vectors = df.select(F.col("vec_id").alias("id"), whiten.integers("embedding", 64, 1_000_000).alias("x"))
    return whiten.project(vectors, whiten.fit(vectors, Scratch(spark), k)).collect()


def compare(got, rows, k=16):
    """Against numpy on the same integers; components by absolute value, as their sign is free."""
    good = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array(sorted({tuple(v) for _, v in good}), dtype=object)
    n, sums = len(x), x.sum(axis=0)
    a = np.array([[float(Fraction(int(n * v - s), n)) for v, s in zip(r, sums)] for r in x])
    _, sigma, right = np.linalg.svd(a, full_matrices=False)
    rank = int((sigma > 1e-11 * sigma[0]).sum())
    k = min(k, rank)
    want = {}
    for i, v in good:
        apart = [n * c - s for c, s in zip(v, sums)]
        w = np.array([float(Fraction(int(c), n)) for c in apart]) @ right[:k].T / (sigma[:k] / math.sqrt(n))
        for c in range(k):
            want.setdefault((i, c + 1), []).append((sum(c * c for c in apart), abs(w[c]), sigma[c] ** 2 / (sigma ** 2).sum()))
    assert len(got) == sum(map(len, want.values()))
    for r in got:
        options = want[r["vec_id"] if "vec_id" in r else r["id"], r["component"]]
        assert any(r["deviation"] == d and math.isclose(abs(r["whitened"]), w, rel_tol=1e-6, abs_tol=1e-7)
                   and math.isclose(r["explained"], e, rel_tol=1e-9) for d, w, e in options)
        assert r["n"] == n and r["identity_error"] < 1e-8


def test_given_table(spark):
    got = QUERIES["op13_embedding_whitening"](spark, f"{ROOT}/sf0.01").collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{ROOT}/sf0.01/embeddings.parquet").collect()]
    compare(got, rows)


def test_nulls_repeats_and_lengths(spark):
    rng = np.random.default_rng(1)
    rows = [(i, list(map(float, rng.normal(size=5)))) for i in range(40)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [1.0, float("nan"), 2.0, 3.0, 4.0]), (104, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    rows += [(7, rows[3][1])] * 3 + [(None, rows[5][1])]
    got = run(spark, rows + odd + [(105, [1.0, 2.0])])
    assert not {100, 101, 102, 103, 104, 105} & {r["id"] for r in got}
    compare(got, rows)


def test_dependent_and_constant_dimensions(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-50, 50, size=(60, 3)) / 64
    rows = [(i, [float(v) for v in (*b, b[0] + b[1], 0.5, b[2])]) for i, b in enumerate(base)]
    got = run(spark, rows)
    assert {r["component"] for r in got} == {1, 2, 3}
    compare(got, rows)


def test_fewer_vectors_than_dimensions(spark):
    rng = np.random.default_rng(3)
    rows = [(i, list(map(float, rng.normal(size=12)))) for i in range(5)]
    got = run(spark, rows)
    assert {r["component"] for r in got} == {1, 2, 3, 4}
    compare(got, rows)


def test_widely_spread_scales(spark):
    """Condition 10**9, far beyond what one Cholesky factor of the Gram matrix can tell from noise."""
    rng = np.random.default_rng(4)
    mix = np.linalg.qr(rng.normal(size=(6, 6)))[0]
    data = rng.normal(size=(300, 6)) * np.array([1e9, 1e7, 1e5, 1e3, 1e2, 20]) @ mix
    rows = [(i, list(map(float, v))) for i, v in enumerate(data)]
    got = run(spark, rows)
    assert {r["component"] for r in got} == set(range(1, 7)) and all(r["identity_error"] < 1e-4 for r in got)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_no_components(spark, rows):
    assert run(spark, rows) == []


def test_solve_and_factor():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(30, 4))
    r, shifted = whiten.factor(a.T @ a, 1e-14, False)
    q = whiten.solve(a, r)
    assert not shifted and np.allclose(q.T @ q, np.eye(4)) and np.allclose(q @ r, a)
    assert whiten.factor(np.diag([1.0, 0.0]), 1e-14, False)[1]
