"""Operators that must hold where one level, one score or one word has most rows: results, and how rows lie in partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise import scratch
from foldwise.operators import encode, hurdle, lookups, profile, quantiles, reduce


def pava(x, y, w):
    blocks = []
    for s, v, k in sorted(zip(x, y, w)):
        blocks.append([v * k, k, [s]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] > blocks[-1][0] / blocks[-1][1]:
            t, k2, s2 = blocks.pop()
            blocks[-1][0] += t
            blocks[-1][1] += k2
            blocks[-1][2] += s2
    return {s: t / k for t, k, ss in blocks for s in ss}


@pytest.mark.parametrize("shape,large", [("noise", False), ("rising", False), ("falling", False), ("late", False), ("noise", True), ("rising", True)])
def test_isotonic_fit_over_many_ranges(spark, monkeypatch, shape, large):
    if large:  # steps that do not go to the tasks as numbers
        monkeypatch.setattr(scratch, "SMALL_BYTES", 0)
    rng = np.random.default_rng(3)
    x = np.arange(600) / 10
    y = {"noise": (rng.random(600) < x / 60).astype(float), "rising": x / 60, "falling": 1 - x / 60,
         "late": np.where(np.arange(600) < 590, x / 60, 0.0)}[shape]
    w = np.where(np.arange(600) >= 590, 200.0, 1.0)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(x, y, w)], "s double, y double, w double").repartition(4)
    made = hurdle.fit_calibration(df, "s", "y", "w", range_rows=120)
    want = pava(x, y, w)
    probe = spark.createDataFrame([(float(s),) for s in [*x, -5.0, 100.0]] + [(None,)], "s double")
    got = {r["s"]: r["p"] for r in made.transform(probe, "s", "p").collect()}
    assert got[None] is None and all(abs(got[s] - p) < 1e-9 for s, p in want.items())
    assert got[-5.0] == got[0.0] and got[100.0] == got[59.9]
    if shape == "rising":
        assert made.steps.count() == 600 and made.steps.select("part").distinct().count() >= 5  # no task saw all of it
        between = spark.createDataFrame([(0.05,), (30.05,)], "s double")
        assert all(abs(r["p"] - r["s"] / 60) < 1e-9 for r in made.transform(between, "s", "p").collect())


def hot(spark, n=20_000):
    return spark.range(0, n, 1, 8).selectExpr("id", "CASE WHEN id % 10 < 9 THEN 'hot' WHEN id % 100 = 99 THEN NULL ELSE CAST(id AS STRING) END AS c",
                                               "CAST(id % 7 AS DOUBLE) AS y", "CASE WHEN id % 10 < 9 THEN 1 ELSE id END AS v")


def largest_partition(df):
    return df.groupBy(F.spark_partition_id()).agg(F.count("id").alias("n"), F.sum("m").alias("s")).agg(F.max("n"), F.max("s")).first()[0]  # reads the joined column


@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_hot_level_stays_spread(spark, monkeypatch, how):
    """Nine tenths of the rows have one level and the table is not broadcast: no partition gets more than its share."""
    monkeypatch.setattr(scratch, "SMALL_BYTES", 0)
    for name, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(name, value)
    try:
        df = hot(spark)
        table = df.where("c is not null").groupBy(F.col("c").alias("k")).agg(F.avg("y").alias("m"))
        made = lookups.level_join(df, table, {"k": "c"}, how)
        assert largest_partition(made) < 20_000 * 0.2
        plain = df.join(table, df["c"] == table["k"], how)
        assert largest_partition(plain) > 20_000 * 0.8  # what it would be without
        want = {r["id"]: r["m"] for r in plain.collect()}
        assert {r["id"]: r["m"] for r in made.collect()} == want and made.columns == [*df.columns, "m"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_encodings_and_ranks_with_a_hot_level(spark, monkeypatch):
    small = {r["id"]: r["te_c"] for r in encode.smoothed_lookup(hot(spark), hot(spark), "c", "y").collect()}
    ranks = {r["id"]: r["r"] for r in profile.fractional_ranks(hot(spark), "id", "v", "r").collect()}
    rho = profile.spearman(hot(spark), ["v"], "y").first()["rho"]
    monkeypatch.setattr(scratch, "SMALL_BYTES", 0)
    large = {r["id"]: r["te_c"] for r in encode.smoothed_lookup(hot(spark), hot(spark), "c", "y").collect()}
    assert large.keys() == small.keys() and all(abs(large[i] - small[i]) < 1e-9 for i in small)
    assert {r["id"]: r["r"] for r in profile.fractional_ranks(hot(spark), "id", "v", "r").collect()} == ranks
    assert abs(profile.spearman(hot(spark), ["v"], "y").first()["rho"] - rho) < 1e-9


def test_truncated_svd_against_numpy(spark):
    rng = np.random.default_rng(6)
    x = np.where(rng.random((300, 80)) < 0.1, rng.normal(size=(300, 80)), 0.0) + rng.normal(size=(300, 3)) @ rng.normal(size=(3, 80)) * (rng.random((300, 80)) < 0.2)
    rows = [(i, [(int(j), float(r[j])) for j in np.flatnonzero(r)]) for i, r in enumerate(x)]
    cells = spark.createDataFrame(rows, "id long, cells array<struct<i:int,w:double>>").repartition(5)
    found = reduce.fit_cells_svd(cells, 80, 6)
    _, sigma, right = np.linalg.svd(x)
    assert np.allclose(found.singular_values, sigma[:6], rtol=1e-6) and found.residual < 1e-6
    v = np.zeros((80, 6))
    for r in found.table.collect():
        v[r["term_id"]] = r["v"]
    assert np.allclose(v.T @ v, np.eye(6), atol=1e-9)
    assert np.allclose(np.abs((v * right[:6].T).sum(axis=0)), 1, atol=1e-5)
    again = reduce.fit_cells_svd(cells.repartition(2), 80, 6)
    assert np.allclose(again.singular_values, found.singular_values, rtol=1e-12)


def test_svd_of_little(spark):
    cells = spark.createDataFrame([(1, [(0, 2.0)]), (2, []), (3, None)], "id long, cells array<struct<i:int,w:double>>")
    found = reduce.fit_cells_svd(cells, 3, 2)
    assert abs(found.singular_values[0] - 2) < 1e-12 and found.singular_values[1] < 1e-6
    assert reduce.fit_cells_svd(cells.where("id > 9"), 3, 2).singular_values == [0.0, 0.0]


def test_text_vectors_tell_topics_apart(spark):
    topics = [["cat", "dog", "pet", "fur"], ["stock", "bond", "fund", "bank"]]
    rows = [(i, " ".join(topics[i % 2][(i * k + k) % 4] for k in range(1, 12))) for i in range(200)] + [(500, None), (501, ""), (502, "unseen zzz"), (503, "x")]
    df = spark.createDataFrame(rows, "id long, text string")
    model = reduce.fit_text_vectors(df.where("id < 200"), "text", dims=24)
    got = {r["id"]: np.array(r["embedding"]) for r in model.transform(df).collect()}
    assert len(got) == len(rows) and all(not got[i].any() for i in (500, 501, 502, 503))
    same, other = got[0] @ got[2], got[0] @ got[1]
    assert abs(np.linalg.norm(got[0]) - 1) < 1e-9 and same > 0.8 and same > other + 0.3
    words = {r["word"] for r in model.table.collect()}
    assert words == {w for i, text in rows[:200] for w in text.split()}


def test_every_word_has_a_vector(spark):
    rows = [(i, f"common word{i} next{i}") for i in range(3000)]
    model = reduce.fit_text_vectors(spark.createDataFrame(rows, "id long, text string"), "text", dims=4, rounds=1)
    assert model.table.count() == 6001


@pytest.mark.parametrize("name", ["d12_correlations_after_median_fill", "d13_exact_medians", "b19_auto_interactions", "p05_univariate",
                                  "p10_inflation_of_three", "p11_outliers", "p12_mutual_information", "b22_b24_fill_standardise_clamp"])
def test_joined_tables_are_stored_before_many_reads(spark, monkeypatch, name):
    """What quantiles and correlations are taken from is read from the scratch folder, not joined anew for every pass."""
    import __spark_entry__ as entry
    from tests.conftest import SF
    read = []
    for module, step in ((quantiles, "_grouped"), (profile, "correlation_matrix")):
        whole = getattr(module, step)
        monkeypatch.setattr(module, step, lambda df, *rest, whole=whole: read.extend(df.inputFiles()) or whole(df, *rest))
    entry.queries()[name](spark, SF)
    assert read and all(scratch.run_folder(spark) in f for f in read)


@pytest.mark.parametrize("direct", [0, 10 ** 6])
def test_quantiles_of_many_columns(spark, direct):
    """Forty columns with eleven probabilities each, with nulls, ties, infinities and a column without a value."""
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(900, 40)) * 20)
    x[5, 3], x[6, 3] = np.inf, -np.inf
    rows = [tuple(None if j == 7 or (i + j) % 11 == 0 else float(v) for j, v in enumerate(r)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ", ".join(f"c{j} double" for j in range(40))).repartition(5)
    probs = [i / 10 for i in range(11)]
    found = quantiles.exact_quantiles(df, {c: (F.col(c), probs) for c in df.columns}, direct_cells=direct)
    for j, c in enumerate(df.columns):
        known = sorted(r[j] for r in rows if r[j] is not None)
        for p, got in zip(probs, found[c]):
            at = p * (len(known) - 1)
            if not known:
                assert got is None
            elif np.isfinite(known[int(at)]) and np.isfinite(known[-(-at // 1).__int__()]):
                low, high = known[int(at)], known[int(np.ceil(at))]
                assert got == pytest.approx(low + (high - low) * (at - int(at)))


def test_mutual_information_of_nulls_and_ties(spark):
    rng = np.random.default_rng(8)
    rows = [(None if i % 13 == 0 else float(v), None if i % 7 == 0 else float(w), 1.0) for i, (v, w) in enumerate(rng.integers(0, 6, (500, 2)))]
    df = spark.createDataFrame(rows, "y double, a double, b double").repartition(4)
    got = {r["name"]: r["mi"] for r in profile.mutual_information(df, ["a", "b"], "y", bins=4).collect()}

    def bins(values):
        known = np.array([v for v in values if v is not None])
        edges = sorted(set(np.quantile(known, [0, .25, .5, .75, 1])))
        return [-1 if v is None else sum(e < v for e in (edges[1:-1] if len(edges) > 2 else [])) for v in values]
    by = bins([r[0] for r in rows])
    for i, c in ((1, "a"), (2, "b")):
        bx, total = bins([r[i] for r in rows]), 0.0
        for k in set(zip(bx, by)):
            n = sum(z == k for z in zip(bx, by))
            total += n / 500 * np.log(n * 500 / (bx.count(k[0]) * by.count(k[1])))
        assert got[c] == pytest.approx(total)
