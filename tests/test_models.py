import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.functions.rows import row_max, row_mean, row_std
from foldwise.operators import (cross, ensemble, explain, folds, hurdle, learners, metrics, neighbors, study)


def planted(spark, n=1200):
    """A linear signal with an interaction, a ceiling, and nulls tied to a lower target."""
    u = lambda s: ((F.xxhash64(F.lit(s), "id") % 1000000) / 1e6 + 1) / 2
    df = spark.range(n).select("id", *[(u(s) * 10).alias(f"x{s}") for s in range(4)], u(9).alias("e"))
    y = 30 + 5 * F.col("x0") + 3 * F.col("x1") + 0.4 * F.col("x0") * F.col("x2") + 6 * (F.col("e") - 0.5)
    df = df.withColumn("hole", F.col("id") % 7 == 0)
    y = F.least(F.lit(100.0), y - F.when(F.col("hole"), 8).otherwise(0))
    return df.select("id", "x0", "x1", "x2", F.when(~F.col("hole"), F.col("x3")).alias("x3"),
                     F.col("hole").cast("int").alias("x3_missing"), y.alias("y"), (F.col("e") + 0.5).alias("w"))


NAMES = ["x0", "x1", "x2", "x3", "x3_missing"]


@pytest.fixture(scope="module")
def data(spark):
    df = planted(spark)
    return folds.make_folds(df, "id", "y", 3).cache()


def bundle_of(data):
    dealt = data.select("id", F.lit(0).alias("repeat"), "fold")
    return cross.Bundle(data.drop("fold"), dealt, "id", "y", NAMES, splits=3)


def test_row_reductions_skip_nulls(spark):
    df = spark.createDataFrame([(1.0, None, 4.0), (None, None, None), (2.0, None, None)], "a double, b double, c double")
    got = df.select(row_mean(df.columns).alias("m"), row_std(df.columns).alias("s"), row_max(df.columns).alias("x")).collect()
    assert [r["m"] for r in got] == [2.5, None, 2.0]
    assert abs(got[0]["s"] - np.std([1, 4], ddof=1)) < 1e-12 and got[1]["s"] is None and got[2]["s"] is None
    assert [r["x"] for r in got] == [4.0, None, 2.0]


@pytest.mark.parametrize("name", list(learners.LEARNERS))
def test_learners_beat_the_mean(name, data):
    params = {"boosted": {"rounds": 15, "depth": 4}, "forest": {"trees": 10, "depth": 6},
              "factor": {"rounds": 60, "factors": 2}, "ridge": {}}[name]
    spread = data.agg(F.var_pop("y")).first()[0]
    assert cross.quick_score(bundle_of(data), name, params) < 0.6 * spread


def test_ridge_closed_form(data):
    made = data.select("y", "w", learners.Inputs(["x0", "x1", "x2"], {}).vector().alias("features"))
    pdf = data.toPandas()
    for weight in (None, "w"):
        model = learners.fit_ridge(made, "y", 7.0, weight)
        w = pdf["w"].to_numpy() if weight else np.ones(len(pdf))
        x, y = pdf[["x0", "x1", "x2"]].to_numpy(), pdf["y"].to_numpy()
        mx, my = np.average(x, axis=0, weights=w), np.average(y, weights=w)
        c = (x - mx) * w[:, None]
        beta = np.linalg.solve(c.T @ (x - mx) + 7 * np.eye(3), c.T @ (y - my))
        assert np.allclose(model.coefficients, beta, atol=1e-8)
        assert abs(model.intercept - (my - beta @ mx)) < 1e-7


def test_saved_learner_predicts_the_same(spark, data, tmp_path):
    for name in ("ridge", "boosted"):
        model = learners.fit(name, {"rounds": 3} if name == "boosted" else {}, data, "id", "y", NAMES)
        learners.save(model, f"{tmp_path}/{name}", spark)
        again = learners.load(f"{tmp_path}/{name}", spark)
        assert model.predict(data).orderBy("id").collect() == again.predict(data).orderBy("id").collect()


def test_exact_auc(spark, data):
    df = data.select((F.round("x0", 1)).alias("s"), (F.col("y") > 70).cast("int").alias("h"))
    pdf = df.toPandas()
    p, n = pdf.s[pdf.h == 1].to_numpy(), pdf.s[pdf.h == 0].to_numpy()
    want = ((p[:, None] > n).sum() + 0.5 * (p[:, None] == n).sum()) / (len(p) * len(n))
    for rows in (10, 100_000):
        assert abs(metrics.auc(df, "s", "h", bucket_rows=rows).first()[0] - want) < 1e-12


def brute(x, y, groups, k):
    d = np.sqrt(((x[:, None, :] - x[None]) ** 2).sum(axis=2))
    d[groups[:, None] == groups[None]] = np.inf
    out = []
    for i in range(len(x)):
        near = np.lexsort((np.arange(len(x)), d[i]))[:k]
        zero = d[i, near] == 0
        out.append(y[near][zero].mean() if zero.any() else np.average(y[near], weights=1 / d[i, near]))
    return np.array(out)


@pytest.mark.parametrize("pivots", [0, 6])
def test_neighbours_match_brute_force_with_a_hot_copy(spark, pivots):
    """A third of the vectors are copies of one; blocks are small, so hot cells are cut."""
    rng = np.random.RandomState(1)
    x = rng.normal(size=(240, 3)).round(3)
    x[::3] = x[0]
    y, g = rng.normal(size=240), np.arange(240) % 4
    rows = [(i, [float(v) for v in x[i]], float(y[i]), int(g[i])) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y double, g int")
    found = neighbors.nearest(df, df.withColumnRenamed("id", "donor"), "id", "donor", "v", "y", 5, "g",
                              block_rows=16, pivots=pivots)
    got = neighbors.distance_weighted(found, ["id"]).orderBy("id").toPandas()["pred"]
    assert np.allclose(got, brute(x, y, g, 5))


def test_imputation_matches_brute_force(spark):
    rng = np.random.RandomState(2)
    x = rng.normal(size=(80, 3)).round(2)
    x[rng.rand(80, 3) < 0.25] = np.nan
    x[:5] = [0.5, np.nan, np.nan]
    cols = ["a", "b", "c"]
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    got = neighbors.knn_impute(df, df, "id", cols, 4, block_rows=16).orderBy("id").toPandas()[cols].to_numpy()
    for i in range(80):
        for j in range(3):
            if not np.isnan(x[i, j]):
                assert got[i, j] == x[i, j]
                continue
            have = np.flatnonzero(~np.isnan(x[:, j]))
            both = ~np.isnan(x[i]) & ~np.isnan(x[have])
            gap = np.where(both, (x[i] - x[have]) ** 2, 0).sum(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                d = np.where(both.sum(axis=1) > 0, gap * 3 / both.sum(axis=1), np.inf)
            near = have[np.lexsort((have, d))][:4]
            near = near[np.isfinite(np.sort(d)[:4])]
            want = x[near, j].mean() if len(near) else np.nanmean(x[:, j])
            assert abs(got[i, j] - want) < 1e-9


def test_blend_weights_are_convex_and_best(data):
    rng = np.random.RandomState(0)
    for _ in range(30):
        m = rng.randint(2, 7)
        p, y, w = rng.normal(size=(50, m)), rng.normal(size=50), rng.rand(50) + 0.1
        s = ensemble.Moments(tuple(map(str, range(m))), 50, w.sum(), p.T @ w, (p * w[:, None]).T @ p,
                             p.T @ (w * y), w @ y, w @ (y * y), p.sum(axis=0), (p * p).sum(axis=0))
        x = ensemble.convex_weights(s)
        assert (x >= 0).all() and abs(x.sum() - 1) < 1e-9
        for _ in range(60):
            other = rng.dirichlet(np.ones(m) * 0.5)
            assert s.mse(x) <= s.mse(other) + 1e-9
        assert abs(s.mse(x) - np.average((y - p @ x) ** 2, weights=w)) < 1e-9


def test_ridge_stack_penalty_is_exact_leave_one_out(data):
    df = data.where("id < 60").withColumn("a", F.col("x0") * 4 + 40).withColumn("b", F.col("x1") * 3 + 50)
    pdf = df.toPandas()
    z, y, w = pdf[["a", "b"]].to_numpy(), pdf["y"].to_numpy(), pdf["w"].to_numpy()
    zs = (z - z.mean(axis=0)) / (z.std(axis=0) + 1e-9)
    errors = []
    for alpha in ensemble.ALPHAS:
        total = 0.0
        for i in range(len(y)):
            k = np.arange(len(y)) != i
            mx, my = np.average(zs[k], axis=0, weights=w[k]), np.average(y[k], weights=w[k])
            c = (zs[k] - mx) * w[k][:, None]
            beta = np.linalg.solve(c.T @ (zs[k] - mx) + alpha * np.eye(2), c.T @ (y[k] - my))
            total += w[i] * (y[i] - my - (zs[i] - mx) @ beta) ** 2
        errors.append(total)
    stack = ensemble.ridge_stack(df, ["a", "b"], "y", "w")
    assert np.isclose(stack.details["alpha"], ensemble.ALPHAS[int(np.argmin(errors))])


def test_referee_does_not_fall_for_noise(data):
    df = data.withColumns({"good": F.col("y") + (F.col("w") - 1) * 10, "noise": F.lit(50.0) + F.col("x3_missing")})
    scores = ensemble.honest_comparison(df, "id", ["good", "noise"], "y", "w", ["x0"], repeats=1, splits=3, rounds=3)
    means = {r["method"]: r["wmse"] for r in ensemble.referee_means(scores).collect()}
    assert means["single_good"] < means["blend_equal"] < means["single_noise"]
    assert means["blend_optimized"] <= means["single_good"] * 1.05
    direct = df.agg(metrics.weighted_mse("y", "good", "w")).first()[0]
    assert abs(means["single_good"] - direct) < 0.2 * direct


def test_calibration_is_monotone(data):
    df = data.select("id", F.col("x0").alias("s"), (F.col("y") >= 80).cast("int").alias("hit"), "w")
    made = hurdle.fit_calibration(df, "s", "hit", "w").transform(df, "s", "p").orderBy("s").toPandas()
    assert made["p"].is_monotonic_increasing and made["p"].between(0, 1).all()


def test_two_part_predictions_stay_in_range(data):
    s = hurdle.hurdle_study(data, "id", "y", NAMES, 3, weight="w", params={"rounds": 5, "depth": 3}, rounds=4, depth=3)
    pdf = s.toPandas()
    assert len(pdf) == 1200 and pdf["hurdle"].between(0, 100).all() and pdf["p_cal"].between(0, 1).all()
    assert pdf["hurdle"].isna().sum() == 0


def test_shapley_values_add_up(data):
    model = learners.fit("boosted", {"rounds": 4, "depth": 3}, data, "id", "y", NAMES)
    made = model.inputs.apply(data, ["id"]).cache()
    phi = explain.shapley_attribution(model.model, made, "id", NAMES, orders=2)
    sums = {r["id"]: r["s"] for r in phi.groupBy("id").agg(F.sum("phi").alias("s")).collect()}
    pairs = explain.with_donors(made, "id", 1)
    own = {r["id"]: r["prediction"] for r in model.model.transform(made).collect()}
    base = {r["id"]: r["prediction"] for r in model.model.transform(
        pairs.select("id", F.col("__donor").alias("features"))).collect()}
    assert len(sums) == 1200
    assert max(abs(sums[i] - (own[i] - base[i])) for i in sums) < 1e-9


def test_permutation_of_a_constant_is_worth_nothing(data):
    df = data.withColumn("flat", F.lit(3.0))
    found = study.permutation_ranking(df, "id", "y", ["x0", "x1", "flat"], params={"rounds": 8, "depth": 3}, repeats=2)
    got = {r["feature"]: r["importance"] for r in found.collect()}
    assert abs(got["flat"]) < 1e-9 and got["x0"] > got["x1"] > 0


def test_donors_are_a_permutation(data):
    made = data.select("id", F.array(F.col("id").cast("double")).alias("features"))
    pairs = explain.with_donors(made, "id", 2).toPandas()
    for _, part in pairs.groupby("repeat"):
        donors = part["__donor"].str[0].astype(int)
        assert sorted(donors) == sorted(part["id"]) and (donors != part["id"]).all()


def test_nested_learner_does_not_leak(data):
    moved = data.withColumn("y", F.when(F.col("fold") == 1, F.lit(1.0)).otherwise(F.col("y")))

    def build(fit):
        model = learners.fit("ridge", {}, fit, "id", "y", ["x0", "x1"])
        return lambda rows: model.predict(rows, out="value")

    def held(df):
        values, _ = cross.nested_feature(df, build, "id", "y", splits=3, inner=2)
        own = values.where("outer = 1").join(df.where("fold = 1").select("id"), "id")
        return own.orderBy("id").toPandas()["value"].to_numpy()
    assert np.allclose(held(data), held(moved), atol=1e-9)


def test_search_resumes(spark, tmp_path):
    calls = []

    def score(params, k):
        calls.append(params["alpha"])
        return abs(np.log(params["alpha"])) + k
    space = {"alpha": ("log", 0.1, 10.0)}
    path = f"{tmp_path}/trials"
    cross.search(spark, "m", space, score, 2, 3, 60, path)
    assert len(calls) == 6
    trials = cross.search(spark, "m", space, score, 2, 5, 60, path)
    assert len(calls) == 10 and trials.count() == 5
    best = cross.best_params(trials)["m"]["alpha"]
    assert abs(np.log(best)) == min(abs(np.log(c)) for c in calls)


def test_every_level_has_its_own_column(spark):
    from foldwise.operators import learners
    df = spark.range(400).selectExpr("id", "CAST(id % 200 AS INT) AS c", "CAST(id AS DOUBLE) AS x", "CAST(id AS DOUBLE) AS y")
    inputs = learners.fit_inputs(df, ["x", "c"], scaled=True, codes=["c"])
    rows = inputs.apply(df, ["id", "c"]).collect()
    assert inputs.levels == {"c": 200} and len(inputs.vector_names) == 201 == rows[0]["features"].size
    for r in rows:
        v = r["features"].toArray()[1:]
        assert v.sum() == 1 and v[r["c"]] == 1
    unseen = inputs.apply(spark.sql("SELECT 1 AS id, -1 AS c, 0.0D AS x UNION ALL SELECT 2, 999, 0.0D"), ["id"]).orderBy("id").collect()
    assert unseen[0]["features"].toArray()[1] == 1 and unseen[1]["features"].toArray()[1:].sum() == 0


def test_waterfall_keeps_all_rows_asked_for(spark):
    from foldwise.operators import explain
    phi = spark.range(500).selectExpr("id", "'f' AS feature", "CAST(id AS DOUBLE) AS phi")
    rows = spark.range(500).selectExpr("id", "CAST(id AS STRING) AS tag")
    assert explain.waterfall(phi, rows, "id").count() == 500


def test_middle_row_among_many_ties(spark):
    from foldwise.operators import explain
    df = spark.range(1001).selectExpr("id", "CASE WHEN id < 10 THEN 1.0D WHEN id < 990 THEN 2.0D ELSE 3.0D END AS p")
    got = {r["tag"]: r["id"] for r in explain.spread_rows(df, "id", "p").collect()}
    assert got == {"low": 0, "median": 500, "high": 990}


def test_ridge_has_one_answer_at_any_width_and_offset(spark):
    import numpy as np
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from foldwise.operators import learners
    rng = np.random.default_rng(4)
    for width, offset in ((20, 0.0), (21, 1e6), (2100, 0.0)):
        n = 60
        x, w = rng.normal(size=(n, width)) + offset, rng.random(n) + 0.5
        y = x[:, :3].sum(1) + rng.normal(size=n)
        df = spark.createDataFrame([(r.tolist(), float(t), float(v)) for r, t, v in zip(x, y, w)], "a array<double>, y double, w double")
        model = learners.fit_ridge(df.select("y", "w", array_to_vector(F.col("a")).alias("features")), "y", 3.0, "w")
        xc, yc = x - (w @ x) / w.sum(), y - (w @ y) / w.sum()
        want = np.linalg.solve((xc * w[:, None]).T @ xc + 3.0 * np.eye(width), (xc * w[:, None]).T @ yc)
        assert np.abs(model.coefficients - want).max() < 1e-6


def test_text_vectors_do_not_depend_on_partitions(spark):
    from foldwise.operators import reduce
    words = "alpha beta gamma delta epsilon zeta".split()
    rows = [(i, " ".join(words[(i * k) % 6] for k in range(1, 12))) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, text string")
    found = []
    for parts in (1, 5):
        model = reduce.fit_text_vectors(df.repartition(parts), "text", dims=4)
        found.append({r["word"]: r["v"] for r in model.table.collect()})
    assert set(found[0]) == set(found[1]) == set(words)
    assert all(abs(a - b) < 1e-9 for w in words for a, b in zip(found[0][w], found[1][w]))


def test_correlation_matrix_over_pairs_with_nulls(spark):
    import numpy as np

    from foldwise.operators import profile
    rng = np.random.default_rng(9)
    x = rng.normal(size=(200, 4)) + 1e5
    x[:, 1] += x[:, 0]
    x[:, 3] = 7.0
    mask = rng.random((200, 4)) < 0.2
    rows = [[None if m else float(v) for v, m in zip(r, ms)] for r, ms in zip(x, mask)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r["a"], r["b"]): r["r"] for r in profile.correlation_matrix(df, ["a", "b", "c", "d"]).collect()}
    for i, p in enumerate("abcd"):
        for j in range(i + 1, 4):
            both = ~(mask[:, i] | mask[:, j])
            if j == 3:
                assert got[p, "d"] is None
            else:
                assert abs(got[p, "abcd"[j]] - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-9


def test_lookups_with_one_level_in_most_rows(spark, monkeypatch):
    """A level that holds nine tenths of the rows, with tables too large to broadcast."""
    from foldwise import scratch
    from foldwise.operators import encode, profile
    monkeypatch.setattr(scratch, "SMALL_BYTES", 0)
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 10 < 9 THEN 'hot' ELSE CAST(id AS STRING) END AS c",
                                      "CAST(id % 7 AS DOUBLE) AS y", "CASE WHEN id % 10 < 9 THEN 1 ELSE id END AS v")
    means = {r["c"]: r["te"] for r in encode.smoothed_means(df, "c", "y").collect()}
    rows = encode.smoothed_lookup(df, df, "c", "y").collect()
    assert len(rows) == 3000 and all(abs(r["te_c"] - means[r["c"]]) < 1e-12 for r in rows)
    ranks = profile.fractional_ranks(df, "id", "v", "r").collect()
    assert len(ranks) == 3000 and sum(abs(r["r"] - 1350.5 / 3000) < 1e-9 for r in ranks) >= 2700
