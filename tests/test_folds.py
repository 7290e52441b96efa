import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from foldwise.operators import encode, folds
from foldwise.operators.quantiles import exact_quantiles
from foldwise.operators.ranks import average_rank, hash_rank, running_before, sorted_codes
from foldwise.scratch import written


def sample(spark, n=900):
    """A third of the rows sits at the ceiling, one category holds a third."""
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(100.0)).otherwise(
            (F.col("id") * 37 % 101).cast("double")).alias("y"),
        (F.col("id") * 7 % 4 + 2000).cast("int").alias("yr"),
        F.when(F.col("id") % 3 == 1, F.lit("hot")).when(F.col("id") % 50 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("c"), (F.col("id") % 9).cast("string"))).alias("cat"))


def test_folds_are_balanced_and_stable(spark):
    df = sample(spark)
    made = folds.make_folds(folds.with_bins(df, "y", 10), "id", "y", year="yr")
    pdf = made.toPandas()
    assert len(pdf) == 900 and set(pdf["fold"]) == set(range(5))
    per_stratum = pdf.groupby(["bin", "yr", "fold"]).size().unstack(fill_value=0)
    assert (per_stratum.max(axis=1) - per_stratum.min(axis=1)).max() <= 1
    sizes = pdf["fold"].value_counts()
    assert sizes.max() - sizes.min() <= 1
    key = lambda d: d.select("id", "fold").orderBy("id").collect()
    for parts in (1, 17):
        assert key(folds.make_folds(df.repartition(parts), "id", "y", year="yr")) == key(made)


def test_hash_buckets_do_not_change_ranks(spark):
    df = sample(spark)
    plain = hash_rank(df, "id", 3, ["cat"]).select("id", "rank").orderBy("id").collect()
    cut = hash_rank(df, "id", 3, ["cat"], bucket_rows=20).select("id", "rank").orderBy("id").collect()
    assert plain == cut


def test_running_totals_in_buckets(spark):
    grouped = sample(spark).groupBy("y").agg(F.count(F.lit(1)).alias("n"))
    a = running_before(grouped, "y", ["n"]).orderBy("y").collect()
    b = running_before(grouped, "y", ["n"], bucket_rows=7).select("y", "n", "n_before").orderBy("y").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    names = spark.range(400).select(F.md5(F.col("id").cast("string")).alias("v"))
    import foldwise.operators.ranks as ranks
    small, ranks.BUCKET_ROWS = ranks.BUCKET_ROWS, 30
    try:
        one = names.withColumn("n", F.lit(1))
        cut = running_before(one, "v", ["n"], bucket_rows=30).orderBy("v").collect()
    finally:
        ranks.BUCKET_ROWS = small
    assert [r["n_before"] for r in cut] == list(range(400))
    assert [r["code"] for r in sorted_codes(names, "v").orderBy("v").collect()] == list(range(400))


def test_average_rank_matches_pandas(spark):
    df = sample(spark)
    got = df.join(average_rank(df, "y").withColumnRenamed("y", "v"), F.col("y") == F.col("v")).toPandas()
    want = got["y"].rank(method="average")
    assert np.allclose(got["rank"], want)


def test_quantiles_narrowed_and_plain(spark):
    df = sample(spark).withColumn("x", F.when(F.col("id") % 11 != 0, F.sin("id") * 100))
    x = df.toPandas()["x"].dropna().to_numpy()
    probs = [0.0, 0.1, 0.333, 0.5, 0.9, 1.0]
    want = np.quantile(x, probs)
    for cells in (10, 10_000):
        got = exact_quantiles(df, {"x": (F.col("x"), probs)}, direct_cells=cells)["x"]
        assert np.allclose(got, want, rtol=0, atol=1e-12)
    tied = exact_quantiles(df, {"y": (F.col("y"), probs)}, direct_cells=50)["y"]
    assert np.allclose(tied, np.quantile(df.toPandas()["y"], probs))
    assert exact_quantiles(df, {"n": (F.lit(None).cast("double"), [0.5])})["n"] == [None]


def test_bins_follow_right_closed_quantiles(spark):
    df = sample(spark)
    pdf = folds.with_bins(df, "y", 20).toPandas()
    want = pd.qcut(pdf["y"], 20, labels=False, duplicates="drop")
    assert (pdf["bin"] == want).all()


def test_nested_means_equal_refits(spark):
    df = folds.make_folds(sample(spark, 400), "id", "y", 3)
    nested = folds.inner_folds(df, "id", "y", splits=3, inner=2).cache()
    got = {(r["id"], r["outer"]): r["value"]
           for r in encode.nested_means(nested, "id", "cat", "y").collect()}
    pdf = nested.toPandas()
    pdf["cat"] = pdf["cat"].fillna("nan")
    assert len(got) == 1200
    for k in range(3):
        part = pdf[pdf.outer == k]
        train = part[part.inner >= 0]
        for j in (-1, 0, 1):
            fit = train[train.inner != j]
            prior = fit.y.mean()
            cells = fit.groupby("cat").y.agg(["sum", "count"])
            enc = (cells["sum"] + prior * 20) / (cells["count"] + 20)
            rows = part[part.inner == j]
            want = rows.cat.map(enc).fillna(prior)
            assert np.allclose([got[(i, k)] for i in rows.id], want, atol=1e-9)


def test_validation_targets_do_not_leak(spark):
    """Changing the targets of a fold must not move that fold's own features."""
    base = folds.make_folds(sample(spark, 400), "id", "y", 3).cache()
    moved = base.withColumn("y", F.when(F.col("fold") == 1, F.col("y") * 0 + 1).otherwise(F.col("y")))

    def held_values(df):
        nested = folds.inner_folds(df, "id", "y", splits=3, inner=2)
        values = encode.nested_means(nested, "id", "cat", "y").where("outer = 1")
        return values.orderBy("id").collect()
    assert held_values(base) == held_values(moved)


def test_year_weights(spark):
    train = spark.createDataFrame([(i, 2000 + i % 4) for i in range(40)], "id long, yr int")
    test = spark.createDataFrame([(i, 2001 + i % 3 // 2) for i in range(30)], "id long, yr int")
    got = folds.year_weights(train, test, "yr").toPandas()
    assert len(got) == 40 and abs(got["w"].mean() - 1) < 1e-12
    ratio = {2000: 1.0, 2001: min(3.0, (20 / 30) / 0.25), 2002: (10 / 30) / 0.25, 2003: 1.0}
    raw = got["yr"].map(ratio)
    assert np.allclose(got["w"], raw / raw.mean())


def test_many_buckets_stay_small(spark):
    """Ordered buckets of numbers and of texts hold even shares at any number, also for groups of other scales."""
    from foldwise.operators.ranks import _bucket
    rows = spark.range(40_000).selectExpr("id % 2 AS g", "CASE WHEN id % 2 = 0 THEN id * 1e-9 ELSE exp(id / 2000) END AS v",
                                          "md5(CAST(id AS STRING)) AS t")
    for order in ("v", "t"):
        cut = _bucket(rows, ["g"], order, 1000)
        sizes = [r["count"] for r in cut.groupBy("__b").count().collect()]
        assert len(sizes) > 900 and max(sizes) < 0.01 * 40_000
        edges = cut.groupBy("g", "__b").agg({order: "min"}).orderBy("g", "__b").collect()
        for a, b in zip(edges, edges[1:]):
            assert a["g"] != b["g"] or a[2] < b[2]


@pytest.mark.parametrize("twice", [False, True])
def test_inner_folds_hand_on_the_named_columns_alone(spark, twice):
    rows = [(i, float(i % 17), i % 5, f"g{i % 3}", "long") for i in range(200)] + ([(7, 3.0, 1, "g0", "long")] if twice else [])
    df = written(spark.createDataFrame(rows, "id long, y double, fold int, grp string, other string"))
    whole = folds.inner_folds(df, "id", "y")
    for keep in ([], ["grp"]):
        some = folds.inner_folds(df, "id", "y", keep=keep)
        assert "other" not in some.columns
        cols = ["id", "y", "fold", "outer", "inner", *keep]
        assert sorted(some.select(cols).collect()) == sorted(whole.select(cols).collect())
