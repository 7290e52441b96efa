"""Work that has to spread over tasks or be done once, whatever the size."""

from __future__ import annotations

from types import SimpleNamespace

from foldwise import catalog

catalog.load()

from foldwise.catalog import streams  # noqa: E402


def test_every_micro_batch_is_read_by_several_tasks(spark):
    df = spark.range(4000).selectExpr("id", "CASE WHEN id % 7 > 0 THEN repeat('a', 3) END AS text")
    tasks = []

    def work(batch):
        tasks.append(batch.rdd.getNumPartitions())
        return batch
    found = streams.streamed(SimpleNamespace(spark=spark), df, work)
    assert len(tasks) == streams.BATCHES and min(tasks) > 1
    assert sorted(r["id"] for r in found.collect()) == list(range(4000))
    assert found.where("text is null").count() == df.where("text is null").count()


def test_the_attribution_stores_only_the_columns_it_reads(tables):
    from foldwise.catalog import explaining, learning
    made = learning.bundle(tables, explaining.CORE)
    assert set(made.static.columns) == {"student_id", "score", "application_year", *explaining.CORE}
    assert made.static.count() == tables.applicants("train").count()


def test_both_kinds_of_trees_share_their_fill_values(tables, monkeypatch):
    from foldwise.catalog import explaining
    from foldwise.operators import learners
    found, medians = [], learners.medians
    monkeypatch.setattr(learners, "medians", lambda df, cols: found.append(cols) or medians(df, cols))
    models = {r["model"]: r for r in catalog.QUERIES["v05_d27_native_importances"](tables.spark, tables.sf_dir)
              .groupBy("model").agg({"importance": "sum"}).collect()}
    assert set(models) == {"boosted", "forest"} and len(found) == 1
    assert len(found[0]) == len(explaining.numeric_names(tables))


def test_the_referee_works_out_its_rows_once(spark):
    from pyspark.sql import functions as F

    from foldwise.operators import ensemble
    read = spark.sparkContext.accumulator(0)

    def model(x):
        read.add(1)
        return float(x % 11)
    df = spark.range(600).select("id", (F.col("id") % 13).cast("double").alias("y"), F.udf(model, "double")("id").alias("a"),
                                 (F.col("id") % 5).cast("double").alias("b"))
    scores = ensemble.honest_comparison(df, "id", ["a", "b"], "y", repeats=1, splits=2, rounds=2)
    assert scores.count() == 2 * 6 and read.value == 600


def test_learners_read_a_stored_join_of_features_and_folds(spark):
    from pyspark.sql import functions as F

    from foldwise.operators import cross
    static = spark.range(40).select("id", F.col("id").cast("double").alias("y"), (F.col("id") % 3).cast("double").alias("a"),
                                    F.lit(1.0).alias("b"))
    dealt = spark.range(40).select("id", F.lit(0).alias("repeat"), (F.col("id") % 2).cast("int").alias("fold"))
    bundle = cross.Bundle(static, dealt, "id", "y", ["a", "b"], splits=2)
    for names in (None, ["b"]):
        for k in range(2):
            train, held = bundle.view(0, k, names)
            assert train.columns == ["id", "y", *(names or ["a", "b"]), "fold"]
            assert "Join" not in train._jdf.queryExecution().optimizedPlan().toString()
            assert {r["id"] for r in held.collect()} == {i for i in range(40) if i % 2 == k} and train.count() == 20
