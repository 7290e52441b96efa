from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.catalog.bind import SPEC
from foldwise.catalog.jobs import SMALL_BLOCKS, TINY
from foldwise.operators import features
from foldwise.plans import score as score_plan
from foldwise.plans import train as train_plan
from foldwise.scratch import written
from foldwise.sources import records
from foldwise.sources import tables as T
from foldwise.streaming.batches import process_stream, read_batches, score_stream
from foldwise.streaming.features import transform_stream


def test_train_then_score_gives_the_same_predictions(spark, tables, tmp_path):
    train, test = written(tables.applicants("train")), written(tables.applicants("test"))
    budget = replace(TINY, text_meta=True)
    run = train_plan.train(SPEC, train, test, f"{tmp_path}/run", budget, ("boosted", "ridge"), blocks=SMALL_BLOCKS)
    again = score_plan.score(spark, f"{tmp_path}/run", test)
    both = run.submission.withColumnRenamed("score", "a").join(again, "student_id").toPandas()
    assert len(both) == test.count() and np.allclose(both["a"], both["score"], atol=1e-6)
    assert both["score"].between(0, 100).all()
    spread = train.agg(F.var_pop("score")).first()[0]
    assert run.metrics["mse"] < 0.5 * spread
    runs = records.read_runs(spark, f"{tmp_path}/run/runs").first()
    assert runs["params"]["method"] and runs["metrics"]["final_oof_wmse"] > 0
    source = f"{tmp_path}/in"
    test.repartition(2).write.parquet(source)
    stream = spark.readStream.schema(test.schema).option("maxFilesPerTrigger", 1).parquet(source)
    for _ in range(2):  # the second start finds nothing new and writes no row twice
        score_stream(spark, f"{tmp_path}/run", stream, f"{tmp_path}/out", f"{tmp_path}/log", available_now=True).awaitTermination()
    streamed = read_batches(spark, f"{tmp_path}/out").withColumnRenamed("score", "a").join(again, "student_id").toPandas()
    assert len(streamed) == test.count() and np.allclose(streamed["a"], streamed["score"], atol=1e-6)
    with pytest.raises(ValueError, match="feature mismatch"):
        records.require_columns(test.select("student_id"), ["student_id", "cgpa"])


def test_stream_equals_batch(spark, tables, tmp_path):
    train, test = tables.applicants("train"), written(tables.applicants("test").repartition(3))
    model = features.fit_features(train, SPEC)
    source = f"{tmp_path}/in"
    test.write.parquet(source)
    stream = spark.readStream.schema(test.schema).parquet(source)
    transform_stream(model, stream, f"{tmp_path}/out", f"{tmp_path}/cp", available_now=True).awaitTermination()
    cols = ["student_id", "portfolio_strength", "role_skill_match_vs_role", "department_freq", "target_role_code"]
    got = spark.read.parquet(f"{tmp_path}/out").select(cols).orderBy("student_id").collect()
    assert got == model.transform(test).select(cols).orderBy("student_id").collect()


def test_batch_run_again_replaces_its_rows(spark, tmp_path):
    """A batch that fails after writing runs again under its number: no row is lost or written twice."""
    rows = spark.range(40).repartition(4)
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    failed = []

    def work(df):
        out = df.selectExpr("id", "id * 2 AS twice")
        if not failed:
            out.write.mode("overwrite").parquet(f"{tmp_path}/out/batch=0")  # as if lost right after the write
            failed.append(1)
            raise RuntimeError("lost")
        return out

    with pytest.raises(Exception, match="lost"):
        process_stream(stream, work, f"{tmp_path}/out", f"{tmp_path}/log", available_now=True).awaitTermination()
    process_stream(stream, work, f"{tmp_path}/out", f"{tmp_path}/log", available_now=True).awaitTermination()
    assert sorted(map(tuple, read_batches(spark, f"{tmp_path}/out").collect())) == [(i, 2 * i) for i in range(40)]


def test_csv_with_bom_and_nan(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes("﻿id,score,text\nA,1.5,\"x, \"\"y\"\"\"\nB,,\nC,NaN,z\n".encode())
    df = T.read_table(spark, str(path), "id string, score double, text string")
    rows = {r["id"]: r for r in df.collect()}
    assert rows["A"]["text"] == 'x, "y"' and rows["B"]["score"] is None and rows["C"]["score"] is None
    T.write_submission(df, "id", "score", "target", f"{tmp_path}/out")
    assert spark.read.option("header", True).csv(f"{tmp_path}/out").columns == ["id", "target"]


def test_repeated_ids_are_refused(spark):
    with pytest.raises(ValueError):
        T.require_unique(spark.createDataFrame([(1,), (1,)], "id long"), "id")


def test_cache_computes_each_text_once(spark, tmp_path):
    seen = []

    def compute(df):
        seen.append(df.count())
        return df.withColumn("n", F.length("t"))
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "bb")], "id long, t string")
    for frame, fresh in ((df, 2), (df.union(spark.createDataFrame([(4, "ccc")], "id long, t string")), 1)):
        got = records.cached_results(frame, "t", compute, f"{tmp_path}/cache")
        assert {r["id"]: r["n"] for r in got.collect()}[3] == 2 and seen[-1] == fresh


def test_job_studies_parameters_and_external_models(spark, tables, tmp_path):
    """Studies are tables, chosen parameters are used again, outside models join, and a second run changes nothing."""
    from foldwise.spec import BUDGETS
    train, test = written(tables.applicants("train")), written(tables.applicants("test"))
    path = f"{tmp_path}/run"
    budget = replace(TINY, search=True, limits=(("boosted", 1, 60.0), ("ridge", 1, 60.0)),
                     studies=("representations", "imputation", "ablation", "importances", "attribution"))
    outside = (train.select("student_id", (F.col("score") * 0.9 + 5).alias("pred")),
               test.select("student_id", F.lit(60.0).alias("pred")))
    run = train_plan.train(SPEC, train, test, path, budget, ("boosted", "ridge"), external={"outside": outside}, blocks=SMALL_BLOCKS)
    for name in budget.studies:
        assert spark.read.parquet(f"{path}/tables/{name}").count() > 0
    assert spark.read.parquet(f"{path}/tables/ablation").count() == 8
    saved = records.saved_params(spark, f"{path}/params")
    assert set(saved) == {"boosted", "ridge"} and saved["ridge"]["alpha"] != 2.0
    first = {r["model"]: r["count"] for r in spark.read.parquet(f"{path}/predictions").groupBy("model").count().collect()}
    quiet = replace(budget, studies=())
    again = train_plan.train(SPEC, train, test, path, quiet, ("boosted", "ridge"), external={"outside": outside}, blocks=SMALL_BLOCKS)
    assert first == {r["model"]: r["count"] for r in spark.read.parquet(f"{path}/predictions").groupBy("model").count().collect()}
    assert records.saved_params(spark, f"{path}/params") == saved
    a, b = (r.submission.orderBy("student_id").toPandas() for r in (run, again))
    assert np.allclose(a["score"], b["score"], atol=1e-6)
    methods = {r["method"] for r in run.scores.select("method").distinct().collect()}
    assert "single_outside" in methods
    scored = score_plan.score(spark, path, test, external={"outside": outside[1]}, sink=f"{tmp_path}/out", fmt="parquet")
    assert spark.read.parquet(f"{tmp_path}/out").count() == scored.count() == test.count()
    with pytest.raises(ValueError, match="external"):
        score_plan.score(spark, path, test)
    assert BUDGETS["full"].limit("boosted") == (51, 4200.0) and BUDGETS["smoke"].limit("forest") == (2, 240.0)


def test_combiners_can_be_added(spark):
    from foldwise.operators import ensemble
    df = spark.createDataFrame([(1, 1.0, 2.0, 1.5), (2, 3.0, 4.0, 3.0)], "id long, a double, b double, y double")
    ensemble.COMBINERS["first"] = lambda df, names, extra, y, w, rounds: ensemble.single(names[0])
    try:
        got = ensemble.fit_combiner("first", df, ["a", "b"], "y").predict(df).orderBy("id").collect()
        assert [r["pred"] for r in got] == [1.0, 3.0]
    finally:
        del ensemble.COMBINERS["first"]
