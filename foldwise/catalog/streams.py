"""The same features, encodings and models on a stream: micro-batches of a folder of files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foldwise import fixed
from foldwise.catalog import SQL, query
from foldwise.catalog.learning import two_column_ridge
from foldwise.functions.rows import rounded
from foldwise.operators import encode, learners, lexicon
from foldwise.scratch import fitted, scratch_root, written
from foldwise.streaming.batches import process_stream, read_batches

BATCHES = 4  # micro-batches, each of as many files as tasks run at once


def streamed(t, df, work):
    """``df`` as a stream of files, ``work`` on each of its micro-batches, and what all of them wrote."""
    root = f"{scratch_root(t.spark)}/stream-{uuid.uuid4().hex}"
    files = max(t.spark.sparkContext.defaultParallelism, 2)
    df.repartition(BATCHES * files).write.parquet(f"{root}/in")
    stream = t.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in")
    process_stream(stream, work, f"{root}/out", f"{root}/log", available_now=True).awaitTermination()
    return read_batches(t.spark, f"{root}/out")


@query("m16_stream_text_shape", SQL["t01_lexicon_features"])
def _(t):
    made = lexicon.shape_columns("feedback")
    return streamed(t, t.applicants().select("student_id", "feedback"),
                    lambda df: df.select("student_id", *[e.alias(n) for n, e in made.items()]))


@query("m16_stream_mentions", SQL["t02_mentions_around_contrast"])
def _(t):
    return streamed(t, t.applicants().select("student_id", "feedback"),
                    lambda df: lexicon.with_mentions(df, "feedback").select("student_id", *lexicon.mention_columns()))


@query("m16_stream_encoding", SQL["d05_encoding_of_new_rows"])
def _(t):
    train = written(t.cases("train"))
    prior = train.agg(F.avg("y")).first()[0]
    table = fitted(encode.smoothed_means(train, "dept", "y")).withColumnRenamed("dept", "__dept")

    def encoded(df):
        known = df.join(table, encode.level("dept", fixed.NULL_LEVEL) == F.col("__dept"), "left")
        return known.select("row_id", rounded(F.coalesce("te", F.lit(prior))).alias("te_dept"))
    return streamed(t, t.cases("test").select("row_id", "dept"), encoded)


@query("m16_stream_ridge", SQL["m06_ridge_two_columns"])
def _(t):
    model, inputs = two_column_ridge(t), learners.Inputs(["bal", "yr"], {})
    return streamed(t, t.cases().select("row_id", "bal", "yr"), lambda df: model.transform(
        df.withColumn("features", inputs.vector())).select("row_id", rounded("prediction").alias("pred")))
