"""Whole jobs on a stream: every micro-batch is an ordinary table, and its result is written exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from foldwise.plans import score as score_plan


def process_stream(stream: DataFrame, work: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str,
                   available_now: bool = False) -> StreamingQuery:
    """``work`` on every micro-batch, into a folder of the batch's number.

    A batch that is run again after a failure has the same number and rows, and replaces what it had written.
    """
    def put(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def score_stream(spark: SparkSession, path: str, stream: DataFrame, sink: str, checkpoint: str,
                 available_now: bool = False) -> StreamingQuery:
    """Score a stream with a training run's saved state, which is read once."""
    state = score_plan.load_state(spark, path)
    return process_stream(stream, lambda batch: score_plan.score(spark, path, batch, state=state), sink, checkpoint, available_now)


def read_batches(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(sink).drop("batch")
