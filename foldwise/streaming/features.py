"""Fitted features on a stream: the transform has no state, so a stream takes it as it is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from foldwise.operators.features import FeatureModel


def transform_stream(model: FeatureModel, stream: DataFrame, path: str, checkpoint: str,
                     available_now: bool = False) -> StreamingQuery:
    """Append the transformed rows of a stream to a Parquet table."""
    writer = (model.transform(stream).writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()
