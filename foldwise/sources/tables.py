"""Reading and writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing here; Spark's own aggregates treat the two differently."""
    return df.select(*[
        F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema])


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               fmt: str | None = None) -> DataFrame:
    """CSV with a header and a declared schema, or Parquet or JSON."""
    fmt = fmt or next((k for k in ("csv", "json") if path.rstrip("/").endswith(k)), "parquet")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV table needs a schema")
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    return nan_to_null(reader.format(fmt).load(path))


def repeated_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Ids that occur more than once; an empty result means the table is usable."""
    return df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1 or " + id_col + " is null")


def require_unique(df: DataFrame, id_col: str) -> DataFrame:
    bad = repeated_ids(df, id_col).limit(1).collect()
    if bad:
        raise ValueError(f"{id_col} is not a row id: {bad[0][0]!r} occurs {bad[0][1]} times")
    return df


def write_submission(df: DataFrame, id_col: str, pred: str, target: str, path: str,
                     fmt: str = "csv", mode: str = "errorifexists") -> None:
    out = submission(df, id_col, pred, target)
    writer = out.write.mode(mode)
    (writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path))


def submission(df: DataFrame, id_col: str, pred: str, target: str) -> DataFrame:
    return df.select(id_col, F.col(pred).alias(target))


def write_predictions(preds: DataFrame, path: str) -> None:
    """Long prediction table, one folder per model so that readers skip the rest.

    A model's folder is replaced, others stay: running a job again leaves no row twice.
    """
    preds.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model").parquet(path)
