"""What the operators on text collections share: reading columns in tasks, scratch tables, running positions."""

from __future__ import annotations

import gc
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldwise.scratch import scratch_root

#: Code points that separate words: space, and tab to carriage return.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def only(df: DataFrame, **columns) -> DataFrame:
    """The named inputs alone, so that other columns, whatever they are called, cannot clash."""
    return df.select(*[F.col(f"`{c}`").alias(name) if isinstance(c, str) else c.alias(name)
                       for name, c in columns.items()])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where ``df`` has a column called so already."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def short_batches(df: DataFrame) -> DataFrame:
    """``df``, with Arrow batches of 4 MB instead of Spark's 64 MB if its session has that default: texts are long, and
    tasks hold a batch several times over, on both sides."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name, None) in ("67108864b", "67108864", "64MB"):
        conf.set(name, str(BATCH_BYTES))
    return df


class Scratch:
    """Tables of one run in the shared folder; each can be removed once nothing reads it any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{scratch_root(spark)}/run-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        df.write.option("compression", codec).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def settle(self) -> None:
        """Shuffle files of finished jobs are removed once the driver's JVM finds that nothing refers to them; this has it look."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def worker_state(key: str, make: Callable):
    """A value that lives as long as the Python worker, so that later tasks find it filled."""
    holder = sys.modules.setdefault("_foldwise_worker_state", types.ModuleType("_foldwise_worker_state"))
    if key not in holder.__dict__:
        holder.__dict__[key] = make()
    return holder.__dict__[key]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 256 << 10,
           rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds at most ``rows`` rows and about ``limit`` bytes of text, or one row that is longer."""
    for batch in batches:
        ends = utf8(batch.column(text))[1]
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
            to = min(to, at + rows)
            yield batch.slice(at, to - at)
            at = to


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes start, start + 1, ... of every run, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def sums_before(df: DataFrame, group: list[str], part: str, order: list, value: str, name: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of a group, in ``order``, where ``part`` cuts that order into stretches.

    Totals of stretches are cumulated first, so no window holds more than one stretch, however large the group.
    """
    totals = df.groupBy(*group, part).agg(F.sum(value).alias("_total"))
    over = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = totals.select(*group, part, (F.sum("_total").over(
        over.orderBy(part).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_total")).alias("_before"))
    within = Window.partitionBy(*group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumn("_local", F.sum(value).over(within) - F.col(value))
    renamed = before.select(*[F.col(k).alias(f"_{k}") for k in [*group, part]], "_before")
    on = F.lit(True)
    for k in [*group, part]:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return (local.join(renamed, on).withColumn(name, F.col("_before") + F.col("_local"))
            .drop("_before", "_local", *[f"_{k}" for k in [*group, part]]))


def _ranged(df: DataFrame, group: str, order: list, value: str | None, scratch: Scratch, name: str) -> DataFrame:
    """Adds ``before`` and ``total``, the sums of ``value`` over a group's earlier rows and over all of them.

    Rows are cut by group and order into ranges, written with their range, as ranges are drawn from a sample; sums of ranges are
    cumulated, and windows hold one range. Rows alike in group and order are interchangeable and spread over ranges.
    """
    cut = (df.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(partitions(df.sparkSession), group, *order, "tie")
           .withColumn("part", F.spark_partition_id()))
    stored = scratch.keep(cut, name)
    worth = F.col(value) if value else F.lit(1).cast("long")
    of_group = Window.partitionBy("of_group")
    totals = stored.groupBy(F.col(group).alias("of_group"), F.col("part").alias("of_part")).agg(F.sum(worth).alias("size"))
    totals = totals.select("of_group", "of_part", F.sum("size").over(of_group).alias("total"), (F.sum("size").over(
        of_group.orderBy("of_part")) - F.col("size")).alias("earlier"))
    within = Window.partitionBy(group, "part").orderBy(*order, "tie").rowsBetween(Window.unboundedPreceding, 0)
    local = stored.withColumn("local", F.sum(worth).over(within) - worth)
    same = F.col(group).eqNullSafe(F.col("of_group")) & (F.col("part") == F.col("of_part"))
    return (local.join(totals, same).withColumn("before", F.col("earlier") + F.col("local"))
            .drop("tie", "part", "local", "of_group", "of_part", "earlier"))


def placed(df: DataFrame, group: str, order: list, scratch: Scratch, name: str) -> DataFrame:
    """Adds ``pos``, the place of each row in its group, and ``n``, the group's rows, for any size of a group."""
    return _ranged(df, group, order, None, scratch, name).withColumnsRenamed({"before": "pos", "total": "n"})


def placed_sums(df: DataFrame, group: str, order: list, value: str, name: str, scratch: Scratch, table: str) -> DataFrame:
    """Adds ``name``, the sum of ``value`` over the rows before each in its group, for any size of a group."""
    return _ranged(df, group, order, value, scratch, table).drop("total").withColumnRenamed("before", name)
