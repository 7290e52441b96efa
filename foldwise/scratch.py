"""Where intermediate tables live, and how a plan is cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SMALL_ROWS = 50_000
SMALL_BYTES = 32 * 1024 * 1024
NARROW = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp"}
_local_root: str | None = None
_run_folder: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster such
    a folder would be seen by one machine alone.
    """
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="foldwise-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def run_folder(spark: SparkSession) -> str:
    """A folder of this session inside the shared one; it is removed when the session's process ends."""
    global _run_folder
    root = scratch_root(spark)
    if _run_folder is None or not _run_folder.startswith(root):
        _run_folder = f"{root}/foldwise-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, _run_folder)
    return _run_folder


def _remove(spark: SparkSession, path: str) -> None:
    try:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    except Exception:  # noqa: BLE001  the session is gone already; the shared folder's owner cleans up
        pass


def written(df: DataFrame, schema: StructType | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Write once, read back: cuts lineage and survives the loss of executors.

    ``schema`` names the types to read back where they are other views of the
    stored ones, such as ML vectors over their storage struct. ``by`` names columns
    that become folders, so that readers skip the parts they do not want.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/t-{uuid.uuid4().hex}"
    (df.repartition(*by).write.partitionBy(*by) if by else df.write).parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def fitted(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """Pin a fitted lookup table at its measured size.

    Up to ``limit`` rows and ``SMALL_BYTES`` bytes it becomes an in-plan table
    that joins by broadcast. Beyond that it is written to the scratch folder, and joins to it are chosen
    by the planner from its real size, so no unbounded table is ever broadcast.
    """
    return measured(df, limit)[0]


def measured(df: DataFrame, limit: int = SMALL_ROWS) -> tuple[DataFrame, bool]:
    """The table as :func:`fitted` gives it, and whether it was small."""
    stored = written(df)
    texts = [F.sum(F.octet_length(F.col(f"`{c}`").cast("string"))) for c, t in stored.dtypes if t not in NARROW]
    row = stored.agg(F.count(F.lit(1)), *texts).first()  # measured where it lies: only small tables reach the driver
    if row[0] <= limit and sum(v or 0 for v in row[1:]) <= SMALL_BYTES:
        head = stored.toArrow()
        if head.nbytes <= SMALL_BYTES:
            return F.broadcast(df.sparkSession.createDataFrame(head, df.schema)), True
    return stored, False
