"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes in files up to which a written table is broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 16 << 20

#: Where the steps that are still read lie.
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def step_path(spark: SparkSession, name: str) -> str:
    """A new place under the session's checkpoint folder.

    Where the session names no such folder a temporary one is set in local mode; on a cluster that raises, as executors
    couldn't share it.
    """
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-shared-"))
    return f"{sc._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """df written as Parquet under the session's checkpoint folder and read again, which cuts its lineage."""
    spark = df.sparkSession
    path = step_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def size_of(df: DataFrame) -> int | None:
    """Bytes of the files of what ``written`` returned; None for other frames."""
    if (path := _paths.get(df)) is None:
        return None
    folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def discard(*steps: DataFrame | None) -> None:
    """Remove the files of steps that ``written`` returned and that nothing reads any more."""
    for step in steps:
        if step is not None and (path := _paths.pop(step, None)):
            folder = step.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(step.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def dealt(df: DataFrame, each: int = 20_000) -> DataFrame:
    """df in so many partitions that a task has about ``each`` rows: for functions that take long, where the files of
    narrow rows would give few tasks."""
    return df.repartition(max(1, -(-df.count() // each)))


def bounded(df: DataFrame, most_rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """df marked for broadcast if it is small by rows and, where it is written, by bytes of its files; else Spark shuffles."""
    size = size_of(df)
    small = (size is None or size <= most_bytes) and df.limit(most_rows + 1).count() <= most_rows
    return F.broadcast(df) if small else df
