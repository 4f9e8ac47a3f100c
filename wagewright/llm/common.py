"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Upper-case ASCII letters and what they become; other letters keep their case.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()

#: The same for UTF-8 bytes.
LOWER_BYTES = bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode())

#: Rows of whole texts that go to Python at once.
TEXT_ROWS = 500
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bounds of a broadcast: bytes in files (compressed) and rows.
BROADCAST_BYTES, BROADCAST_ROWS = 8 << 20, 200_000

#: Where the steps that are still read lie.
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's checkpoint folder.

    Where the session names none a temporary folder is set in local mode; on a cluster executors couldn't see it, so
    that raises.
    """
    sc = spark.sparkContext
    found = sc._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get()
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-shared-"))
    return sc._jsc.sc().getCheckpointDir().get()


def stored(df: DataFrame, name: str = "step", batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    It cuts the lineage, and a lost executor loses nothing of it. ``batch_rows``: at most so many rows go to Python at
    once while it is written, as a batch of whole texts and what is made of it have to fit in memory.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(BATCH_SETTING)
    try:
        if batch_rows:
            spark.conf.set(BATCH_SETTING, str(min(batch_rows, int(before))))
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH_SETTING, before)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def discard(*steps: DataFrame | None) -> None:
    """Remove the files of steps that ``stored`` returned and that nothing reads any more."""
    for step in steps:
        if step is not None and (path := _paths.pop(step, None)):
            spark = step.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def bounded(df: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, which ``stored`` returned, marked for broadcast if its files and its rows are small.

    A row in memory may take many times its bytes in a file, so rows are counted too; beyond either bound Spark shuffles.
    """
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(_paths[df])
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    small = size <= most_bytes and df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(df) if small else df


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def row_key(doc_id: Column, text: Column) -> Column:
    """A key by which repeated rows are one document, while two texts under one id (or none) are two."""
    return F.struct(doc_id.alias("id"), F.xxhash64(text).alias("h1"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("h2"))
