"""Crawl snapshots as a stream: each micro-batch is merged into the stored ads."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wagewright.operators.history import merge_snapshot

STORED = "board string, job_key string, first_seen timestamp, last_seen timestamp, is_active int, pay double"


#: Parts of the stored ads, by a hash of the board; a batch rewrites only the parts of its boards.
PARTS = 64


def _read_index(spark: SparkSession, path: str, version: int) -> dict[str, int]:
    """Which version holds each part, as the version's index says."""
    if version < 0:
        return {}
    return json.loads(spark.read.text(f"{path}/v{version}/index").first()["value"])


def _parts(spark: SparkSession, path: str, index: dict[str, int], parts: list[str]) -> DataFrame:
    folders = [f"{path}/v{index[p]}/ads/part={p}" for p in parts if p in index]
    return spark.read.schema(STORED).parquet(*folders) if folders else spark.createDataFrame([], STORED)


def stored_ads(spark: SparkSession, path: str, version: int) -> DataFrame:
    """All ads as of a version."""
    index = _read_index(spark, path, version)
    return _parts(spark, path, index, list(index))


def merge_into(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that merges each batch's boards into the ads under path.

    A version has the parts that its batch changed, and an index that names the version of every part; it counts once
    its index is written. A batch that comes again (its index is there already) changes nothing. Parts that the version
    before last still held but no later index names are removed.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        of = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        done = of(f"v{batch_id}/index/_SUCCESS")
        files = done.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(done):
            return
        index = _read_index(spark, path, batch_id - 1)
        part = F.pmod(F.xxhash64("board"), F.lit(PARTS)).cast("string")
        row = batch.agg(F.max("ts").alias("now"), F.collect_set(part).alias("parts")).first()  # at most PARTS names
        if row["now"] is not None:
            boards = batch.select("board", F.lit(True).alias("ok")).distinct()
            after = merge_snapshot(_parts(spark, path, index, row["parts"]), batch, boards, row["now"])
            after.withColumn("part", part).write.mode("overwrite").partitionBy("part").parquet(f"{path}/v{batch_id}/ads")
        unused = {p: v for p, v in index.items() if p in row["parts"]}
        index |= dict.fromkeys(row["parts"], batch_id)
        spark.createDataFrame([(json.dumps(index),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/v{batch_id}/index")
        for p, v in unused.items():
            if v < batch_id - 1:
                files.delete(of(f"v{v}/ads/part={p}"), True)

    return merge


def ingest(spark: SparkSession, source: str, schema: str, path: str, checkpoint: str) -> StreamingQuery:
    """Reads new snapshot files (board, job_key, ordinal, ts, pay) as they come."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    return stream.writeStream.foreachBatch(merge_into(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
