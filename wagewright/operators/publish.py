"""Sinks: what is exported and published."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.operators import disclosure
from wagewright.schema import LABELS

LAW_START = "2026-06-07"


def copy_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Every table as Parquet, replacing what was there."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def aggregates(cells: DataFrame, path: str) -> None:
    """Published cells as one JSON array and as CSV with a header; they are few by nature, so one file each."""
    as_array(cells).write.mode("overwrite").text(f"{path}/aggregates.json")
    cells.coalesce(1).write.mode("overwrite").csv(f"{path}/aggregates.csv", header=True)


def as_array(rows: DataFrame) -> DataFrame:
    """Rows as the text of one JSON array, a piece for each row and one for each bracket, in one partition."""
    pieces = rows.coalesce(1).select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")).withColumn("_n", F.monotonically_increasing_id())
    between = pieces.select(F.when(F.col("_n") == 0, F.concat(F.lit("["), "value")).otherwise(F.concat(F.lit(","), "value")).alias("value"))
    closing = rows.sparkSession.createDataFrame([("]" if not rows.isEmpty() else "[]",)], "value string")
    return between.unionByName(closing).coalesce(1)


def read_published(spark: SparkSession, path: str) -> tuple[DataFrame, dict, dict]:
    """(cells, meta, labels) as they were published."""
    cells = spark.read.json(f"{path}/aggregates.json", multiLine=True)
    small = [json.loads("".join(r["value"] for r in spark.read.text(f"{path}/{name}.json").collect())) for name in ("meta", "labels")]
    return cells, *small


def publish(cells: DataFrame, header: dict, path: str) -> None:
    aggregates(cells, path)
    write_text(cells.sparkSession, f"{path}/meta.json", header)
    write_text(cells.sparkSession, f"{path}/labels.json", labels())


def meta(counts: DataFrame, n_seed: int) -> dict:
    """The publication's header from the one row of counts."""
    row = counts.first()
    return {
        "observed_from": str(row["observed_from"])[:10], "last_update": str(row["last_update"])[:10], "n_jobs_active": row["n_jobs_active"], "n_companies_active": row["n_companies_active"],
        "n_companies_seed": n_seed, "law_start": LAW_START, "rules": {"min_jobs": disclosure.MIN_JOBS, "min_companies": disclosure.MIN_COMPANIES, "max_share": disclosure.MAX_SHARE},
    }


def write_text(spark, path: str, value: dict) -> None:
    """One small JSON document, by Spark's own file system."""
    spark.createDataFrame([(json.dumps(value, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def labels() -> dict:
    return {k: v for k, v in LABELS.items() if k not in ("sector", "micro_sector")}


def load_files(tables: dict[str, DataFrame], path: str) -> None:
    """A line of JSON per row, tables replaced; ads without their text."""
    for name, df in tables.items():
        df.drop("description").write.mode("overwrite").json(f"{path}/{name}")


def sample_csv(rows: DataFrame, path: str) -> None:
    """A sample to label, with semicolons and a byte order mark for spreadsheets; never over an existing one."""
    plain = rows.select(*(F.col(c).cast("string") for c in rows.columns))
    marked = plain.withColumnRenamed(plain.columns[0], f"\ufeff{plain.columns[0]}")
    marked.coalesce(1).write.mode("errorifexists").csv(path, header=True, sep=";", encoding="UTF-8")


def registry_csv(registry: DataFrame, path: str) -> None:
    registry.orderBy(F.desc("is_tech"), "company").coalesce(1).write.mode("overwrite").csv(path, header=True)
