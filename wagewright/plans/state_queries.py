"""Queries over what is kept between runs: the stream's state and tables with versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.adapters import load, with_views
from wagewright.plans.queries import query
from wagewright.schema import fields
from wagewright.stores import step_path
from wagewright.streaming import stateful
from wagewright.tables import Table

WEEKS = [(1, 7), (8, 14), (15, 21), (22, 31)]


@query("history_stream", with_views("snapshots") + """, s AS (SELECT * FROM snapshots WHERE NOT (board = 'error' AND CAST(substr(day, 9, 2) AS INT) % 2 = 0)), b AS (SELECT *, max(day) OVER (PARTITION BY board) AS board_day FROM s)
  SELECT board, job_key, min(day) AS first_seen, max(day) AS last_seen, CASE WHEN max(day) = max(board_day) THEN 1 ELSE 0 END AS is_active, arg_max(pay, (day, ordinal)) AS pay FROM b GROUP BY board, job_key""")
def history_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of each week come as files, the stream goes on from its checkpoint every week; one board
    fails every other day."""
    source, sink, checkpoint = (step_path(spark, x) for x in ("snapshots", "changes", "checkpoint"))
    ads = load(spark, sf_dir, "snapshots").select("board", "job_key", "day", "ordinal", "pay", F.lit(None).cast("boolean").alias("ok"))
    day = F.substring("day", 9, 2).cast("int")
    marks = ads.select("board", F.lit(None).cast("string").alias("job_key"), "day", F.lit(None).cast("long").alias("ordinal"), F.lit(None).cast("double").alias("pay"), ((F.col("board") != "error") | (day % 2 != 0)).alias("ok")).distinct()
    for first, last in WEEKS:
        ads.unionByName(marks).where(day.between(first, last)).write.mode("append").parquet(source)
        stateful.follow(spark, source, sink, checkpoint, files_at_once=1000, buckets=4).awaitTermination()
    return stateful.state(spark, sink)


@query("merged_tables", with_views("jobs") + """ SELECT job_key, CASE WHEN o % 3 = 0 THEN NULL ELSE title END AS title, CASE o % 6 WHEN 0 THEN 'second' WHEN 5 THEN 'third' ELSE CASE WHEN o % 3 = 0 THEN 'second' ELSE 'first' END END AS slug_or_url
  FROM (SELECT *, CAST(split_part(job_key, '|', 2) AS BIGINT) AS o FROM jobs)""")
def merged_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored ads after three merges: all but some, then changed ones (a NULL counts), then those still unknown."""
    number = F.split_part("job_key", F.lit("|"), F.lit(2)).cast("long")
    rows = load(spark, sf_dir, "jobs").select("job_key", "title", number.alias("o"))
    table = Table(spark, step_path(spark, "tables"), "jobs", parts=8)
    table.upsert(rows.where("o % 6 <> 5").withColumn("slug_or_url", F.lit("first")))
    table.upsert(rows.where("o % 3 = 0").withColumn("title", F.lit(None).cast("string")).withColumn("slug_or_url", F.lit("second")))
    table.insert_or_ignore(rows.withColumn("slug_or_url", F.lit("third")), "slug_or_url")
    return table.read().select("job_key", "title", "slug_or_url")


@query("replaced_children", with_views("job_locations") + " SELECT job_key, CASE WHEN o % 2 = 0 THEN 'new' ELSE location_id END AS location_id FROM (SELECT *, CAST(split_part(job_key, '|', 2) AS BIGINT) AS o FROM job_locations) GROUP BY ALL")
def replaced_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ad's places all go when it comes with new ones."""
    number = F.split_part("job_key", F.lit("|"), F.lit(2)).cast("long")
    rows = load(spark, sf_dir, "job_locations").withColumn("location_raw", F.col("location_id"))
    table = Table(spark, step_path(spark, "tables"), "job_locations", parts=8)
    table.replace_children(rows)
    table.replace_children(rows.where(number % 2 == 0).select("job_key", F.lit("new").alias("location_id"), F.lit("new").alias("location_raw")).distinct())
    return table.read().select("job_key", "location_id")


@query("stored_schema", "SELECT job_key, title, CAST(NULL AS VARCHAR) AS content_hash, CAST(NULL AS INTEGER) AS n_locations FROM (" + with_views("jobs") + " SELECT * FROM jobs)")
def stored_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows stored with fewer columns are read with those that came later."""
    path = step_path(spark, "older")
    load(spark, sf_dir, "jobs").select("job_key", "title").write.parquet(path)
    return spark.read.schema(fields("job_key string, title string, content_hash string, n_locations int")).parquet(path)
