"""Ads over time: snapshots of boards merged into what is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagewright.functions.ids import company_id
from wagewright.stores import bounded


def first_of(rows: DataFrame, keys: list[str], order: str, last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by order."""
    by = F.desc(order) if last else F.asc(order)
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(by))).where("_n = 1").drop("_n")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with the rows of new added or, for a known key, in place of its own; a NULL in new counts."""
    there = F.col("n._new").isNotNull()
    joined = old.alias("o").join(new.withColumn("_new", F.lit(True)).alias("n"), keys, "full")
    return joined.select(*keys, *(F.when(there, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in old.columns if c not in keys))


def insert_or_ignore(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """old with those rows of new whose key it lacks, the first by order of each."""
    added = first_of(new, keys, order).join(old, keys, "left_anti")
    return old.unionByName(added.select(*old.columns))


def replace_children(old: DataFrame, new: DataFrame, parent: str) -> DataFrame:
    """old less all rows of the parents in new, and the rows of new."""
    return old.join(new.select(parent).distinct(), parent, "left_anti").unionByName(new.select(*old.columns))


def merge_snapshot(stored: DataFrame, seen: DataFrame, boards: DataFrame, now) -> DataFrame:
    """stored ads after one crawl.

    stored: board, job_key, first_seen, last_seen, is_active and further columns; seen: board, job_key, ordinal and the
    further columns (several rows of a key: the last counts); boards: board, ok. Ads of a board fetched well that
    weren't seen become inactive, even all of them; a board that failed changes nothing.
    """
    fine = boards.where("ok").select("board").distinct()
    latest = first_of(seen.join(fine, "board", "left_semi"), ["job_key"], "ordinal", last=True)
    more = [c for c in stored.columns if c not in ("board", "job_key", "first_seen", "last_seen", "is_active")]
    joined = stored.alias("o").join(latest.withColumn("_new", F.lit(True)).alias("n"), "job_key", "full").withColumn("_board", F.coalesce("n.board", "o.board"))
    joined = joined.join(fine.select(F.col("board").alias("_board"), F.lit(True).alias("_ok")), "_board", "left")
    new = F.col("n._new").isNotNull()
    return joined.select(
        F.col("_board").alias("board"),
        "job_key",
        F.coalesce("o.first_seen", F.lit(now)).alias("first_seen"),
        F.when(new, F.lit(now)).otherwise(F.col("o.last_seen")).alias("last_seen"),
        F.when(new, 1).when(F.col("_ok"), 0).otherwise(F.col("o.is_active")).alias("is_active"),
        *(F.when(new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in more),
    )


def replay(snapshots: DataFrame, day: str = "day") -> DataFrame:
    """The state after all snapshots, each of a board on a day, in one pass: first_seen, last_seen, is_active and pay.

    An ad is active if it is in its board's last snapshot.
    """
    ads = snapshots.groupBy("board", "job_key").agg(F.min(day).alias("first_seen"), F.max(day).alias("last_seen"), F.max(F.struct(day, "ordinal", "pay"))["pay"].alias("pay"))
    boards = snapshots.groupBy("board").agg(F.max(day).alias("board_day"))
    return (
        ads.join(bounded(boards), "board")
        .select("board", "job_key", "first_seen", "last_seen", (F.col("last_seen") == F.col("board_day")).cast("int").alias("is_active"), "pay")
    )


def deactivate_missing(stored: DataFrame, seen: DataFrame, boards: DataFrame) -> DataFrame:
    """stored ads with is_active 0 where their board was fetched well but the ad wasn't seen."""
    marks = seen.select("job_key").distinct().withColumn("_seen", F.lit(True))
    fine = boards.where("ok").select("board").distinct().withColumn("_ok", F.lit(True))
    joined = stored.join(marks, "job_key", "left").join(fine, "board", "left")
    return joined.withColumn("is_active", F.when(F.col("_ok") & F.col("_seen").isNull(), 0).otherwise(F.col("is_active"))).select(*stored.columns)


def run_counters(merged: DataFrame, seen: DataFrame, now) -> DataFrame:
    """Per board: downloaded and kept ads, and the new ones among them."""
    downloaded = seen.groupBy("board").agg(F.count("*").alias("downloaded"))
    kept = merged.where(F.col("last_seen") == F.lit(now)).groupBy("board").agg(F.count("*").alias("kept"), F.count_if(F.col("first_seen") == F.col("last_seen")).alias("new"))
    return downloaded.join(kept, "board", "left").na.fill(0, ["kept", "new"])


def crawl_totals(counters: DataFrame) -> DataFrame:
    """One row over all boards of a crawl."""
    return counters.agg(F.count("*").alias("boards"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("downloaded", "kept", "new")))


def named_companies(rows: DataFrame, names: list[str], column: str = "company_id") -> DataFrame:
    """rows of the companies that a user names, in whatever spelling gives the same identifier."""
    wanted = rows.sparkSession.createDataFrame([(n,) for n in names], "name string").select(company_id(F.col("name")).alias(column)).distinct()
    return rows.join(wanted, column, "left_semi")
