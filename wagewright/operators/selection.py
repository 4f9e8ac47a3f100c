"""Exact medians of groups of any size: counts by range tell where the middle lies, and only that range is looked into.

No group's values are gathered. A round adds up counts of at most RANGES ranges of a group and keeps the one that holds
the middle; what is left after the rounds is counted by value. Rounds go by the values' own least and greatest, so a
value far off costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagewright.stores import bounded, discard, written

RANGES, ROUNDS = 1024, 2


def _within(values: DataFrame, sought: DataFrame, keys: list[str]) -> DataFrame:
    """The values of each group that lie in the range in which a rank of it is sought."""
    named = sought.select(*(F.col(k).alias(f"_{k}") for k in keys), "which", "low", "high", "rank")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return values.join(named, same & F.col("v").between(F.col("low"), F.col("high"))).drop(*(f"_{k}" for k in keys))


def _holding(counts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of counts (keys, which, rank, order, n) the row of each rank in which it lies, with the rank within it."""
    own = Window.partitionBy(*keys, "which").orderBy(order)
    before = F.sum("n").over(own) - F.col("n")
    found = counts.withColumn("_before", before).where((F.col("rank") >= F.col("_before")) & (F.col("rank") < F.col("_before") + F.col("n")))
    return found.withColumn("rank", F.col("rank") - F.col("_before")).drop("_before", "n")


def medians(rows: DataFrame, by: list[str], columns: list[str], rounds: int = ROUNDS, ranges: int = RANGES) -> DataFrame:
    """by, and the median of each column: the mean of the two middle values where their number is even.

    Nulls aren't values; a group without values has no row. Null keys are a group. rows are read once.
    """
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in columns)))
    values = written(rows.select(*by, each.alias("_e")).select(*by, "_e.*").where("v is not null"), "values")
    keys = [*by, "name"]
    whole = values.groupBy(*keys).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"))
    middle = F.array_distinct(F.array(F.expr("(n - 1) div 2"), F.expr("n div 2")))
    sought = written(whole.select(*keys, "low", "high", F.posexplode(middle).alias("which", "rank")), "sought")
    steps = [values, sought]
    for _ in range(rounds):
        inside = _within(values, bounded(sought), keys)
        part = F.when(F.col("high") > F.col("low"), F.least(F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * ranges), F.lit(ranges - 1))).otherwise(0)
        counts = inside.groupBy(*keys, "which", "rank", part.alias("part")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        sought = written(_holding(counts, keys, "part").drop("part"), "sought")
        steps.append(sought)
    counts = _within(values, bounded(sought), keys).groupBy(*keys, "which", "rank", "v").agg(F.count("*").alias("n"))
    found = _holding(counts, keys, "v").groupBy(*by).agg(*(F.avg(F.when(F.col("name") == c, F.col("v"))).alias(c) for c in columns))
    out = written(found, "medians")
    discard(*steps)
    return out
