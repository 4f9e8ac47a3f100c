"""Stored tables in the catalog, bucketed by the keys they are joined by, so that joins and sums by them don't shuffle.

A key lies in one bucket whole, so one that holds much of a table would be one task. ``dealt`` gives such a table a second
key column, a number below ``parts`` made from the rows' own key; the other side is held once for each number
(``copied``), and both are bucketed by the two columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.stores import step_path

#: The second key column of dealt tables.
PART = "part"


def dealt(df: DataFrame, own_key: str | Column, parts: int) -> DataFrame:
    """df with the column part, by which the rows of one key lie in ``parts`` places. A null own key is one value."""
    return df.withColumn(PART, F.pmod(F.xxhash64(own_key), F.lit(parts)).cast("int"))


def copied(df: DataFrame, parts: int) -> DataFrame:
    """Each row of df once for each part; for the side whose keys are unique."""
    return df.withColumn(PART, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))


def store(df: DataFrame, name: str, keys: list[str], buckets: int) -> DataFrame:
    """df written as a catalog table of its own, bucketed and sorted by ``keys``, and read again.

    Tables that are joined need the same number of buckets and keys of the same types. A bucket is one file, as the rows
    are brought into buckets before they are written; a later write to the same table adds files, not a shuffle. The name
    gets a suffix, so no table is overwritten; an empty df gives an empty table. Null keys are one key.
    """
    table = f"{name}_{uuid.uuid4().hex}"
    spread = df.repartition(buckets, *keys)
    spread.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", step_path(df.sparkSession, table)).saveAsTable(table)
    return df.sparkSession.table(table)
