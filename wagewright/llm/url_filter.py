"""URL filter: a blocked Bloom filter before an exact hash join, with DataFrame functions only.

A rule is a host with a path prefix, for example ``example.org/es/``. A url can only fit rules among its probes: each
suffix of its host's labels with each path prefix of a length that some rule has. Probes go through the filter, in
which a key sets a few bits of one 64-bit block; what passes is joined with the rules themselves, so false positives
fall out. The filter has one row for each block in use, and is broadcast only if it is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.llm.common import ASCII_LOWER, ASCII_UPPER, bounded, stored

#: (host, path, verdict)
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: Bits that a key sets in its block, and keys for each block on average.
BITS_PER_KEY, KEYS_PER_BLOCK = 4, 4
BROADCAST_ROWS = 100_000


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), ASCII_UPPER, ASCII_LOWER)


def path_of(url: Column) -> Column:
    """Then up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_suffixes(host: Column) -> Column:
    """The host and each parent domain of it."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, 1 << 30), "."))


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("long")


def bits_of(key: Column) -> Column:
    """A mask of the key's bits within its block: 6 bits of a second hash for each."""
    h = F.xxhash64(key, F.lit("bits"))
    mask = F.lit(0).cast("long")
    for i in range(BITS_PER_KEY):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")))
    return mask


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """block, bits of the distinct keys (column key)."""
    return keys.groupBy(block_of(F.col("key"), blocks).alias("block")).agg(F.bit_or(bits_of(F.col("key"))).alias("bits"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for each row of pages.

    The longest fitting rule decides (of equal length the last by text; of rows of one rule, block before allow).
    A url that fits no rule isn't listed and gets ``default``. Rules with a null or empty host or a null path take no
    part. Columns of pages besides page_id and url are ignored, whatever their names. A null url, or one without ``://``, has an empty host and path, and fits no rule.
    """
    listed = (
        rules.where("host is not null and host <> '' and path is not null")
        .groupBy(F.translate("host", ASCII_UPPER, ASCII_LOWER).alias("host"), "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(F.concat("host", "path").alias("rule"), F.concat_ws("\x00", "host", "path").alias("key"), "verdict", F.length("path").alias("size"))
    )
    listed = stored(listed, "rules")
    sizes = sorted(r["size"] for r in listed.select("size").distinct().collect())  # path lengths, not rules
    blocks = max(1, -(-listed.count() // KEYS_PER_BLOCK))
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))

    distinct = parts.select("host", "path").where("host <> ''").distinct()
    prefixes = F.filter(F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sizes)) if sizes else F.array().cast("array<string>"), lambda p: p.isNotNull())
    keys = F.flatten(F.transform(host_suffixes(F.col("host")), lambda h: F.transform(prefixes, lambda p: F.concat_ws("\x00", h, p))))
    probes = distinct.select("host", "path", F.explode(keys).alias("key"))
    passing = (
        probes.withColumn("block", block_of(F.col("key"), blocks))
        .join(bounded(stored(bloom_filter(listed.select("key"), blocks), "bloom")), "block")
        .where(F.col("bits").bitwiseAND(bits_of(F.col("key"))) == bits_of(F.col("key")))
    )
    longest = F.max(F.struct(F.length("rule").alias("n"), F.col("rule"), F.col("verdict")))
    fits = passing.join(bounded(listed).select("key", "rule", "verdict"), "key").groupBy("host", "path").agg(longest.alias("best"))
    found = parts.join(fits, ["host", "path"], "left")
    return found.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


ORACLE_SQL = r"""
WITH rules(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
p AS (
  SELECT row_number() OVER () AS r, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), best AS (
  SELECT r, arg_max(x.host || x.path, length(x.host || x.path)) AS rule, arg_max(verdict, length(x.host || x.path)) AS verdict
  FROM p JOIN rules x ON (p.host = x.host OR ends_with(p.host, '.' || x.host)) AND starts_with(p.path, x.path) GROUP BY r
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN best USING (r)
"""
