"""A Merkle manifest of a dataset, made and verified in Pregel-style supersteps over RDDs.

Every row is a leaf. The leaves of a language, in the order of their ids, are the lowest level of a binary tree; the
tops of these trees, in the order of the languages, are the lowest level of a last tree, whose top is the root.

Upward, each superstep sends every node's digest to the parent a few levels above it; a parent that has heard from all
its children hashes the levels between and is a node of the next superstep. Downward, each superstep sends a parent's
path (the digests that are beside the way from it to the root) to its children, which put their own siblings before it,
until each leaf can be folded up to the root again.

A vertex hears from 2**LEVELS children at most, and its place is its number in its level, so one large language is
dealt out like many small ones. Each superstep is written to the shared folder. Texts are read once and never shuffled.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

from pyspark import RDD
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagewright.llm.common import bounded, discard, shared_dir, stored
from wagewright.llm.sql_text import crc32_sql

#: Levels that one superstep climbs, nodes of a superstep's task, and the tree over all languages.
LEVELS, TASK_NODES, TOP = 4, 32_768, -1
SIZE = 32
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def field(value: Column) -> Column:
    """``-`` for null, else the count of UTF-8 bytes, ``:`` and the value."""
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def leaf_of(n_chars: Column) -> Column:
    return F.sha2(F.concat(field(F.col("doc_id")), field(F.col("source")), field(F.col("lang")), field(n_chars), field(F.col("text"))), 256)


def digest(parts: Iterable[bytes]) -> bytes:
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def grown(nodes: list[bytes], width: int, levels: int) -> list[list[bytes]]:
    """The levels over a block of consecutive nodes, itself first: ``levels`` of them, fewer where the tree ends.

    width: nodes of the whole tree at the block's level. A block begins at a multiple of 2**levels.
    """
    out = [nodes]
    while len(out) <= levels and width > 1:
        below, width = out[-1], (width + 1) // 2
        out.append([digest(below[j : j + 2]) for j in range(0, len(below), 2)])
    return out


def beside(levels: list[list[bytes]], j: int) -> list[bytes]:
    """The siblings on the way up from node j of the block; where a node is the last and alone there is none."""
    found = []
    for nodes in levels[:-1]:
        if (j ^ 1) < len(nodes):
            found.append(nodes[j ^ 1])
        j >>= 1
    return found


def folded(node: bytes, i: int, width: int, path: Iterator[bytes]) -> bytes:
    """The top of a tree, from its node i of ``width`` and the siblings beside the way."""
    while width > 1:
        if (i ^ 1) < width:
            other = next(path)
            node = digest((other, node) if i & 1 else (node, other))
        else:
            node = digest((node,))
        i, width = i >> 1, (width + 1) // 2
    return node


def supersteps(n: int, levels: int) -> int:
    """How many supersteps lift n nodes to one; one at least, so that lone leaves are in a block too."""
    return max(1, -(-(n - 1).bit_length() // levels))


class Climb:
    """The supersteps of all trees together, and where they are kept."""

    def __init__(self, df: DataFrame, levels: int, task_nodes: int):
        self.spark, self.levels, self.task_nodes, self.paths = df.sparkSession, levels, task_nodes, []

    def kept(self, rdd: RDD) -> RDD:
        path = f"{shared_dir(self.spark)}/superstep-{uuid.uuid4().hex}"
        rdd.saveAsPickleFile(path)
        self.paths.append(path)
        return self.spark.sparkContext.pickleFile(path)

    def discard(self) -> None:
        for path in self.paths:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def parts(self, nodes: int) -> int:
        return 1 + nodes // self.task_nodes

    def up(self, nodes: RDD, most: int, total: int) -> list[RDD]:
        """Blocks of each superstep: ((tree, block), (n, width, values in order)).

        nodes: ((tree, i), (n, width, value)), a value being a tuple that begins with the digest. most: nodes of the
        largest tree; total: nodes of all.
        """
        levels, steps = self.levels, []
        for k in range(supersteps(most, levels)):
            sent = nodes.map(lambda x: ((x[0][0], x[0][1] >> levels), (x[0][1], *x[1])))
            blocks = sent.groupByKey(self.parts(total >> levels * k)).map(lambda x: completed(x, levels))
            steps.append(self.kept(blocks))
            nodes = steps[-1].map(lambda x: lifted(x, levels)).filter(lambda x: x[1][1] > 1)
        return steps

    def tops(self, steps: list[RDD]) -> RDD:
        """((tree, 0), (n, 1, (digest,))) of every tree."""
        levels = self.levels
        return self.spark.sparkContext.union([s.filter(lambda x, k=k: supersteps(x[1][0], levels) == k + 1).map(lambda x: lifted(x, levels)) for k, s in enumerate(steps)])

    def down(self, steps: list[RDD], tops: RDD, total: int) -> RDD:
        """((tree, i), (n, value, top, path)) of the lowest nodes. tops: ((tree, 0), (n, top, path beyond the tree))."""
        levels, above = self.levels, None
        for k in reversed(range(len(steps))):
            ended = tops.filter(lambda x, k=k: supersteps(x[1][0], levels) == k + 1).map(lambda x: (x[0], x[1][1:]))
            above = ended if above is None else ended.union(above)
            told = steps[k].join(above, self.parts(total >> levels * k)).flatMap(lambda x: told_below(x, levels))
            above = self.kept(told.map(lambda x: (x[0], x[1][2:]))) if k else told
        return above


def completed(block: tuple, levels: int) -> tuple:
    """A parent that has heard from all its children, their values in order."""
    (tree, b), messages = block
    got = sorted(messages, key=lambda m: m[0])
    n, width = got[0][1:3]
    first = b << levels
    if [m[0] for m in got] != list(range(first, min(first + (1 << levels), width))):
        raise ValueError(f"parent {b} of tree {tree} has not heard from its children once each")
    return (tree, b), (n, width, [m[3] for m in got])


def lifted(block: tuple, levels: int) -> tuple:
    key, (n, width, values) = block
    made = grown([v[0] for v in values], width, levels)
    for _ in made[1:]:
        width = (width + 1) // 2
    return key, (n, width, (made[-1][0],))


def told_below(x: tuple, levels: int) -> Iterator[tuple]:
    (tree, b), ((n, width, values), (top, path)) = x
    made = grown([v[0] for v in values], width, levels)
    for j, value in enumerate(values):
        yield (tree, (b << levels) + j), (n, value, top, b"".join(beside(made, j)) + path)


def placed(rows: DataFrame, within: list[str], order: list[str]) -> DataFrame:
    """rows with pos (from 0) in the order of ``order`` among the rows of equal ``within``, nulls first, and n.

    Rows are sorted by ranges over all tasks; then only the counts of each task's runs are summed up, so that no task
    sees more than its range, whatever share of the rows has one value.
    """
    by = [F.col(c).asc_nulls_first() for c in within + order]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id())
    ranged = stored(ranged.withColumn("__part", F.shiftright("__at", 33)), "ranged")
    runs = stored(ranged.groupBy(*within, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__count")), "runs")
    # A run for each task (and value of within): few rows, even where within is empty and one task adds them up.
    w = Window.partitionBy(*within)
    before = F.sum("__count").over(w.orderBy("__part")) - F.col("__count")
    starts = runs.select(*within, "__part", "__first", before.alias("__before"), F.sum("__count").over(w).alias("n"))
    starts = bounded(stored(starts, "starts")).select(*(F.col(c).alias(f"__{c}") for c in within), F.col("__part").alias("__p"), "__first", "__before", "n")
    same = F.col("__part") == F.col("__p")
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    out = ranged.join(starts, same).withColumn("pos", F.col("__at") - F.col("__first") + F.col("__before"))
    return out.select(*rows.columns, "pos", "n")


def manifest(docs: DataFrame, levels: int = LEVELS, task_nodes: int = TASK_NODES, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each row of docs.

    Where ``tampered`` (a condition on docs; nowhere by default) holds, the row that is verified has n_chars + 1; the
    tree is that of the rows as they are. Columns besides doc_id, source, lang, n_chars and text are ignored.
    Nulls are part of the manifest: a null language is a language of its own, before all others, a null doc_id comes before
    all other ids. Empty and long texts are leaves like any other. Rows of one id follow each other by their leaf;
    repeated rows are leaves beside each other, each with its own proof. An empty table gives no rows.
    """
    spark = docs.sparkSession
    changed = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    hashed = docs.select("doc_id", "lang", leaf_of(F.col("n_chars")).alias("leaf"), F.when(changed & F.col("n_chars").isNotNull(), leaf_of(more)).alias("other"), F.xxhash64(F.monotonically_increasing_id()).alias("tie"))
    own = stored(hashed, "leaves")
    leaves = stored(placed(own, ["lang"], ["doc_id", "leaf", "tie"]), "placed")
    total, most = leaves.agg(F.count("*"), F.max("n")).first()
    if not total:
        return spark.createDataFrame([], RESULT)
    trees = stored(placed(leaves.where("pos = 0").select("lang"), [], ["lang"]), "trees")
    n_trees = trees.count()
    numbered = leaves.join(bounded(trees).select(F.col("lang").alias("tree_lang"), F.col("pos").alias("tree")), F.col("lang").eqNullSafe(F.col("tree_lang")))
    climb = Climb(docs, levels, task_nodes)
    nodes = numbered.select("tree", "pos", "n", F.unhex("leaf"), F.unhex("other"), "doc_id").rdd.map(lambda r: ((r[0], r[1]), (r[2], r[2], (bytes(r[3]), r[4] and bytes(r[4]), r[5]))))
    steps = climb.up(nodes, most, total)
    subroots = climb.tops(steps).map(lambda x: ((TOP, x[0][0]), (n_trees, n_trees, (x[1][2][0], x[1][0]))))
    last = climb.up(subroots, n_trees, n_trees)
    root = climb.tops(last).first()[1][2][0]
    start = spark.sparkContext.parallelize([((TOP, 0), (n_trees, root, b""))], 1)
    # Of each language's tree its top, and the path from there to the root.
    tops = climb.kept(climb.down(last, start, n_trees).map(lambda x: ((x[0][1], 0), (x[1][1][1], x[1][1][0], x[1][3]))))

    def judged(x: tuple) -> tuple:
        (tree, i), (n, (leaf, other, doc_id), subroot, path) = x
        steps = iter([path[k : k + SIZE] for k in range(0, len(path), SIZE)])
        again = folded(folded(other or leaf, i, n, steps), tree, n_trees, steps)
        proof = hashlib.sha256(path.hex().encode()).hexdigest()
        return doc_id, leaf.hex(), subroot.hex(), root.hex(), proof, again.hex(), again == root

    out = stored(spark.createDataFrame(climb.down(steps, tops, total).map(judged), RESULT), "manifest")
    climb.discard()
    discard(own, leaves, trees)
    return out


def every_seventh(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0


def _said(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


def _leaf_sql(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_said, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


ORACLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, {_leaf_sql('n_chars')} AS leaf, CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_leaf_sql('(n_chars + 1)')} ELSE {_leaf_sql('n_chars')} END AS other FROM documents
), l AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d
), t AS (
  SELECT tree, 0 AS k, pos AS i, n AS width, leaf AS h FROM l
  UNION ALL
  SELECT tree, k + 1, i // 2, (width + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE width > 1 GROUP BY tree, k, i // 2, width
), s AS (SELECT tree, h, k FROM t WHERE width = 1
), u AS (
  SELECT 0 AS k, tree AS i, (SELECT count(*) FROM s) AS width, h FROM s
  UNION ALL
  SELECT k + 1, i // 2, (width + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE width > 1 GROUP BY k, i // 2, width
), f AS (
  SELECT tree, pos, 0 AS k, pos AS i, n AS width, other AS h, '' AS proof FROM l
  UNION ALL
  SELECT f.tree, f.pos, f.k + 1, f.i // 2, (f.width + 1) // 2, sha256(CASE WHEN f.i % 2 = 1 THEN t.h || f.h ELSE f.h || coalesce(t.h, '') END), f.proof || coalesce(t.h, '')
  FROM f LEFT JOIN t ON t.tree = f.tree AND t.k = f.k AND t.i = xor(f.i, 1) WHERE f.width > 1
), g AS (
  SELECT tree, pos, 0 AS k, tree AS i, (SELECT count(*) FROM s) AS width, h, proof FROM f WHERE width = 1
  UNION ALL
  SELECT g.tree, g.pos, g.k + 1, g.i // 2, (g.width + 1) // 2, sha256(CASE WHEN g.i % 2 = 1 THEN u.h || g.h ELSE g.h || coalesce(u.h, '') END), g.proof || coalesce(u.h, '')
  FROM g LEFT JOIN u ON u.k = g.k AND u.i = xor(g.i, 1) WHERE g.width > 1
), r AS (SELECT h FROM u WHERE width = 1)
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(g.proof) AS proof_sha256, g.h AS folded_root, g.h = r.h AS verified
FROM l JOIN s USING (tree) CROSS JOIN r JOIN g USING (tree, pos) WHERE g.width = 1
"""
