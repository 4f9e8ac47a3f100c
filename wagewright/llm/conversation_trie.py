"""A prefix trie of conversations that branch off others, merged family by family.

The conversations of one base id are a family. A conversation is rebuilt from the head it shares with its family's
first conversation and its own later turns. Each family's small trie is built by itself, and only its nodes, each with
the sums over the family's members, are shuffled for merging, so that what is in a node doesn't depend on how often a
turn comes. A node of the whole trie tells one family (that of its smallest member) that it counts there; with that,
every sum over a subtree is a sum of the families' own, and no walk over the whole trie is needed.

A turn travels as a digest of 128 bits of its role and text; a node's key is a digest of the way to it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import discard, stored
from wagewright.llm.sql_text import crc32_sql

ROOT = bytes(16)
#: Characters of joined ids that one row holds at most.
PIECE = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"
TURNS = "family long, conv_id long, has_turn boolean, turn long, said binary, tokens long"
NODES = "family long, node binary, parent binary, depth long, tokens long, least long, n long, inner boolean, ends array<long>"
SUMS = "node binary, parent binary, depth long, least long, n long, children long, leaves long, saved long"


def family_of(conv_id: Column, size: int) -> Column:
    return conv_id - conv_id % size


def turns_of(conversations: DataFrame, size: int) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    own = conversations.where("conv_id is not null")
    return own.select(family_of(F.col("conv_id"), size).alias("family"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).cast("long").alias("turn"), said.alias("said"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"))


def shared_turns(conv_id: int) -> int:
    """How many turns of its family's first conversation one begins with."""
    return zlib.crc32(str(conv_id).encode()) % 4


def family_trie(key: tuple, base: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one family's trie with their least member, their members and the conversations that end there."""
    turns: dict[int, list[tuple[bytes, int]]] = {}
    for frame in (base, others):
        for conv, _, _, said, tokens in sorted(zip(frame["conv_id"], frame["has_turn"], frame["turn"], frame["said"], frame["tokens"], strict=True)):
            turns.setdefault(int(conv), []).append((said, tokens))
    head = turns.get(int(key[0]), [])
    # parent, depth, tokens, least, n, inner, ends
    nodes: dict[bytes, list] = {}
    for conv in sorted(turns):
        shared = shared_turns(conv)
        at, parent = ROOT, None
        for depth, (said, tokens) in enumerate([(b"", 0), *head[:shared], *turns[conv][shared:]]):
            if depth:
                parent, at = at, hashlib.blake2b(at + said, digest_size=16).digest()
                nodes[parent][5] = True
            if (node := nodes.get(at)) is None:
                node = nodes[at] = [parent, depth, tokens, conv, 0, False, []]
            node[4] += 1
        node[6].append(conv)
    return pd.DataFrame([(int(key[0]), at, *node) for at, node in nodes.items()], columns=["family", "node", "parent", "depth", "tokens", "least", "n", "inner", "ends"])


def family_sums(_: tuple, nodes: pd.DataFrame, owned: pd.DataFrame) -> pd.DataFrame:
    """Of each of a family's nodes what it adds to that node's sums.

    owned: the nodes that count in this family, and whether they have children anywhere.
    """
    inner = dict(zip(owned["node"], owned["inner"], strict=True))
    sums = {at: [0, 0, 0] for at in nodes["node"]}  # children, leaves, saved
    for at, parent, _, tokens, n in sorted(zip(nodes["node"], nodes["parent"], nodes["depth"], nodes["tokens"], nodes["n"], strict=True), key=lambda x: -x[2]):
        own = sums[at]
        own[1] += at in inner and not inner[at]
        own[2] += (n - (at in inner)) * tokens
        if parent is not None:
            above = sums[parent]
            above[0] += at in inner
            above[1] += own[1]
            above[2] += own[2]
    out = nodes[["node", "parent", "depth", "least", "n"]].copy()
    out[["children", "leaves", "saved"]] = [sums[at] for at in nodes["node"]]
    return out


def joined_ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ids in order to texts of them, each of one node and at most PIECE characters."""
    last, first, ids, size = None, 0, [], 0

    def row() -> tuple:
        return last, first, ",".join(ids)

    for batch in batches:
        rows = []
        for node, conv in zip(batch["node"], batch["conv_id"], strict=True):
            if node != last or size > PIECE:
                if ids:
                    rows.append(row())
                last, first, ids, size = node, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield pd.DataFrame(rows, columns=["node", "first", "ids"])
    if ids:
        yield pd.DataFrame([row()], columns=["node", "first", "ids"])


def hashed_ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts of ids, in order of node and then of the first id, to one hash a node."""
    last, running = None, None
    for batch in batches:
        rows = []
        for node, ids in zip(batch["node"], batch["ids"], strict=True):
            if node == last:
                running.update(f",{ids}".encode())
            else:
                if running:
                    rows.append((last, running.hexdigest()))
                last, running = node, hashlib.sha256(ids.encode())
        yield pd.DataFrame(rows, columns=["node", "ends_sha256"])
    if running:
        yield pd.DataFrame([(last, running.hexdigest())], columns=["node", "ends_sha256"])


def ends_of(nodes: DataFrame) -> DataFrame:
    """node, ends_sha256 of the nodes at which conversations end.

    The ids are sorted by ranges over all tasks and joined to pieces there, so that the one task that hashes a node's
    pieces in their order reads few rows, however many conversations end alike.
    """
    ends = stored(nodes.select("node", F.explode("ends").alias("conv_id")), "ends")
    pieces = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInPandas(joined_ids, "node binary, first long, ids string")
    pieces = stored(pieces, "pieces")
    out = stored(pieces.repartition("node").sortWithinPartitions("node", "first").mapInPandas(hashed_ids, "node binary, ends_sha256 string"), "hashes")
    discard(ends, pieces)
    return out


def prefix_trie(conversations: DataFrame, size: int = 20) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node.

    Columns besides conv_id, turn, role and text are ignored. Rows without a conv_id take no part; null roles and texts
    are empty; null turns come first. Turns of one number are in the order of md5 of role and text, and repeated rows are
    turns of their own. A conversation without turns of its own after rebuilding ends at the root. Negative ids belong
    to the family towards zero. Without conversations there is no node, not even a root.

    A family is built in one task, from ``size`` conversations (twice as many around zero) as digests of their turns;
    a conversation is one sequence, so its turns can't be dealt out.
    """
    turns = turns_of(conversations, size)
    first, rest = turns.where("conv_id = family"), turns.where("conv_id <> family")
    nodes = stored(first.groupBy("family").cogroup(rest.groupBy("family")).applyInPandas(family_trie, NODES), "family-nodes")
    least = nodes.groupBy("node").agg(F.min("least").alias("least"), F.max("inner").alias("inner"))
    owned = stored(least.select(family_of(F.col("least"), size).alias("family"), "node", "inner"), "owned")
    added = nodes.drop("ends").groupBy("family").cogroup(owned.groupBy("family")).applyInPandas(family_sums, SUMS)
    total = added.groupBy("node").agg(
        F.min("least").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.sum("n").alias("n_convs"),
        F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
    )
    total = stored(total, "nodes")
    hashes = ends_of(nodes)
    out = total.join(hashes, "node", "left").join(total.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent", "left")
    none = hashlib.sha256(b"").hexdigest()
    out = out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
    discard(nodes, owned)
    return out


ORACLE_SQL = rf"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(r) || ':' || r || x)) AS n, {{'r': r, 'x': x}} AS said
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)
), o AS (SELECT c, list(said ORDER BY n) AS turns FROM t GROUP BY c
), k AS (SELECT o.c, {crc32_sql('CAST(o.c AS VARCHAR)')} % 4 AS h, o.turns, coalesce(b.turns, []) AS base FROM o LEFT JOIN o b ON b.c = o.c - o.c % 20
), p AS (SELECT c, list_concat(base[:h], turns[h + 1:]) AS path FROM k
), m AS (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM p
), n AS (
  SELECT path[:d] AS node, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(path) = d), '') AS ends,
    CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].x, '[^\x20\x09-\x0D]+')) END AS words
  FROM (SELECT c, d, path[:d] AS path0, path FROM m) GROUP BY path[:d], d, CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].x, '[^\x20\x09-\x0D]+')) END
), c AS (SELECT node[:d - 1] AS parent, count(*) AS n FROM n WHERE d > 0 GROUP BY 1
), s AS (
  SELECT a.node, count(*) FILTER (coalesce(c.n, 0) = 0) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved FROM n a JOIN n b ON b.d >= a.d AND b.node[:a.d] = a.node LEFT JOIN c ON c.parent = b.node GROUP BY a.node
)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s USING (node) LEFT JOIN c ON c.parent = n.node LEFT JOIN n u ON n.d > 0 AND u.node = n.node[:n.d - 1]
"""
