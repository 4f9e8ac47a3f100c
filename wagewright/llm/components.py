"""Connected components of a graph whose nodes are longs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import discard, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: columns a, b (long). Returns node, root: the smallest node of its component.

    Each round every node takes its least neighbour, if that is smaller, as its parent; the trees that arise are
    flattened, and the edges between their roots are the graph of the next round. A node that stays a root has either
    taken in a neighbour or has a smaller one a round later, so two rounds halve the nodes at least, whatever the
    order of their values, and the loop ends when no edge is left. The least neighbour is an aggregate that combines
    before the shuffle, so hubs don't gather in one task. Nodes without an edge have no row; an empty graph gives no
    row. Each step is written to the shared folder.
    """
    both = stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        .select("e.a", "e.b")
        .distinct(),
        "edges",
    )
    roots = None
    while True:
        step = flattened(stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "roots"))
        if roots is None:
            roots = step
        else:
            up = step.select(F.col("node").alias("root"), F.col("root").alias("up"))
            before, roots = roots, stored(roots.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots")
            discard(before)
        ends = [step.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")) for end in ("a", "b")]
        between = both.join(ends[0], "a").join(ends[1], "b").where("root_a <> root_b")
        before, both = both, stored(between.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(), "edges")
        discard(before, None if step is roots else step)
        if both.isEmpty():
            return roots


def flattened(parents: DataFrame) -> DataFrame:
    """``parents``: node, root (of each node a parent of at most its value). Returns them with the tree's root as root.

    Each step takes the parent's parent, which halves the way to go.
    """
    before = None
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("up"))
        step = stored(parents.join(up, "root").select("node", F.col("up").alias("root"), (F.col("up") < F.col("root")).alias("moved")), "roots")
        discard(before)
        parents, before = step.select("node", "root"), step
        if step.where("moved").isEmpty():
            return parents
