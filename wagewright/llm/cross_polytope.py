"""Approximate nearest neighbours by cross-polytope hashing.

A table's pseudo-rotation is three rounds of random signs and a fast Hadamard transform. A vector, scaled to unit
length, belongs to the cell of its nearest signed axis; a query looks into the cells of its nearest axes in every
table. Candidates are ranked exactly by inner product. How many tables and cells are needed is measured on a bounded
sample of queries against all vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagewright.llm.common import stored


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, d, h = len(x), x.shape[1], 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotations(dims: int, tables: int, seed: int = 11) -> np.ndarray:
    """Signs of the three rounds for each table."""
    return np.random.default_rng(seed).choice([-1.0, 1.0], (tables, 3, 1 << max(0, dims - 1).bit_length()))


def rotated(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), signs.shape[1]))
    out[:, : x.shape[1]] = x
    for round_signs in signs:
        out = hadamard(out * round_signs)
    return out


def signed_axes(y: np.ndarray, many: int) -> np.ndarray:
    """The ``many`` nearest signed axes of each row, nearest first; axis i is i, or i + d where it is negative."""
    both = np.concatenate([y, -y], axis=1)
    near = np.argpartition(-both, min(many, both.shape[1]) - 1, axis=1)[:, :many]
    return np.take_along_axis(near, np.argsort(-np.take_along_axis(both, near, 1), axis=1, kind="stable"), 1)


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda v: v != 0)


def _matrix(rows: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims))
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def best(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, ids, scores) of each query's k best rows of x but itself; ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    for at in range(0, len(q), 512):
        scores = q[at : at + 512] @ x.T
        scores[query_ids[at : at + 512, None] == ids[None, :]] = -np.inf
        top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        value = np.take_along_axis(scores, top, 1)
        row, column = np.nonzero(value > -np.inf)
        yield query_ids[at : at + 512][row], ids[top[row, column]], value[row, column]


def exact_sample(rows: DataFrame, k: int, dims: int, sample: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """About ``sample`` queries, chosen by hash, and each one's exact k nearest among all rows, found in one pass over
    them: the queries' vectors, and for each the matrix of its nearest."""
    asked = rows.where("asks").select("vec_id", "embedding").dropDuplicates(["vec_id"])
    n = max(1, asked.count())
    some = asked.where(F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(n)) < sample).orderBy("vec_id").collect()
    ids, queries = np.array([r["vec_id"] for r in some], dtype=np.int64), np.array([r["embedding"] + [0.0] * (dims - len(r["embedding"])) for r in some]).reshape(len(some), dims)
    shared = rows.sparkSession.sparkContext.broadcast((ids, queries))

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, queries = shared.value
        for batch in batches:
            own, x = batch["vec_id"].to_numpy(), _matrix(batch["embedding"], dims)
            for q, i, score in best(ids, queries, own, x, k):
                at = dict(zip(own.tolist(), batch["embedding"], strict=True))
                yield pd.DataFrame({"query_id": q, "vec_id": i, "score": score, "embedding": pd.Series([at[j] for j in i.tolist()], dtype=object)})

    found = rows.select("vec_id", "embedding").mapInPandas(look, "query_id long, vec_id long, score double, embedding array<double>")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    nearest_of: dict[int, list] = {int(i): [] for i in ids}
    for r in found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", rank).where(F.col("rank") <= k).collect():  # sample * k rows
        nearest_of[r["query_id"]].append(r["embedding"] + [0.0] * (dims - len(r["embedding"])))
    return queries, [np.array(nearest_of[int(i)]).reshape(-1, dims) for i in ids]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def choose(queries: np.ndarray, nearest_of: list[np.ndarray], signs: np.ndarray, recall: float) -> tuple[int, int]:
    """How many tables, and how many cells of each to look into, so that the sample's nearest are found with this recall
    at the least work: the share of the rows that a query meets in all tables, and a little for each table's copy."""
    axes = 2 * signs.shape[2]
    owner = np.repeat(np.arange(len(nearest_of)), [len(x) for x in nearest_of])
    if not len(owner):
        return 1, axes
    near, asks = unit(np.concatenate(nearest_of)), unit(queries)
    place = np.empty((len(signs), len(owner)), dtype=np.int64)  # of the neighbour's cell among the query's, for each table
    for t, own in enumerate(signs):
        cells = signed_axes(rotated(asks, own), axes)
        order = np.argsort(cells, axis=1)
        place[t] = order[owner, signed_axes(rotated(near, own), 1)[:, 0]]
    options = [(t * b / axes + 0.02 * t, t, b) for t in (1, 2, 4, 8, 16) if t <= len(signs) for b in sorted({1, 2, 3, 4, 6, 8, *(axes * i // 32 for i in range(1, 33))}) if 0 < b <= axes]
    fitting = [o for o in options if (place[: o[1]].min(0) < o[2]).mean() >= recall]
    return min(fitting)[1:]


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, recall: float = 0.95, most_tables: int = 16, sample: int = 128, block: int = 8192, query_block: int = 16_384) -> DataFrame:
    """vectors: vec_id, embedding. Returns query_id, rank, vec_id, score: each query's k nearest found.

    For about ``sample`` queries the exact nearest are found first; from them it follows how many tables and how many
    cells of each reach ``recall`` with least work, as it depends on the data how selective hashing can be. With
    recall 1 at no option but the last, all cells of one table are looked into, which is exact.

    Vectors that are null, zero or hold null or non-finite components take no part; shorter vectors count as ending in
    zeros. Of equal vectors only the k + 1 smallest ids can be among anyone's nearest, so no more are indexed. Repeated
    rows of one vec_id are one candidate (with differing vectors the best counts) and one query. A query with fewer than
    k candidates gets all that were found. Other columns of vectors are ignored, whatever their names; an empty table
    gives no rows.
    """
    all_rows = stored(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), is_query.alias("asks")).where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))), "vectors")
    dims = all_rows.agg(F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()[0]
    order = Window.partitionBy("embedding").orderBy("vec_id")
    distinct = stored(all_rows.select("vec_id", "embedding").distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n"), "distinct")
    asking = stored(all_rows.where("asks").select("vec_id", "embedding").distinct(), "queries")
    signs = rotations(dims, most_tables)
    looked = distinct.withColumn("asks", F.lit(False)).unionByName(asking.withColumn("asks", F.lit(True)))
    tables, many = choose(*exact_sample(looked, k, dims, sample), signs, recall)
    signs = signs[:tables]
    # Cells go to tasks one by one if a query needs few of them, and else in parts, so that its vector travels less often.
    parts = 2 * signs.shape[2] if many <= 4 else min(16, 2 * signs.shape[2])

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = unit(_matrix(batch["embedding"], dims))
            for t in range(tables):
                cell = signed_axes(rotated(x, signs[t]), 1)[:, 0]
                yield batch.assign(t=t, cell=cell, part=cell % parts)[["vec_id", "embedding", "t", "cell", "part"]]

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = unit(_matrix(batch["embedding"], dims))
            for t in range(tables):
                cells = np.sort(signed_axes(rotated(x, signs[t]), many), axis=1)
                for p in range(parts):
                    own = [row[row % parts == p] for row in cells]
                    keep = np.array([len(o) > 0 for o in own])
                    if keep.any():
                        yield pd.DataFrame({"query_id": batch["vec_id"].to_numpy()[keep], "query": batch["embedding"].to_numpy()[keep], "cells": pd.Series([o for o in own if len(o)], dtype=object), "t": t, "part": p})

    placed = stored(distinct.mapInPandas(index, "vec_id long, embedding array<double>, t int, cell int, part int"), "cells")
    counts = {(r["t"], r["part"]): -(-r["count"] // block) for r in placed.groupBy("t", "part").count().collect()}  # at most tables x parts rows
    blocks = F.element_at(F.create_map(*(F.lit(x) for t in range(tables) for p in range(parts) for x in (t * parts + p, max(1, counts.get((t, p), 0))))), (F.col("t") * parts + F.col("part")).cast("int"))
    # Both sides are cut into blocks, so no task holds more than a block of each whatever the data.
    query_blocks = max(1, -(-asking.count() // query_block))
    held = placed.withColumn("b", F.pmod(F.xxhash64("vec_id"), blocks).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asked = asking.mapInPandas(ask, "query_id long, query array<double>, cells array<int>, t int, part int")
    asked = asked.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0), blocks - 1)))

    def rank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            wanted = np.zeros((len(right), 2 * signs.shape[2]), dtype=bool)
            wanted[np.repeat(np.arange(len(right)), right["cells"].map(len)), np.concatenate(right["cells"].to_list())] = True
            q, x = _matrix(right["query"], dims), _matrix(left["embedding"], dims)
            asks, ids = right["query_id"].to_numpy(), left["vec_id"].to_numpy()
            for cell, rows in left.groupby("cell").indices.items():
                who = np.flatnonzero(wanted[:, cell])
                out += best(asks[who], q[who], ids[rows], x[rows], k)
        merged = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        found = pd.DataFrame({"query_id": merged[0], "vec_id": merged[1], "score": merged[2]})
        found = found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return found[found.groupby("query_id").cumcount() < k]

    keys = ["t", "part", "b", "qb"]
    hits = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(rank, "query_id long, vec_id long, score double")
    once = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
