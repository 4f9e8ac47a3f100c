"""SimHash near-duplicates, found by the generalised pigeonhole principle.

The 64 bits are split into m groups of correlated bits. If two fingerprints differ in at most r bits, then for any
thresholds t_1 .. t_m with sum(t) = r - m + 1 (a threshold of -1 leaves its group out) they differ in at most t_i bits
within some group i. Each fingerprint gets its own thresholds: those for which the estimated number of probes and
candidates is least, by dynamic programming over the groups. Its probes are then looked up among all fingerprints'
group values, and hits are verified on the whole fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import LOWER_BYTES, TEXT_ROWS, stored
from wagewright.llm.components import connected_components

BITS = 64
#: About how many fingerprints, chosen by a hash, from which correlations of bits and candidate counts are estimated.
SAMPLE = 4096
#: Cost of one probe in candidates that are only verified.
PROBE_COST = 1.0


def fingerprint(text: str, shingle: int = 3) -> int:
    """The fingerprint of one text; 0 without words. Shingles are hashed in blocks, so long texts need little memory."""
    import xxhash

    words = text.encode().translate(LOWER_BYTES).split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - size + 1
    ones, digest = np.zeros(BITS, dtype=np.int64), xxhash.xxh64_intdigest
    for k in range(0, n, 65_536):
        s, e = starts[k : min(n, k + 65_536)].tolist(), ends[k + size - 1 : min(n, k + 65_536) + size - 1].tolist()
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(s, e, strict=True)], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed long. A null text has no words."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return of(F.coalesce(text, F.lit("")))


def bit_groups(sample: np.ndarray, m: int, width: int = BITS) -> list[list[int]]:
    """m groups of nearly equal size of the first ``width`` bits, with correlated bits together.

    sample: fingerprints, as rows of 64-bit words. Greedy: a group starts with the first free bit and takes the free
    bit that correlates most with it.
    """
    words = sample.reshape(len(sample), -(-width // 64), 1)
    bits = ((words >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).reshape(len(words), 64 * words.shape[1])[:, :width]
    spread = bits.astype(float) - bits.mean(0) if len(bits) else np.zeros((1, width))
    norm = np.sqrt((spread**2).sum(0))
    near = np.abs(spread.T @ spread) / np.maximum(np.outer(norm, norm), 1e-9)
    free, groups = list(range(width)), []
    for g in range(m):
        size = width // m + (g < width % m)
        own = [free.pop(0)] if free else []
        while len(own) < size:
            best = max(free, key=lambda b: (near[b, own].mean(), -b))
            free.remove(best)
            own.append(best)
        groups.append(sorted(own))
    return groups


def masks_within(bits: list[int], t: int) -> list[int]:
    """All masks of at most t of these bits; none for t = -1."""
    return [sum(1 << b for b in chosen) for k in range(t + 1) for chosen in combinations(bits, k)]


def allocate(costs: np.ndarray, total: int) -> np.ndarray:
    """Thresholds with the given sum and the least cost, for each row. costs[row, group, t + 1] is that of threshold t.

    Dynamic programming over the groups: best[s] is the least cost of the groups so far if their thresholds + 1 sum
    up to s.
    """
    n, m, levels = costs.shape
    most = total + m
    best, choice = np.full((n, most + 1), np.inf), np.zeros((m, n, most + 1), dtype=np.int64)
    best[:, 0] = 0
    for g in range(m):
        nxt = np.full((n, most + 1), np.inf)
        for s in range(most + 1):
            for t in range(min(levels, s + 1)):
                cost = best[:, s - t] + costs[:, g, t]
                better = cost < nxt[:, s]
                nxt[better, s], choice[g, better, s] = cost[better], t
        best = nxt
    out, s = np.zeros((n, m), dtype=np.int64), np.full(n, most)
    for g in range(m - 1, -1, -1):
        out[:, g] = choice[g, np.arange(n), s]
        s = s - out[:, g]
    return out - 1


def links(prints: DataFrame, radius: int = 3, m: int = 2) -> DataFrame:
    """a, b for all pairs of different fingerprints (column fp, distinct longs) that differ in at most radius bits.

    No pair is lost: thresholds only change which probe finds it.
    """
    spark = prints.sparkSession
    n = prints.count()
    some = prints.where(F.pmod(F.xxhash64("fp"), F.lit(max(n, 1))) < SAMPLE)
    sample = np.array(sorted(r["fp"] for r in some.select("fp").collect()), dtype=np.int64).view(np.uint64)
    m = max(1, min(m, radius + 1))
    groups, total = bit_groups(sample, m), radius - m + 1
    whole = [sum(1 << b for b in own) for own in groups]
    # Estimated candidates: those that the sample has within t, and those that chance brings.
    chance = [[0.0, *(n * sum(comb(len(own), k) for k in range(t + 1)) / 2.0 ** len(own) for t in range(radius + 1))] for own in groups]
    probes = [[0, *(sum(comb(len(own), k) for k in range(t + 1)) for t in range(radius + 1))] for own in groups]
    plan = spark.sparkContext.broadcast((sample, n, groups, whole, chance, probes))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample, n, groups, whole, chance, probes = plan.value
        masks = {(g, t): np.array(masks_within(own, t), dtype=np.uint64) for g, own in enumerate(groups) for t in range(min(2, total) + 1)}
        for batch in batches:
            for k in range(0, len(batch), 1024):
                fp = batch["fp"].to_numpy()[k : k + 1024].view(np.uint64)
                costs = np.zeros((len(fp), len(groups), total + len(groups) + 1))
                for g, mask in enumerate(whole):
                    apart = np.bitwise_count((fp[:, None] ^ sample[None, :]) & np.uint64(mask))
                    for t in range(min(costs.shape[2] - 1, radius + 1)):
                        seen = (apart <= t).sum(1) * (n / max(1, len(sample)))
                        costs[:, g, t + 1] = seen + chance[g][t + 1] + PROBE_COST * probes[g][t + 1]
                thresholds = allocate(costs, total)
                for g, mask in enumerate(whole):
                    for t in np.unique(thresholds[:, g]):
                        if t < 0:
                            continue
                        if (g, int(t)) not in masks:
                            masks[g, int(t)] = np.array(masks_within(groups[g], int(t)), dtype=np.uint64)
                        own = fp[thresholds[:, g] == t]
                        keys = (own & np.uint64(mask))[:, None] ^ masks[g, int(t)][None, :]
                        for at in range(0, len(own), max(1, 200_000 // keys.shape[1])):
                            part = keys[at : at + max(1, 200_000 // keys.shape[1])]
                            yield pd.DataFrame({"g": np.full(part.size, g, dtype=np.int32), "v": part.ravel().view(np.int64), "a": np.repeat(own[at : at + len(part)], part.shape[1]).view(np.int64)})

    asked = prints.select("fp").mapInPandas(probe, "g int, v long, a long")
    held = prints.select(F.col("fp").alias("b"), F.explode(F.array(*(F.struct(F.lit(g).alias("g"), F.col("fp").bitwiseAND(F.lit(np.uint64(mask).astype(np.int64).item())).alias("v")) for g, mask in enumerate(whole)))).alias("e")).select("b", "e.g", "e.v")
    near = asked.join(held, ["g", "v"]).where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _rooted(prints: DataFrame, least: Column, radius: int, m: int) -> DataFrame:
    """fp, root, least (of the rows with that fp) for each distinct fp; root is the same for all of a component."""
    nodes = stored(prints.groupBy("fp").agg(F.min(least).alias("least")), "nodes")
    roots = connected_components(links(nodes, radius, m)).withColumnRenamed("node", "fp")
    return nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, m: int = 2) -> DataFrame:
    """doc_id, fp (signed long), fingerprint (16 hex digits), component_id for each row of docs.

    Equal fingerprints are one node, so exact copies cost nothing more however many there are. component_id is the
    smallest doc_id of the component (null ids don't count; it is null if there are no others). Null and empty
    texts have fingerprint zero and link like any other. Repeated rows get equal results. Columns besides doc_id and text
    are ignored, whatever their names; an empty table gives no rows.
    """
    prints = stored(docs.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("fp")), "prints", TEXT_ROWS)
    rooted = _rooted(prints, F.col("doc_id"), radius, m)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    member = rooted.join(least, "root").select("fp", "component_id")
    found = prints.join(member, "fp")
    return found.select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
