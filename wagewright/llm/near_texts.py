"""Near-duplicate texts: long SimHash fingerprints probed by the generalised pigeonhole principle, then verified; what
they leave is found by prefixes of the shingle sets.

Texts count as near if the sets of their word shingles have a Jaccard similarity of at least a threshold. SimHash bits
differ for such a pair with a known chance, so a fingerprint of ``groups`` times ``bits`` bits is probed like that of
``simhash.links``: its groups of correlated bits get thresholds that sum up to one for each group, by dynamic
programming for every fingerprint. Both numbers follow from the number of texts and the recall that is asked for. What
the probes find is compared on 64 bits of the fingerprint, then on the whole of it, and what is left is verified on the
whole shingle sets.

That connects most near texts, but bits that differ by chance hide some. If all sets are put in one order of shingles,
two that are similar enough share one of their first (about a fifth of them at 0.8). So texts that the first pass left
apart are compared wherever they share such a shingle, and every bound on the way (sizes, places, parities) is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import LOWER_BYTES, TEXT_ROWS, bounded, discard, row_key, stored
from wagewright.llm.components import connected_components
from wagewright.llm.simhash import allocate, bit_groups, masks_within

#: About how many fingerprints, chosen by a hash, from which correlations of bits and candidate counts are estimated.
SAMPLE = 1024
#: Texts with one group value beyond which they are compared with the first of them before they are with each other.
DENSE = 32
#: Odd multipliers that turn one hash into further independent ones.
MIX = np.random.default_rng(17).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
KEY = "no_id boolean, id long, h1 long, h2 long"
#: About how many rows, chosen by a hash, tell which shingles are common, and how many of these are put last. That only
#: moves work: sets in any order have prefixes that meet.
COMMON_ROWS, COMMON = 4096, 100_000
#: Rows of prefixes that are looked through at once for shingles of several texts, and prefixes that are dealt at once.
PART_ROWS, PREFIXES = 250_000, 2000
#: Longs of a sketch that holds the parities of a set's hashes, and of a small one that is folded from it.
SKETCH, FOLDED = 32, 8
#: Added where a bound is a product of fractions, which may come out a little too high.
SLACK = 1e-9


def apart(similarity: float) -> float:
    """The chance that a bit differs between sets of one size with this Jaccard similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def shape(texts: int, similarity: float, recall: float) -> tuple[int, int]:
    """Bits of a group, so that it has about four values for each text, and how many groups find a pair of just this
    similarity with at least the chance ``recall``, if each finds those within one bit."""
    p, bits = apart(similarity), min(40, max(14, math.ceil(math.log2(max(2, texts))) + 2))
    once = (1 - p) ** bits + bits * p * (1 - p) ** (bits - 1)
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - once)))


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted hashes of the different shingles of lower-cased words; all words are one shingle if they are fewer."""
    import xxhash

    words = text.encode().translate(LOWER_BYTES).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    size = min(size, len(words))
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - size + 1
    found = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist(), strict=True)), np.uint64, n)
    return np.unique(found)


def long_print(hashes: np.ndarray, words: int) -> np.ndarray:
    """A fingerprint of 64 * words bits. A bit that is set in just half of the hashes follows the least hash."""
    out = np.zeros(words, dtype=np.uint64)
    for k in range(words):
        ones, least = np.zeros(64, dtype=np.int64), None
        for at in range(0, len(hashes), 65_536):
            h = hashes[at : at + 65_536] * MIX[k]
            h ^= h >> np.uint64(31)
            h *= MIX[63 - k]
            h ^= h >> np.uint64(29)
            bits = np.unpackbits(np.ascontiguousarray(h, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(0, dtype=np.int64)
            least = bits[0] if least is None else least
        chosen = (2 * ones > len(hashes)) | ((2 * ones == len(hashes)) & (least == 1)) if len(hashes) else np.zeros(64, dtype=bool)
        out[k] = np.packbits(chosen, bitorder="little").view("<u8")[0]
    return out


def common_shingles(docs: DataFrame, texts: int, shingle: int) -> DataFrame:
    """token, count: hashes of shingles that several of about COMMON_ROWS rows hold, the commonest ones."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["text"]:
                yield pd.DataFrame({"token": shingle_set(text, shingle).view(np.int64)})

    some = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(texts, 1))) < COMMON_ROWS).where("text is not null")
    counts = some.select("text").mapInPandas(cut, "token long").groupBy("token").count().where("count > 1")
    return stored(counts.orderBy(F.desc("count"), "token").limit(COMMON), "common", TEXT_ROWS)


def prefix(own: np.ndarray, similarity: float, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first of a set's shingles, one of which any set that is similar enough has among its own first.

    Common shingles come last, by their counts; all others go by their hash.
    """
    n = len(own) - math.ceil(similarity * len(own) - SLACK) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
        own = own[np.argsort(np.where(common[at] == own, counts[at], 0), kind="stable")]
    return own[:n]


def sketch(own: np.ndarray) -> np.ndarray:
    """Parities of how many hashes fall to each of 64 * SKETCH bits. Sketches differ in no more bits than sets in hashes."""
    odd = np.bincount((own % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8")


def compact(prints: np.ndarray, groups: list[list[int]]) -> np.ndarray:
    """Each print's value in each group, with the group's bits side by side."""
    one, out = np.uint64(1), np.zeros((len(prints), len(groups)), dtype=np.uint64)
    for g, own in enumerate(groups):
        for j, b in enumerate(own):
            out[:, g] |= ((prints[:, b // 64] >> np.uint64(b % 64)) & one) << np.uint64(j)
    return out


def _prints_of(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.int64).view(np.uint64) if len(column) else np.zeros((0, 1), dtype=np.uint64)


def most_apart(bits: int, similarity: float) -> int:
    """Differing bits beyond which sets are less similar but for a chance of about 1 in 300,000."""
    p = apart(similarity)
    return math.floor(bits * p + 4.5 * math.sqrt(bits * p * (1 - p)))


def fingerprinted(docs: DataFrame, common: DataFrame, shingle: int, words: int, similarity: float) -> DataFrame:
    """key, s1, s2 (128-bit hash of the shingle set), size, print, prefix and sketch (arrays of longs) for each row of docs."""
    found = sorted((r["token"] % 2**64, r["count"]) for r in common.collect())
    order = docs.sparkSession.sparkContext.broadcast((np.array([x for x, _ in found], dtype=np.uint64), np.array([n for _, n in found], dtype=np.int64)))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        common, counts = order.value
        for batch in batches:
            rows = []
            for text in batch["text"]:
                own = shingle_set(text, shingle)
                digest = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), dtype="<i8")
                rows.append((int(digest[0]), int(digest[1]), len(own), long_print(own, words).view(np.int64), prefix(own, similarity, common, counts).view(np.int64), sketch(own)))
            made = pd.DataFrame(rows, columns=["s1", "s2", "size", "print", "prefix", "sketch"])
            yield pd.concat([batch[["no_id", "id", "h1", "h2"]].reset_index(drop=True), made], axis=1)

    key = row_key(F.col("doc_id"), F.col("text"))
    flat = docs.select(key.alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    flat = flat.select(F.col("key.id").isNull().alias("no_id"), F.coalesce("key.id", F.lit(0)).cast("long").alias("id"), F.coalesce("key.h1", F.lit(0)).alias("h1"), "key.h2", "text")
    return stored(flat.mapInPandas(cut, f"{KEY}, s1 long, s2 long, size long, print array<long>, prefix array<long>, sketch array<long>"), "prints", TEXT_ROWS)


def probed(nodes: DataFrame, bits: int, m: int) -> tuple[DataFrame, DataFrame]:
    """(probes, index): cell, node, p for each fingerprint (column print) of nodes; p are its first 64 bits.

    The cell is a group's number and a value of it; the index has a node's own m values, the probes those within its
    thresholds.
    """
    n = nodes.count()
    some = nodes.where(F.pmod(F.xxhash64("node", F.lit("sample")), F.lit(max(n, 1))) < SAMPLE).select("print").orderBy("print").collect()
    width = m * bits
    sample = np.array([r["print"] for r in some], dtype=np.int64).view(np.uint64).reshape(len(some), -(-width // 64))
    groups = bit_groups(sample, m, width)
    values, total = compact(sample, groups), m
    levels = min(4, total + 2)  # thresholds from -1 to 2
    chance = [0.0, *(n * sum(math.comb(bits, k) for k in range(t + 1)) / 2.0**bits for t in range(levels - 1))]
    count = [0, *(sum(math.comb(bits, k) for k in range(t + 1)) for t in range(levels - 1))]
    plan = nodes.sparkSession.sparkContext.broadcast((groups, values, n))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        groups, values, n = plan.value
        masks = [np.array(masks_within(list(range(bits)), t), dtype=np.uint64) for t in range(levels - 1)]
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                prints = _prints_of(part["print"])
                own = compact(prints, groups)
                costs = np.zeros((len(part), m, levels))
                for g in range(m):
                    d = np.bitwise_count(own[:, g, None] ^ values[None, :, g])
                    for t in range(levels - 1):
                        costs[:, g, t + 1] = (d <= t).sum(1) * (n / max(1, len(values))) + chance[t + 1] + count[t + 1]
                thresholds = allocate(costs, total)
                node, first = part["node"].to_numpy(), prints[:, 0].view(np.int64)
                for g in range(m):
                    for t in range(levels - 1):
                        who = np.flatnonzero(thresholds[:, g] == t)
                        if len(who):
                            cells = ((own[who, g][:, None] ^ masks[t][None, :]) | np.uint64(g << bits)).view(np.int64)
                            many = cells.shape[1]
                            for k in range(0, len(who), max(1, 200_000 // many)):
                                w = who[k : k + max(1, 200_000 // many)]
                                yield pd.DataFrame({"cell": cells[k : k + len(w)].ravel(), "node": np.repeat(node[w], many), "p": np.repeat(first[w], many)})

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        groups = plan.value[0]
        for batch in batches:
            prints = _prints_of(batch["print"])
            cells = compact(prints, groups) | (np.arange(m, dtype=np.uint64) << np.uint64(bits))[None, :]
            yield pd.DataFrame({"cell": cells.view(np.int64).ravel(), "node": np.repeat(batch["node"].to_numpy(), m), "p": np.repeat(prints[:, 0].view(np.int64), m)})

    rows = nodes.select("node", "print").repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "node")
    kinds = "cell long, node long, p long"
    return rows.mapInPandas(probe, kinds), rows.mapInPandas(index, kinds)


def near(most: int, left: str = "p", right: str = "q") -> Column:
    return F.bit_count(F.col(left).bitwiseXOR(F.col(right))) <= most


def pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def shingle_sets(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """node, own: the shingle set of each of nodes (node, key), read from one of its rows in docs."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"], "own": [shingle_set(t, shingle).view(np.int64) for t in batch["text"]]})

    key = row_key(F.col("doc_id"), F.col("text"))
    flat = docs.select(key.alias("key"), "text").where("text is not null")
    flat = flat.select(F.struct(F.col("key.id").isNull().alias("no_id"), F.coalesce("key.id", F.lit(0)).cast("long").alias("id"), "key.h1", "key.h2").alias("key"), "text")
    texts = flat.join(nodes, "key").select("node", "text").dropDuplicates(["node"])
    return stored(texts.mapInPandas(cut, "node long, own array<long>"), "sets", TEXT_ROWS)


def may_be_similar(size_a: Column, size_b: Column, sketch_a: list[Column], sketch_b: list[Column], similarity: float) -> Column:
    """False only for sets that can't be similar enough by their sizes and parities."""
    differ = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(sketch_a, sketch_b, strict=True)), F.lit(0))
    sizes = F.least(size_a, size_b) >= similarity * F.greatest(size_a, size_b) - SLACK
    return sizes & (differ <= (1 - similarity) / (1 + similarity) * (size_a + size_b) + SLACK)


def possible(nodes: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """pairs (a, b) without those that can't be similar enough by their sizes and whole sketches."""
    one, two = (nodes.select(F.col("node").alias(n), F.col("size").alias(f"size_{n}"), F.col("sketch").alias(f"sketch_{n}")) for n in ("a", "b"))
    sketches = [[F.col(f"sketch_{n}")[k] for k in range(SKETCH)] for n in ("a", "b")]
    return pairs.join(one, "a").join(two, "b").where(may_be_similar(F.col("size_a"), F.col("size_b"), *sketches, similarity)).select("a", "b")


def likely(nodes: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """Those of pairs (a, b) whose whole fingerprints are near enough and that are possible."""
    one, two = (nodes.select(F.col("node").alias(n), F.col("print").alias(p)) for n, p in (("a", "x"), ("b", "y")))
    differ = F.aggregate(F.zip_with("x", "y", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, n: s + n)
    p = apart(similarity)
    close = pairs.join(one, "a").join(two, "b").where(differ <= F.size("x") * 64 * p + 4.5 * F.sqrt(F.size("x") * 64 * p * (1 - p)))
    return stored(possible(nodes, close.select("a", "b"), similarity), "close")


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Those of pairs (a, b), which ``stored`` returned, whose whole shingle sets are similar enough. Removes pairs."""
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "key"), "node"), "wanted")
    sets = shingle_sets(docs, bounded(wanted), shingle)
    one = sets.select(F.col("node").alias("a"), F.col("own").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("own").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    kept = pairs.join(one, "a").join(two, "b").where(both >= similarity * (F.size("x") + F.size("y") - both) - SLACK)
    out = stored(kept.select("a", "b"), "verified")
    discard(pairs, wanted, sets)
    return out


def near_pairs(docs: DataFrame, nodes: DataFrame, bits: int, m: int, shingle: int, similarity: float) -> DataFrame:
    """a, b: nodes whose shingle sets are similar enough, as far as the probes find them; ``missed_pairs`` finds the rest.

    Each pair is looked for from the side of the smaller node, whose thresholds alone let no pair within the radius pass.
    Of a cell that holds over DENSE nodes, all are compared with its first; only those that aren't similar to it are
    compared with each other. So a large group of near copies makes pairs with its first text alone.
    """
    most = most_apart(64, similarity)
    probes, index = probed(nodes, bits, m)
    index = stored(index, "index")
    dense = index.groupBy("cell").agg(F.count("*").alias("n"), F.min(F.struct("node", "p")).alias("first")).where(F.col("n") > DENSE)
    dense = stored(dense.select("cell", F.col("first.node").alias("first"), F.col("first.p").alias("q")), "dense")
    held = index.withColumnsRenamed({"node": "other", "p": "q"})
    if dense.isEmpty():
        found = probes.join(held.hint("shuffle_hash"), "cell").where((F.col("node") < F.col("other")) & near(most))
        pairs = stored(found.select(*pair("node", "other")).distinct(), "pairs")
        out = verified(docs, nodes, likely(nodes, pairs, similarity), shingle, similarity)
        discard(index, dense, pairs)
        return out
    probes = stored(probes, "probes")
    sparse = held.join(bounded(dense).select("cell"), "cell", "left_anti")
    found = probes.join(sparse.hint("shuffle_hash"), "cell").where((F.col("node") < F.col("other")) & near(most)).select(*pair("node", "other"))
    members = stored(probes.unionByName(index).join(bounded(dense), "cell").select("cell", "node", "p", "first", "q"), "members")
    first = stored(members.where((F.col("node") != F.col("first")) & near(most)).select(*pair("node", "first")).distinct(), "firsts")
    like_first = verified(docs, nodes, likely(nodes, first, similarity), shingle, similarity)
    done = like_first.select("a", "b").unionByName(like_first.select(F.col("b").alias("a"), F.col("a").alias("b"))).withColumnsRenamed({"a": "node", "b": "first"})
    rest = members.where(F.col("node") != F.col("first")).join(done, ["node", "first"], "left_anti").select("cell", "node", "p")
    rest = stored(rest, "rest")
    others = index.join(rest.select("cell", "node").distinct(), ["cell", "node"], "left_semi").select("cell", F.col("node").alias("other"), F.col("p").alias("q"))
    more = rest.join(others, "cell").where((F.col("node") < F.col("other")) & near(most)).select(*pair("node", "other"))
    pairs = stored(found.unionByName(more).distinct().join(first, ["a", "b"], "left_anti"), "pairs")
    out = stored(like_first.unionByName(verified(docs, nodes, likely(nodes, pairs, similarity), shingle, similarity)), "near")
    discard(index, dense, probes, members, first, rest, pairs)
    return out


def sharing(rooted: DataFrame, common: DataFrame) -> DataFrame:
    """token, node, root, at: the rows of prefixes (of rooted: node, root, prefix) whose token is in those of several roots.

    Nearly all tokens are in one prefix alone. So they are dealt by their values in arrays and sifted part by part; no
    part holds a common one, which may have any number of rows and is left to a join.
    """
    rows = rooted.agg(F.sum(F.size("prefix"))).first()[0] or 0
    parts = max(12, -(-rows // PART_ROWS))
    known = rooted.sparkSession.sparkContext.broadcast(np.array(sorted(r["token"] for r in common.select("token").collect()), dtype=np.int64))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["prefix"].map(len).to_numpy(dtype=np.int64)
            if not sizes.sum():
                continue
            token = np.concatenate(batch["prefix"].to_list()).astype(np.int64)
            at = (np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
            own = np.repeat(np.arange(len(batch)), sizes)
            part = (token.view(np.uint64) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            order = order[~np.isin(token[order], known.value)]
            node, apart = batch["node"].to_numpy(), (batch["root"] - batch["node"]).to_numpy()
            ends = np.searchsorted(part[order], np.arange(parts + 1))
            out = [(p, token[o], node[own[o]], apart[own[o]], at[o]) for p in range(parts) if len(o := order[ends[p] : ends[p + 1]])]
            yield pd.DataFrame(out, columns=["part", "token", "node", "apart", "at"])

    def sift(found: pd.DataFrame) -> pd.DataFrame:
        token, node, apart, at = (np.concatenate(found[c].to_list()) for c in ("token", "node", "apart", "at"))
        order, root = np.argsort(token, kind="stable"), node + apart
        token, root = token[order], root[order]
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        several = np.minimum.reduceat(root, starts) < np.maximum.reduceat(root, starts)
        kept = np.repeat(several, np.diff(starts, append=len(token)))
        return pd.DataFrame({"token": token[kept], "node": node[order][kept], "root": root[kept], "at": at[order][kept]})

    dealt = rooted.mapInPandas(deal, "part int, token array<long>, node array<long>, apart array<long>, at array<int>")
    rare = stored(dealt.groupBy("part").applyInPandas(sift, "token long, node long, root long, at int"), "rare", PREFIXES)
    often = stored(rooted.select("node", "root", F.posexplode("prefix").alias("at", "token")).join(bounded(common).select("token"), "token"), "often")
    mixed = often.groupBy("token").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most").select("token")
    out = stored(rare.unionByName(often.join(mixed, "token").select(*rare.columns)), "sharing")
    discard(rare, often)
    return out


def missed_pairs(docs: DataFrame, nodes: DataFrame, common: DataFrame, roots: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """a, b: all nodes of different roots (node, root; stored) whose shingle sets are similar enough.

    Only shingles that stand in prefixes of several roots are looked at, so a large group that has one root already
    costs nothing more. Sizes, places in the order of shingles, parities and how many shingles of the prefixes are shared
    bound what two sets can share.
    """
    rooted = nodes.join(bounded(roots), "node", "left").select("node", F.coalesce("root", "node").alias("root"), "prefix")
    cells = sharing(rooted, common)
    folded = [reduce(Column.bitwiseXOR, (F.col("sketch")[k] for k in range(at, SKETCH, FOLDED))) for at in range(FOLDED)]
    members = cells.join(nodes.select("node", "size", "sketch"), "node")
    members = stored(members.select("token", "node", "root", "size", "at", *(folded[k].alias(f"k{k}") for k in range(FOLDED))), "members")
    one, two = (members.withColumnsRenamed({c: f"{c}{n}" for c in members.columns if c != "token"}) for n in ("_a", "_b"))
    size_a, size_b, at_a, at_b = (F.col(c) for c in ("size_a", "size_b", "at_a", "at_b"))
    shared = F.least(at_a, at_b) + 1 + F.least(size_a - 1 - at_a, size_b - 1 - at_b)
    sketches = [[F.col(f"k{k}_{n}") for k in range(FOLDED)] for n in ("a", "b")]
    found = one.join(two, "token").where((F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b")))
    found = found.where((shared >= similarity / (1 + similarity) * (size_a + size_b) - SLACK) & may_be_similar(size_a, size_b, *sketches, similarity))
    # What two sets share beyond the prefix that ends first is in the rest of that set.
    counted = found.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "size_a", "size_b").agg(F.count("*").alias("n"))
    most = F.col("n") + F.ceil(similarity * F.greatest(size_a, size_b) - SLACK) - 1
    pairs = stored(counted.where(most >= similarity / (1 + similarity) * (size_a + size_b) - SLACK).select("a", "b"), "missed")
    out = verified(docs, nodes, stored(possible(nodes, pairs, similarity), "possible"), shingle, similarity)
    discard(cells, members, pairs)
    return out


def keep_one(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, recall: float = 0.5) -> DataFrame:
    """One row of each group of near-duplicates, that of the smallest doc_id, with docs' own columns.

    A group is what pairs of texts with at least this similarity connect: all such pairs, and none is taken unverified.
    ``recall`` is about the share of pairs of just that similarity that fingerprints find already (more beyond it); it
    steers the cost and not the result. Texts with equal shingle sets
    are one node, so exact copies cost nothing more however many there are. Null texts and texts without words are
    near to each other and to nothing else.

    A row is known by its id and its text (``row_key``), so unlike texts under one doc_id, or under none, are rows of
    their own groups. Of rows of that doc_id in one group the one with the least key stays, and of equal ones one.
    Rows without a doc_id stay only in groups that have no id at all. An empty table stays empty. Columns of docs
    besides doc_id and text are carried along whatever their names.
    """
    texts = docs.count()
    bits, m = shape(texts, similarity, recall)
    common = common_shingles(docs, texts, shingle)
    prints = fingerprinted(docs, common, shingle, -(-bits * m // 64), similarity)
    own = F.struct("no_id", "id", "h1", "h2")
    nodes = prints.groupBy("s1", "s2").agg(F.min(own).alias("key"), F.min("size").alias("size"), F.min("print").alias("print"), F.min("prefix").alias("prefix"), F.min("sketch").alias("sketch"))
    nodes = stored(nodes.select(F.monotonically_increasing_id().alias("node"), "key", "size", "print", "prefix", "sketch"), "nodes")
    rows = stored(prints.groupBy(own.alias("key")).agg(F.count("*").alias("n")), "rows")
    discard(prints)
    # Sets of fewer than similarity / (1 - similarity) shingles are similar only if they are equal.
    least = similarity / (1 - similarity) if similarity < 1 else math.inf
    large = nodes.where(F.col("size") >= least - SLACK)
    edges = near_pairs(docs, large, bits, m, shingle, similarity)
    roots = stored(connected_components(edges), "roots")
    missed = missed_pairs(docs, large, common, roots, shingle, similarity)
    if not missed.isEmpty():
        before, roots = roots, connected_components(edges.unionByName(missed))
        discard(before)
    rooted = nodes.join(roots, "node", "left").select("key", F.coalesce("root", "node").alias("root"))
    stay = stored(rooted.groupBy("root").agg(F.min("key").alias("key")).select("key"), "stay")
    kept = rows.join(stay.withColumn("stays", F.lit(True)), "key", "left")
    # Only rows that go, or stay once of several, are marked; texts needn't be shuffled while these are few.
    marks = stored(kept.where(F.col("stays").isNull() | (F.col("n") > 1)).select(F.col("key").alias("__key"), F.col("stays").isNotNull().alias("__once")), "marks")
    key = row_key(F.col("doc_id"), F.col("text"))
    as_found = F.struct(key["id"].isNull().alias("no_id"), F.coalesce(key["id"], F.lit(0)).cast("long").alias("id"), F.coalesce(key["h1"], F.lit(0)).alias("h1"), key["h2"].alias("h2"))
    marked = docs.withColumn("__key", as_found).join(bounded(marks), "__key", "left")
    once = marked.where("__once").dropDuplicates(["__key"])
    discard(common, rows, nodes, edges, missed, roots, stay)
    return marked.where("__once is null").unionByName(once).select(*docs.columns)
