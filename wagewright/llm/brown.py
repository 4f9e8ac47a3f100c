"""Class-based bigram language model with exchange clustering.

A token's probability is that of its class after the class before it, times that of the word within its class. The
``clustered`` commonest words are assigned to classes by exchange clustering on their bigram counts: the very commonest
one after the other, then all of them in batches, which Spark's tasks judge side by side against the same class
bigrams. Every other word belongs to a class by the end of its spelling, so a word never seen has a class too; a
clustered word may end up in such a class as well. Counts are taken over all training rows.

Bigrams stay in Spark, a row for each clustered word with its neighbours, of which there are at most as many as symbols.
Only tables bounded by parameters reach the driver: class bigrams, the bigrams among the ``seeds`` commonest words, and
the counts of the ``head`` commonest words, which scoring looks up in place. Rarer words find their counts by a join.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import ASCII_LOWER, ASCII_UPPER, LOWER_BYTES, TEXT_ROWS, discard, fold, stored

#: Additive smoothing of word counts.
ALPHA = 0.1
#: Weight of the class unigram in a class transition, in tokens.
BACK_OFF = 20.0


def end_class(word: bytes, classes: int) -> int:
    """Class of a word outside the clustering: by its last four bytes."""
    return zlib.crc32(word[-4:]) % classes


def end_class_column(word: Column, classes: int) -> Column:
    data = word.cast("binary")
    return (F.crc32(F.substring(data, -4, 4)) % classes).cast("int")


def words_column(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), ASCII_UPPER, ASCII_LOWER)
    return F.array_remove(F.split(lowered, r"[\x20\x09-\x0D]+"), "")


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(LOWER_BYTES).split()


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def gains(joint: np.ndarray, right: np.ndarray, left: np.ndarray, own: float) -> np.ndarray:
    """What adding a word to each class changes in the likelihood of class bigrams.

    joint: class bigrams without the word; right and left: how often it stands before and after each class; own: how
    often it follows itself. Only the neighbours' classes change cells, besides the corner and the marginals.
    """
    r, l = np.flatnonzero(right), np.flatnonzero(left)  # noqa: E741
    gain = (xlogx(joint[:, r] + right[r]) - xlogx(joint[:, r])).sum(1) + (xlogx(joint[l] + left[l, None]) - xlogx(joint[l])).sum(0)
    corner = joint.diagonal()
    gain += xlogx(corner + right + left + own) - xlogx(corner + right) - xlogx(corner + left) + xlogx(corner)
    before, after = joint.sum(1) + left, joint.sum(0) + right  # these marginals hold the word wherever it goes
    return gain - (xlogx(before + right.sum() + own) - xlogx(before) + xlogx(after + left.sum() + own) - xlogx(after))


def without(joint: np.ndarray, a: int, right: np.ndarray, left: np.ndarray, own: float) -> np.ndarray:
    """joint less a word of class a, whose right and left don't count itself."""
    out = joint.copy()
    out[a] -= right
    out[:, a] -= left
    out[a, a] -= own
    return out


def likelihood(joint: np.ndarray) -> float:
    """The part of the likelihood that depends on the classes."""
    return float(xlogx(joint).sum() - xlogx(joint.sum(1)).sum() - xlogx(joint.sum(0)).sum())


def exchange(bigrams: np.ndarray, start: np.ndarray, classes: int, movable: int, rounds: int = 5) -> np.ndarray:
    """Class of each symbol after exchange clustering.

    bigrams[v, w]: how often w follows v. The first ``movable`` symbols move, one after the other, to the class
    that gives the greatest likelihood of the class bigrams, until a round moves none; the others keep their class.
    """
    of = start.copy()
    member = np.zeros((len(of), classes))
    member[np.arange(len(of)), of] = 1
    joint = member.T @ bigrams @ member
    for _ in range(rounds):
        moved = 0
        for w in range(movable):
            a = of[w]
            right, left, own = bigrams[w] @ member, bigrams[:, w] @ member, bigrams[w, w]
            if not right.any() and not left.any():
                continue
            right[a] -= own
            left[a] -= own
            joint = without(joint, a, right, left, own)
            gain = gains(joint, right, left, own)
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            joint[b] += right
            joint[:, b] += left
            joint[b, b] += own
            if b != a:
                member[w, a], member[w, b], of[w] = 0, 1, b
                moved += 1
        if not moved:
            break
    return of


def neighbours(pairs: DataFrame, symbols: int) -> DataFrame:
    """pairs: v, w (symbol numbers), n; a pair may come in several rows. A row for each symbol: s, and as o the symbols
    after it and, with ``symbols`` added, those before it, with their counts n.

    Rows are dealt by symbol once, for the sums as for the lists; a list has at most twice as many entries as symbols.
    """
    both = pairs.select(F.explode(F.array(F.struct(F.col("v").alias("s"), F.col("w").alias("o"), "n"), F.struct(F.col("w").alias("s"), (F.col("v") + symbols).alias("o"), "n"))).alias("e")).select("e.*")
    dealt = both.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "s")
    found = dealt.groupBy("s", "o").agg(F.sum("n").alias("n")).groupBy("s").agg(F.collect_list(F.struct("o", "n")).alias("e"))
    return found.select("s", F.col("e.o").alias("o"), F.col("e.n").alias("n"))


def by_class(frame: pd.DataFrame, of: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each row's symbol stands before and after each class; the class of symbol i is of[i]."""
    sizes = frame["o"].map(len).to_numpy()
    if not len(sizes):
        return np.zeros((0, classes)), np.zeros((0, classes))
    ids, n = np.concatenate(frame["o"].to_list()).astype(np.int64), np.concatenate(frame["n"].to_list())
    before = ids >= len(of)
    at = np.repeat(np.arange(len(sizes)), sizes) * 2 * classes + before * classes + of[ids - before * len(of)]
    both = np.bincount(at, n, minlength=len(sizes) * 2 * classes).reshape(len(sizes), 2, classes)
    return both[:, 0], both[:, 1]


def class_bigrams(rows: DataFrame, of: np.ndarray, classes: int) -> np.ndarray:
    """How often each class follows each; rows as of neighbours()."""
    shared = rows.sparkSession.sparkContext.broadcast(of)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        joint = np.zeros((classes, classes))
        for batch in batches:
            np.add.at(joint, shared.value[batch["s"].to_numpy()], by_class(batch, shared.value, classes)[0])
        cells = np.flatnonzero(joint)
        yield pd.DataFrame({"cell": cells, "n": joint.ravel()[cells].astype(np.int64)})

    joint = np.zeros(classes * classes)
    for r in rows.mapInPandas(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # at most classes squared
        joint[r["cell"]] = r["n"]
    return joint.reshape(classes, classes)


def exchange_in_batches(rows: DataFrame, start: np.ndarray, classes: int, movable: int, rounds: int = 3, batches: int = 2) -> np.ndarray:
    """Class of each symbol after more exchange, of whole batches of the movable symbols at a time.

    Within a batch every word is judged against the class bigrams before it. A batch that worsens the likelihood, as
    words that moved at once can, is taken back. It ends with a round that moves none.
    """
    of, joint = start.copy(), class_bigrams(rows, start, classes)
    for _ in range(rounds):
        moved = 0
        for batch in range(batches):
            shared = rows.sparkSession.sparkContext.broadcast((of, joint))

            def judge(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
                of, joint = shared.value
                for frame in frames:
                    best = []
                    for s, right, left, others, n in zip(frame["s"].to_numpy(), *by_class(frame, of, classes), frame["o"], frame["n"], strict=True):
                        a = of[s]
                        own = float(n[others == s].sum())
                        right[a] -= own
                        left[a] -= own
                        gain = gains(without(joint, a, right, left, own), right, left, own)[:-1]  # the last class is the end's
                        b = int(gain.argmax())
                        best.append(b if gain[b] > gain[a] + 1e-9 else a)
                    yield pd.DataFrame({"s": frame["s"].to_numpy(), "b": np.array(best, dtype=np.int64)})

            mine = rows.where((F.col("s") < movable) & (F.col("s") % batches == batch))
            found = mine.mapInPandas(judge, "s int, b int").toPandas()  # at most a row for each movable symbol
            trial = of.copy()
            trial[found["s"].to_numpy()] = found["b"].to_numpy()
            changed = int((trial != of).sum())
            after = class_bigrams(rows, trial, classes) if changed else joint
            if changed and likelihood(after) > likelihood(joint):
                of, joint, moved = trial, after, moved + changed
        if not moved:
            break
    return of


@dataclass
class Model:
    """What scoring needs in place; see fit()."""

    tokens: int = 0
    types: int = 0
    clustered: int = 0
    end_classes: int = 0
    words: list[bytes] = field(default_factory=list)
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0))
    of: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    emission: np.ndarray = field(default_factory=lambda: np.zeros(0))
    transition: np.ndarray = field(default_factory=lambda: np.zeros((1, 1)))
    class_tokens: np.ndarray = field(default_factory=lambda: np.zeros(0))
    class_types: np.ndarray = field(default_factory=lambda: np.zeros(0))
    ends: int = 0

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ALPHA) / (self.tokens + ALPHA * (self.types + 1)))


def commonest(counts: DataFrame, most: int) -> DataFrame:
    """The ``most`` words of the greatest counts; of equal counts the first by spelling.

    The cut comes from a table of how many words have each count, so only words of the count at the cut are put in order.
    """
    tally = counts.groupBy("c").count().orderBy(F.desc("c")).limit(most + 1).collect()
    taken = 0
    for r in tally:
        if taken + r["count"] > most:
            tied = counts.where(F.col("c") == r["c"]).orderBy("word").limit(most - taken)
            return counts.where(F.col("c") > r["c"]).unionByName(tied)
        taken += r["count"]
    return counts


def fit(train: DataFrame, clustered: int = 20_000, classes: int = 48, end_classes: int = 64, head: int = 100_000, seeds: int = 1000) -> tuple[Model, DataFrame]:
    """The model, and the counts of all training words (word, c).

    ``clustered``: words that exchange clustering assigns; ``seeds``: those of them that it assigns one after the other
    first; ``head``: words whose counts scoring holds in memory.
    """
    spark = train.sparkSession
    words = train.select(F.explode(words_column(F.col("text"))).alias("word"))
    counts = stored(words.groupBy("word").agg(F.count("*").alias("c")), "counts")
    ends = train.count()
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = commonest(counts, head).toPandas().sort_values(["c", "word"], ascending=[False, True])
    names, word_counts = [w.encode() for w in top["word"]], top["c"].to_numpy(dtype=float)
    del top
    n_clustered = min(clustered, len(names))
    # Symbols of the bigram counts: clustered words, then the classes by spelling, then the end.
    symbols = n_clustered + end_classes + 1
    shared = spark.sparkContext.broadcast(names[:n_clustered])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, by_end = {w: i for i, w in enumerate(shared.value)}, {}
        held, size = [], 0

        def symbol(word: bytes) -> int:
            tail = word[-4:]
            if tail not in by_end:
                by_end[tail] = n_clustered + end_class(word, end_classes)
            return by_end[tail]

        def counted() -> pd.DataFrame:
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            return pd.DataFrame({"v": pairs // symbols, "w": pairs % symbols, "n": n})

        for batch in batches:
            for text in batch["text"]:
                found = words_of(text)
                at = np.fromiter((i if (i := ids.get(w)) is not None else symbol(w) for w in found), np.int64, len(found))
                held.append(np.append(symbols - 1, at) * symbols + np.append(at, symbols - 1))
                size += len(held[-1])
                if size > 4_000_000:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    texts = train.select(F.coalesce("text", F.lit("")).alias("text"))
    rows = stored(neighbours(texts.mapInPandas(count, "v int, w int, n long"), symbols), "neighbours", TEXT_ROWS)

    n_classes = classes + end_classes + 1
    of = np.array([classes + end_class(w, end_classes) for w in names[:n_clustered]] + list(range(classes, n_classes)), dtype=np.int64)
    n_seeds = min(seeds, n_clustered)
    # Bigrams among the seeds and classes; all other words stand for their classes by spelling.
    small = n_seeds + end_classes + 1
    to_small = np.concatenate([np.arange(n_seeds), of[n_seeds:] - classes + n_seeds])
    bigrams = class_bigrams(rows, to_small, small) if n_seeds else np.zeros((small, small))
    start = np.concatenate([np.arange(n_seeds) % classes, classes + np.arange(end_classes + 1)]).astype(np.int64)
    of[:n_seeds] = exchange(bigrams, start, n_classes, n_seeds)[:n_seeds]
    of = exchange_in_batches(rows, of, n_classes, n_clustered)
    joint = class_bigrams(rows, of, n_classes)
    discard(rows)

    # Words and tokens of the classes by spelling, over all words outside the clustering.
    known = F.broadcast(spark.createDataFrame([(w.decode(),) for w in names[:n_clustered]], "word string"))
    rest = counts.join(known, "word", "left_anti")
    outside = {r["k"]: (r["n"], r["v"]) for r in rest.groupBy(end_class_column(F.col("word"), end_classes).alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    class_tokens, class_types = np.bincount(of[:n_clustered], word_counts[:n_clustered], minlength=n_classes), np.bincount(of[:n_clustered], minlength=n_classes).astype(float)
    for k, (n, v) in outside.items():
        class_tokens[classes + k] += n
        class_types[classes + k] += v
    class_tokens[-1], class_types[-1] = ends, 1

    share = (joint.sum(0) + 1) / (joint.sum() + n_classes)
    transition = np.log10((joint + BACK_OFF * share) / (joint.sum(1, keepdims=True) + BACK_OFF))
    own = np.array([of[i] if i < n_clustered else classes + end_class(w, end_classes) for i, w in enumerate(names)], dtype=np.int64)
    # A class by spelling leaves room for an unseen word; another has none.
    emission = np.log10((word_counts + ALPHA) / (class_tokens[own] + ALPHA * (class_types[own] + (own >= classes)))) if len(names) else np.zeros(0)
    return Model(total["n"] + ends, total["v"] + (ends > 0), n_clustered, end_classes, names, word_counts, own, emission, transition, class_tokens, class_types, ends), counts


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """docs' doc_id and held_out with n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    n_classes = len(model.class_tokens)
    first = n_classes - 1 - model.end_classes
    shared = spark.sparkContext.broadcast(model)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        ids = {w: i for i, w in enumerate(m.words)}
        base, none, by_end = m.base(m.counts), len(m.words), {}
        of, emission = np.append(m.of, 0), np.append(m.emission, 0.0)
        known = np.append(base, 0.0)
        end_base = float(m.base(np.array([m.ends]))[0])
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found = words_of(text)
                at = np.fromiter((ids.get(w, none) for w in found), np.int64, len(found))
                classes = of[at]
                tail: dict[bytes, int] = {}
                for i in np.flatnonzero(at == none).tolist():
                    word = found[i]
                    ending = word[-4:]
                    if ending not in by_end:
                        by_end[ending] = first + end_class(word, m.end_classes)
                    classes[i] = by_end[ending]
                    tail[word] = tail.get(word, 0) + 1
                way = m.transition[np.concatenate([[n_classes - 1], classes]), np.concatenate([classes, [n_classes - 1]])].sum()
                n_head = len(found) - sum(tail.values())
                rows.append((len(found) + 1, n_head + (m.ends > 0), known[at].sum() + end_base, way + emission[at].sum(), list(tail), list(tail.values())))
            out = pd.DataFrame(rows, columns=["n_tokens", "n_known", "base_score", "score", "tail", "times"])
            yield out.assign(id=batch["id"].to_numpy(), has_id=batch["has_id"].to_numpy(), held_out=batch["held_out"].to_numpy())

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("doc_id").isNotNull().alias("has_id"), "held_out", F.coalesce("text", F.lit("")).alias("text"))
    kinds = "n_tokens long, n_known long, base_score double, score double, tail array<binary>, times array<int>, id long, has_id boolean, held_out boolean"
    near = stored(rows.mapInPandas(add, kinds).withColumn("uid", F.monotonically_increasing_id()), "scored", TEXT_ROWS)

    # Rarer words: their counts come by a join.
    tail = near.select("uid", F.explode(F.arrays_zip("tail", "times")).alias("e")).select("uid", F.col("e.tail").cast("string").alias("word"), F.col("e.times").alias("times"))
    classes = spark.createDataFrame([(k, float(model.class_tokens[first + k]), float(model.class_types[first + k])) for k in range(model.end_classes)], "k int, n double, v double")
    c = F.coalesce(F.col("c"), F.lit(0))
    looked = tail.join(counts, "word", "left").withColumn("k", end_class_column(F.col("word"), model.end_classes)).join(F.broadcast(classes), "k")
    added = looked.groupBy("uid").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((c + ALPHA) / F.lit(model.tokens + ALPHA * (model.types + 1)))).alias("more_base"),
        F.sum(F.col("times") * F.log10((c + ALPHA) / (F.col("n") + ALPHA * (F.col("v") + 1)))).alias("more_score"),
    )
    out = near.drop("tail", "times").join(added, "uid", "left")
    return out.select(
        F.when(F.col("has_id"), F.col("id")).alias("doc_id"),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def score_documents(docs: DataFrame, folds: int = 10, clustered: int = 20_000, classes: int = 48, end_classes: int = 64, head: int = 100_000, seeds: int = 1000) -> DataFrame:
    """Log10 probability of every document under a model of those whose crc32(doc_id) mod folds isn't 0.

    A null text is empty and scores its end alone. Repeated rows count and score as often as they come. Without
    training rows every token is unknown. Other columns of docs are ignored, whatever their names. An empty table gives no
    rows.
    """
    own = docs.select("doc_id", "text", (fold(F.col("doc_id"), folds) == 0).alias("held_out"))
    model, counts = fit(own.where(~F.col("held_out")), clustered, classes, end_classes, head, seeds)
    return score(own, model, counts)


def perplexity(log10_probability: float, tokens: int) -> float:
    return math.pow(10.0, -log10_probability / tokens)
