"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The lexicon of toxic words and word beginnings is learned from labelled rows by smoothed log odds. A document's
features are densities of lexicon hits, how near hits stand to second-person words, capitals, punctuation and
obfuscation rates. All of them are computed over the whole text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import TEXT_ROWS, fold, stored

#: Second-person words of English, German, French and Spanish.
SECOND_PERSON = frozenset("you your yours yourself du dich dir dein deine deinen ihr euch sie ihnen tu toi te ton ta tes vous votre vos tú ti usted ustedes tuyo vosotros".split())
#: Signs that stand in for letters.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", ".": "", "-": "", "_": ""})
EDGES = ".,;:!?\"'()[]{}<>…«»“”"
#: Lengths of the word beginnings that the lexicon takes besides whole words.
STEMS = (4, 5, 6)
#: Words between a hit and a second-person word within which they count as near.
NEAR = 4
ODD = re.compile(r"[^\W\d_][\d@$!*_]+[^\W\d_]")
NAMES = ["hits", "max_weight", "mean_weight", "hit_rate", "stem_hits", "stem_rate", "stem_max", "near_you", "you_rate", "hidden_hits", "odd_rate", "capitals", "capital_words", "exclamation", "question", "punctuation", "digits", "letters", "log_words"]


def word_forms(text: str) -> list[str]:
    """Lower-case words without the signs around them."""
    return [w for x in text.lower().split() if (w := x.strip(EDGES))]


def features(text: str, words: dict[str, float], stems: dict[str, float]) -> list[float]:
    found = word_forms(text)
    n = max(1, len(found))
    at, weights, stem_weights, hidden, you = [], [], [], 0, []
    for i, w in enumerate(found):
        if (weight := words.get(w)) is not None:
            at.append(i)
            weights.append(weight)
        elif w in SECOND_PERSON:
            you.append(i)
        else:
            weight = stems.get(w[:5])
            if weight is None:
                weight = stems.get(w[:4])
            if weight is None:
                weight = stems.get(w[:6])
            if weight is not None:
                at.append(i)
                stem_weights.append(weight)
    odd = ODD.findall(text)
    if odd:
        for raw in text.lower().split():
            plain = raw.strip(".,;:?\"'()")
            if ODD.search(plain) and plain.strip(EDGES) not in words and plain.translate(LEET) in words:
                hidden += 1
    near = sum(1 for i in at if (k := bisect_left(you, i - NEAR)) < len(you) and you[k] <= i + NEAR)
    chars = max(1, len(text))
    capitals = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÉÈÄÖÜÑÓÍ"))
    signs = sum(map(text.count, ".,;:!?"))
    digits = sum(map(text.count, "0123456789"))
    loud, asks = text.count("!"), text.count("?")
    letters = chars - signs - digits - text.count(" ") - text.count("\n")
    shouted = len(re.findall(r"\b[A-ZÄÖÜÉ]{3,}\b", text)) if capitals > 0.02 * chars else 0
    return [
        float(len(weights)), max(weights, default=0.0), sum(weights) / n, len(weights) / n, float(len(stem_weights)), len(stem_weights) / n, max(stem_weights, default=0.0),
        float(near), len(you) / n, float(hidden), len(odd) / n, capitals / chars, shouted / n, loud / chars, asks / chars, signs / chars, digits / chars, letters / chars, float(np.log1p(len(found))),
    ]


Lexicon = tuple[dict[str, float], dict[str, float]]


def learn_lexicons(rows: DataFrame, parts: int, least_docs: int = 3, least_odds: float = 2.0, most: int = 4000) -> list[Lexicon]:
    """(words, stems) with their log odds: one lexicon without each part's rows, and last one from all rows.

    rows: text, toxic (0/1), part. A word counts once for each document. Stems are word beginnings. At most ``most``
    of either, the strongest first.
    """
    names = [f"n{y}_{k}" for k in range(parts) for y in (0, 1)]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[tuple[bool, str], list[int]] = {}
            for text, y, part in zip(batch["text"], batch["toxic"], batch["part"], strict=True):
                own = set(word_forms(text))
                # A word may end in a star itself, so what is a beginning is said apart.
                for entry in {(False, w) for w in own} | {(True, w[:k]) for w in own for k in STEMS if len(w) > k}:
                    seen.setdefault(entry, [0] * len(names))[2 * int(part) + int(y)] += 1
            yield pd.DataFrame([(*entry, *n) for entry, n in seen.items()], columns=["stem", "word", *names])

    totals = {(r["part"], r["toxic"]): r["count"] for r in rows.groupBy("part", "toxic").count().collect()}
    counted = rows.select("text", "toxic", "part").mapInPandas(count, ", ".join(["stem boolean", "word string", *(f"{n} long" for n in names)]))
    summed = counted.groupBy("stem", "word").agg(*(F.sum(n).alias(n) for n in names))
    summed = stored(summed.where(sum(F.col(f"n1_{k}") for k in range(parts)) >= least_docs), "words", TEXT_ROWS)
    out = []
    for without in [*range(parts), -1]:
        kept = [k for k in range(parts) if k != without]
        n0, n1 = (sum(totals.get((k, y), 0) for k in kept) for y in (0, 1))
        c0, c1 = (sum((F.col(f"n{y}_{k}") for k in kept), F.lit(0)) for y in (0, 1))
        odds = F.log((c1 + 0.5) / F.lit(n1 + 1.0)) - F.log((c0 + 0.5) / F.lit(n0 + 1.0))
        strong = summed.where(c1 >= least_docs).select("stem", "word", odds.alias("odds")).where(F.col("odds") >= least_odds)
        words, stems = ({r["word"]: r["odds"] for r in strong.where(kind).orderBy(F.desc("odds"), "word").limit(most).collect()} for kind in (~F.col("stem"), F.col("stem")))
        out.append((words, stems))
    return out


def featured(docs: DataFrame, lexicons: list[Lexicon], part: str | None = None) -> DataFrame:
    """docs with the column features (vector), by the lexicon whose number is in column part (the only one if None)."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series, parts: pd.Series) -> pd.Series:
        return pd.Series([features(t, *shared.value[k]) for t, k in zip(texts, parts, strict=True)])

    return docs.withColumn("features", array_to_vector(of("text", F.col(part) if part else F.lit(0))))


class ToxicityModel:
    """A lexicon, boosted trees and an isotonic calibration of their margin."""

    def __init__(self, lexicon: Lexicon, trees: GBTClassificationModel | None, isotonic: IsotonicRegressionModel | None, rate: float):
        self.lexicon, self.trees, self.isotonic, self.rate = lexicon, trees, isotonic, rate

    def score(self, docs: DataFrame) -> DataFrame:
        """docs with score in [0, 1] instead of text."""
        if self.trees is None:
            return docs.drop("text").withColumn("score", F.lit(float(self.rate)))
        made = self.trees.transform(featured(docs, [self.lexicon]).drop("text")).withColumn("margin", vector_to_array("rawPrediction")[1])
        if self.isotonic is None:
            return made.withColumn("score", 1 / (1 + F.exp(-2 * F.col("margin")))).drop(*OWN)
        level = self.isotonic.transform(made).withColumn("score", F.least(F.greatest(F.col("calibrated"), F.lit(0.0)), F.lit(1.0)))
        # Isotonic levels are flat; a hundredth of the margin's own scale keeps the order within a level.
        return level.withColumn("score", 0.99 * F.col("score") + 0.01 / (1 + F.exp(-2 * F.col("margin")))).drop(*OWN)


OWN = ("features", "rawPrediction", "probability", "prediction", "margin", "calibrated")


def fit(labelled: DataFrame, sample: int = 8000, rounds: int = 16, depth: int = 3, parts: int = 3) -> ToxicityModel:
    """labelled: doc_id, text (no nulls), toxic. Learns from about ``sample`` rows, chosen by hash of the id.

    Each part of the sample is seen with a lexicon of the other parts' rows, as its own would look too easy. Four
    fifths grow the trees, the rest calibrates them.
    """
    share = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_003))
    taken = labelled.where("toxic is not null").where(share < 1_000_003 * min(1.0, sample / max(1, labelled.count())))
    mixed = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(5 * parts)).cast("int")
    taken = stored(taken.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"), (mixed % parts).alias("part"), (mixed < parts).alias("calibrates")).repartition(8, "doc_id"), "labelled")
    rate = taken.agg(F.coalesce(F.avg("toxic"), F.lit(0.0))).first()[0]
    lexicons = learn_lexicons(taken, parts)
    model = ToxicityModel(lexicons[-1], None, None, rate)
    seen = stored(featured(taken, lexicons, "part").select("features", F.col("toxic").cast("double").alias("toxic"), "calibrates"), "features", TEXT_ROWS)
    grows, rest = seen.where(~F.col("calibrates")), seen.where("calibrates")
    if grows.select("toxic").distinct().count() < 2:
        return model
    model.trees = GBTClassifier(featuresCol="features", labelCol="toxic", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=7, maxBins=32).fit(grows)
    margins = model.trees.transform(rest).select("toxic", vector_to_array("rawPrediction")[1].alias("margin"))
    if not margins.isEmpty():
        model.isotonic = IsotonicRegression(featuresCol="margin", labelCol="toxic", predictionCol="calibrated").fit(margins)
    return model


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 5, sample: int = 8000) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs, learned from labels of rows outside the held-out fold.

    Null and empty texts score as a text without words. If a label comes in several rows, the greatest counts.
    Repeated rows score alike. Without labels of both kinds every score is the share of label 1.
    Columns of docs and labels besides those named are ignored, whatever their names. An empty table gives no rows.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (fold(F.col("doc_id"), folds) == 0).alias("held_out"))
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(fold(F.col("doc_id"), folds) != 0)
    # Labels are thinned before the join, so few texts travel.
    n = marks.count()
    share = F.pmod(F.xxhash64("doc_id", F.lit("rows")), F.lit(1_000_003))
    few = marks.where(share < 1_000_003 * min(1.0, 1.2 * sample / max(1, n)))
    labelled = own.join(F.broadcast(few), "doc_id").dropDuplicates(["doc_id"])
    model = fit(labelled, sample)
    return stored(model.score(own).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")), "scores", TEXT_ROWS)
