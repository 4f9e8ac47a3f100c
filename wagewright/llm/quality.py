"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of a fixed number of words, over its whole text. Every passage is encoded from dense
surface features; gated attention, learned from document labels alone, weighs the passages, and the weighted passage
representation is scored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import TEXT_ROWS, bounded, fold, row_key, stored

PASSAGE_WORDS = 64
#: Signs counted together, as fixed values; what no group names is counted by byte range.
GROUPS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"!?", b".,;:", b"#$%&*+=@^~<>", b"|{}[]\\/_()", b"\"'`-"]
N_GROUPS = len(GROUPS) + 2  # and bytes from 0x80 on, and all others
_GROUP_OF = np.full(256, N_GROUPS - 1, dtype=np.int64)
for _i, _group in enumerate(GROUPS):
    _GROUP_OF[list(_group)] = _i
_GROUP_OF[128:] = N_GROUPS - 2
N_FEATURES = N_GROUPS + 11


def passages(text: str, size: int = PASSAGE_WORDS) -> np.ndarray:
    """One row of features for each passage; a text without words is one passage of zeros."""
    words = text.encode().split()
    if not words:
        return np.zeros((1, N_FEATURES), dtype=np.float32)
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    starts = np.arange(0, n, size)
    counts = np.diff(np.append(starts, n))
    count = len(starts)
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    chars = np.add.reduceat(lengths, starts)
    groups = np.bincount(np.repeat(np.arange(count) * N_GROUPS, chars) + _GROUP_OF[data], minlength=count * N_GROUPS).reshape(count, N_GROUPS)
    ids_of: dict[bytes, int] = {}
    ids = np.fromiter((ids_of.setdefault(w, len(ids_of)) for w in words), np.int64, n)
    passage = np.repeat(np.arange(count), counts)
    _, often = np.unique(passage * n + ids, return_counts=True)
    own = np.unique(passage * n + ids) // n
    distinct = np.bincount(own, minlength=count)
    most = np.zeros(count)
    np.maximum.at(most, own, often)
    again = np.add.reduceat(np.append(False, ids[1:] == ids[:-1]).astype(float), starts)
    skipped = np.add.reduceat(np.append([False, False], ids[2:] == ids[:-2]).astype(float)[:n], starts)
    mean = chars / counts
    spread = np.sqrt(np.maximum(np.add.reduceat(lengths.astype(float) ** 2, starts) / counts - mean**2, 0))
    lines = [x for x in text.split("\n") if x.strip()]
    whole = np.array([len(ids_of) / n, np.log1p(n) / 10, len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))) / 5])
    out = np.column_stack([
        groups / chars[:, None], distinct / counts, most / counts, again / counts, skipped / counts, mean / 10, spread / 10, counts / size,
        np.broadcast_to(whole, (count, len(whole))),
    ])
    return out.astype(np.float32)


class AttentionModel:
    """Passage encoder, gated attention and scorer; parameters are small arrays."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, hidden: int = 16, gate: int = 8, seed: int = 7):
        rng, d = np.random.default_rng(seed), len(mean)
        self.mean, self.scale = mean, scale
        self.p = {
            "encode": rng.normal(0, 1 / np.sqrt(d), (d, hidden)), "shift": np.zeros(hidden),
            "v": rng.normal(0, 0.3, (hidden, gate)), "u": rng.normal(0, 0.3, (hidden, gate)), "w": rng.normal(0, 0.3, gate),
            "beta": rng.normal(0, 0.3, hidden), "bias": np.zeros(1),
        }

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        h = np.tanh(x @ p["encode"] + p["shift"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * g) @ p["w"]
        bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        a = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a /= np.add.reduceat(a, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"h": h, "t": t, "g": g, "a": a, "bag": bag, "z": z, "score": 1 / (1 + np.exp(-np.clip(z @ p["beta"] + p["bias"], -30, 30)))}

    def prepared(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -4, 4)

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        starts = np.cumsum([0, *map(len, bags[:-1])])
        return self.forward(self.prepared(np.concatenate(bags).astype(float)), starts)["score"]

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, steps: int = 250, rate: float = 0.02, decay: float = 1e-4) -> None:
        """Adam over the whole sample."""
        x, starts, y = self.prepared(np.concatenate(bags).astype(float)), np.cumsum([0, *map(len, bags[:-1])]), labels.astype(float)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            f, p = self.forward(x, starts), self.p
            h, t, g, a, bag = (f[k] for k in ("h", "t", "g", "a", "bag"))
            ds = (f["score"] - y) / len(y)
            dz = ds[:, None] * p["beta"]
            da = (h * dz[bag]).sum(1)
            de = a * (da - np.add.reduceat(a * da, starts)[bag])
            dt, dg = de[:, None] * p["w"] * g * (1 - t**2), de[:, None] * p["w"] * t * g * (1 - g)
            dh = (a[:, None] * dz[bag] + dt @ p["v"].T + dg @ p["u"].T) * (1 - h**2)
            grads = {"encode": x.T @ dh, "shift": dh.sum(0), "v": h.T @ dt, "u": h.T @ dg, "w": ((t * g) * de[:, None]).sum(0), "beta": f["z"].T @ ds, "bias": np.array([ds.sum()])}
            for k, grad in grads.items():
                grad = grad + decay * p[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                p[k] = p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)


def fit(labelled: DataFrame, sample: int = 4000, most_passages: int = 256) -> AttentionModel | float:
    """labelled: doc_id, text (no nulls), quality. A model, or the share of label 1 where only one kind occurs.

    Learns from about ``sample`` rows, chosen by hash of the id, of at most ``most_passages`` passages each: longer
    ones don't train. These two bound what it gathers. Every passage of what it learns from is seen whole.
    """

    @F.pandas_udf("binary")
    def encoded(texts: pd.Series) -> pd.Series:
        return pd.Series([passages(t).tobytes() for t in texts])

    # Else the condition on the bag would move down with a copy of the function: two Python workers a task, for rows without a label too.
    once = encoded.asNondeterministic()
    made = labelled.select("doc_id", F.col("quality").cast("int").alias("quality"), once("text").alias("bag"))
    most_bytes = most_passages * N_FEATURES * np.dtype(np.float32).itemsize
    short = stored(made.where(F.length("bag") <= most_bytes), "bags", TEXT_ROWS)
    rows = short.orderBy(F.xxhash64("doc_id")).select("quality", "bag").limit(sample).toPandas()
    bags, y = [np.frombuffer(b, dtype=np.float32).reshape(-1, N_FEATURES) for b in rows["bag"]], rows["quality"].to_numpy()
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    x = np.concatenate(bags)
    model = AttentionModel(x.mean(0), np.maximum(x.std(0), 1e-3))
    model.fit(bags, y)
    return model


def score_column(docs: DataFrame, model: AttentionModel | float) -> Column:
    """The score of docs' text in [0, 1]; a null text counts as empty."""
    if isinstance(model, float):
        return F.lit(model)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        out = []
        for k in range(0, len(texts), 256):
            out.append(shared.value.scores([passages(t) for t in texts.iloc[k : k + 256]]))
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return of(F.coalesce(F.col("text"), F.lit("")))


def train_rows(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, sample: int = 4000) -> DataFrame:
    """doc_id, text, quality of about 1.3 times ``sample`` labelled rows outside the held-out fold (labels are thinned by hash of the id)."""
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")).where(fold(F.col("doc_id"), folds) != held_out)
    marks = stored(marks, "labels")
    share = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1_000_003))
    few = marks.where(share < 1_000_003 * min(1.0, 1.3 * sample / max(1, marks.count())))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(few), "doc_id")


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, sample: int = 4000) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs, learned from labels of rows outside the held-out fold.

    Null and empty texts are one passage without words. If a label comes in several rows, the greatest counts.
    Repeated rows score alike. Without labels of both kinds every score is the share of label 1 (0.5 without labels).
    Columns of docs and labels besides those named are ignored, whatever their names. An empty table gives no rows.
    """
    model = fit(train_rows(docs, labels, folds, held_out, sample), sample)
    scored = docs.select("doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), score_column(docs, model).alias("score"))
    return stored(scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted")), "scores", TEXT_ROWS)


def keep_good(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, sample: int = 4000, threshold: float = 0.7) -> DataFrame:
    """The rows of docs whose score reaches the threshold, with docs' own columns, whatever their names.

    Null and empty texts are judged as one passage without words. Repeated rows stay or go together. Of a label in
    several rows the greatest counts; without labels of both kinds all rows stay or all go, by the share of label 1.
    An empty table stays empty.
    """
    model = fit(train_rows(docs, labels, folds, held_out, sample), sample)
    key = row_key(F.col("doc_id"), F.col("text"))
    scored = stored(docs.select(key.alias("__key"), score_column(docs, model).alias("score")), "scored", TEXT_ROWS)
    rejected = stored(scored.where(F.col("score") < threshold).select("__key").distinct(), "rejected")
    return docs.withColumn("__key", key).join(bounded(rejected), "__key", "left_anti").select(*docs.columns)
