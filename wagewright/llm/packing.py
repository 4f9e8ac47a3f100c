"""Best-fit packing by bin completion.

Documents become pieces of at most ``capacity`` tokens. Only the histogram of piece lengths (at most ``capacity``
rows) goes to the driver, where a branch and bound over whole bins makes a plan: how often each filling is used.
Pieces of one length are exchangeable, so each piece finds its bin from its length and its rank among the pieces of
that length, and no task ever holds more than a share of them.
"""

from __future__ import annotations

import contextlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagewright.llm.common import TEXT_ROWS, stored

#: Chunks that a worker keeps with their token ids, twice: a full table becomes the old one, from which entries in use
#: are taken over.
CACHE_ENTRIES = 300_000
#: Chunks that are one word to the tokenizer, and change only their case when normalised.
WORD = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: A full stop or comma beside another sign (or a letter that becomes a letter and a sign); together they may be one token.
BESIDE = re.compile(r"[.,](?:[^\w \n\t\r]|_)|(?:[^\w \n\t\r]|[_İ])[.,]")
#: Parts into which the pieces of one length are ranked.
RANK_PARTS = 256


class ChunkTokenizer:
    """Token ids (as little-endian unsigned 32-bit bytes) of whole texts.

    A tokenizer that drops white space and lower-cases gives a text the ids of its chunks between blanks and line
    ends, whatever their case, and a full stop or comma between letters, digits and white space is a token of its own.
    So each worker encodes a chunk once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    @staticmethod
    def chunks(text: str) -> list[str]:
        if not BESIDE.search(text):
            text = text.replace(".", " .").replace(",", " ,")
        with contextlib.suppress(UnicodeEncodeError):
            text.encode("latin-1")
            text = text.lower()
        return text.replace("\n", " ").split(" ")

    def _learn(self, new: list[str]) -> None:
        known, old = self.known, self.old
        words, others = [], []
        for chunk in new:
            if (ids := old.get(chunk)) is not None:
                known[chunk] = ids
            else:
                (words if WORD.fullmatch(chunk) else others).append(chunk)
        for k in range(0, len(words), 512):  # many words to a call; each ends in a token that ends a word
            part = words[k : k + 512]
            ids = np.asarray(self.encode([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(ends) != len(part):
                others += part
                continue
            at, ids = 0, ids.tobytes()
            for word, end in zip(part, ends, strict=True):
                known[word] = ids[at:end]
                at = end
        for k in range(0, len(others), 512):
            part = others[k : k + 512]
            for chunk, found in zip(part, self.encode(part, add_special_tokens=False), strict=True):
                known[chunk] = np.asarray(found.ids, dtype="<u4").tobytes()

    def texts(self, texts: list[str], together: int = 256) -> Iterator[bytes]:
        for k in range(0, len(texts), together):
            part = [self.chunks(text) for text in texts[k : k + together]]
            if len(self.known) > CACHE_ENTRIES:
                self.old, self.known = self.known, {"": b""}
            known = self.known
            self._learn([chunk for chunk in set().union(*part) if chunk not in known])
            for chunks in part:
                yield b"".join(map(known.__getitem__, chunks))


_tokenizers: dict[str, ChunkTokenizer] = {}


def _tokenizer(path: str) -> ChunkTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = ChunkTokenizer(path)
    return _tokenizers[path]


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for each piece of each document.

    A document's ids are those of its whole text (null: empty) and then ``end_id``. Only a document of more than
    ``capacity`` ids is cut. Repeated rows are packed as often as they come; null ids stay null.
    """
    end, step = np.asarray([end_id], dtype="<u4").tobytes(), 4 * capacity

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = _tokenizer(tokenizer_path)
        for batch in batches:
            rows = []
            for doc_id, has_id, ids in zip(batch["id"].tolist(), batch["has_id"].tolist(), tokenizer.texts(batch["text"].tolist()), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), step)):
                    own = ids[at : at + step]
                    rows.append((doc_id, has_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            yield pd.DataFrame(rows, columns=["id", "has_id", "piece", "start", "length", "ids_crc32"])

    # pandas has no null in a column of longs, so ids travel with a flag.
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("doc_id").isNotNull().alias("has_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cuts = rows.mapInPandas(cut, "id long, has_id boolean, piece int, start long, length long, ids_crc32 long")
    return cuts.select(F.when(F.col("has_id"), F.col("id")).alias("doc_id"), "piece", "start", "length", "ids_crc32")


class _Stock:
    """Lengths still to be packed, with their counts."""

    def __init__(self, counts: dict[int, int]):
        self.counts = dict(counts)
        self.lengths = sorted(self.counts)

    def take(self, filling: tuple[int, ...], times: int) -> None:
        for x in filling:
            self.counts[x] -= times
        for x in set(filling):
            if not self.counts[x]:
                del self.counts[x]
                del self.lengths[bisect_right(self.lengths, x) - 1]

    def largest_within(self, room: int, used: dict[int, int]) -> int:
        """The largest length of at most ``room`` that is left besides ``used``; 0 if there is none."""
        at = bisect_right(self.lengths, room) - 1
        while at >= 0 and used.get(self.lengths[at], 0) >= self.counts[self.lengths[at]]:
            at -= 1
        return self.lengths[at] if at >= 0 else 0


def best_fit(stock: _Stock, largest: int, capacity: int) -> tuple[int, ...]:
    """The filling of ``largest`` and then the largest that fits, again and again, one step for each length."""
    filling, used, room = [largest], {largest: 1}, capacity - largest
    while x := stock.largest_within(room, used):
        n = min(room // x, stock.counts[x] - used.get(x, 0))
        filling += [x] * n
        used[x] = used.get(x, 0) + n
        room -= n * x
    return tuple(filling)


def completions(stock: _Stock, largest: int, capacity: int, wanted: int = 4, nodes: int = 400) -> list[tuple[int, ...]]:
    """The best undominated fillings around ``largest``, least waste first.

    The incumbent is the best-fit filling, which is there before the search: its budget of nodes only cuts
    alternatives. The search adds lengths in descending order. A filling is dominated, and left out, if one of its
    lengths could be swapped for a larger one that is left and fits; a branch ends where a single length fills the room
    exactly, and where it can't waste less than the fillings already kept.
    """
    incumbent = best_fit(stock, largest, capacity)
    best: dict[tuple[int, ...], int] = {incumbent: capacity - sum(incumbent)}
    left = [nodes]

    def dominated(filling: tuple[int, ...], used: dict[int, int], room: int) -> bool:
        return any(stock.largest_within(x + room, used) > x for x in set(filling[1:]))

    def grow(filling: tuple[int, ...], used: dict[int, int], room: int, most: int) -> None:
        left[0] -= 1
        if not stock.largest_within(room, used):
            if filling not in best and not dominated(filling, used, room):
                best[filling] = room
                if len(best) > wanted:
                    del best[max(best, key=lambda f: (best[f], f == incumbent))]
            return
        first = stock.largest_within(min(room, most), used)
        at = bisect_right(stock.lengths, first) - 1
        while at >= 0 and left[0] > 0:
            x = stock.lengths[at]
            at -= 1
            if used.get(x, 0) >= stock.counts[x]:
                continue
            used[x] = used.get(x, 0) + 1
            grow((*filling, x), used, room - x, x)
            used[x] -= 1
            if x == room or len(best) >= wanted and not max(best.values()):
                break  # dominates all smaller ones, or enough without waste

    grow((largest,), {largest: 1}, capacity - largest, capacity - largest)
    return sorted(best, key=lambda f: (best[f], [-x for x in f]))


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: for each k, lengths over half take a bin each, and those from k up to a half only
    find room beside lengths of at most capacity - k."""
    size = np.zeros(capacity + 1, dtype=np.int64)
    size[list(counts)] = list(counts.values())
    number = np.concatenate([[0], np.cumsum(size)])  # number[x]: of lengths below x
    total = np.concatenate([[0], np.cumsum(size * np.arange(capacity + 1))])
    half = capacity // 2
    k = np.arange(half + 1)
    beside = number[capacity - k + 1] - number[half + 1]
    room = beside * capacity - (total[capacity - k + 1] - total[half + 1])
    small = total[half + 1] - total[k]
    return int(number[-1] - number[half + 1] + np.maximum(0, -(-(small - room) // capacity)).max())


def _descend(stock: _Stock, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fillings of the stock, each the best completion around the largest length, as often as it goes."""
    plan = []
    while stock.lengths:
        filling = completions(stock, stock.lengths[-1], capacity)[0]
        times = min(stock.counts[x] // filling.count(x) for x in set(filling))
        stock.take(filling, times)
        plan.append((filling, times))
    return plan


def plan_bins(counts: dict[int, int], capacity: int, nodes: int = 3000) -> list[tuple[tuple[int, ...], int]]:
    """(filling, times) of a packing of ``counts`` (length: how many) into as few bins as found.

    Depth-first branch and bound. The first incumbent takes the best completion at every step; if it doesn't meet the
    lower bound, the search branches at every bin over the undominated completions around the largest length left, used
    as often as it goes or once. A branch is cut where its bins and the lower bound of what is left don't stay below the
    incumbent's, and where its waste does not. The search ends with a packing that meets the lower bound, when it has
    gone through all branches, or after ``nodes`` of them: then the packing may not be the best, but is known to be
    within its distance from the lower bound. Steps depend on the number of different lengths, not of pieces.
    """
    counts = {k: n for k, n in counts.items() if n}
    incumbent = _descend(_Stock(counts), capacity)
    bins, bound = sum(times for _, times in incumbent), lower_bound(counts, capacity)
    spare = lambda: (bins - 1) * capacity - sum(k * n for k, n in counts.items())
    # Open branches: counts left, bins made, waste, the plan so far as a linked list.
    branches: list[tuple[dict[int, int], int, int, tuple | None]] = [(counts, 0, 0, None)]
    while branches and bins > bound and nodes > 0:
        rest, made, waste, plan = branches.pop()
        nodes -= 1
        if not rest:
            bins, incumbent = made, []
            while plan is not None:
                incumbent.append(plan[0])
                plan = plan[1]
            incumbent.reverse()
            continue
        stock = _Stock(rest)
        found = completions(stock, stock.lengths[-1], capacity, nodes=100)
        for filling in reversed(found):
            most = min(rest[x] // filling.count(x) for x in set(filling))
            for times in {1, most}:
                after = dict(rest)
                for x in filling:
                    after[x] -= times
                after = {x: n for x, n in after.items() if n}
                wasted = waste + times * (capacity - sum(filling))
                # The last bin may be emptier than the bound on waste says.
                if made + times + lower_bound(after, capacity) < bins and (wasted <= spare() or not after):
                    branches.append((after, made + times, wasted, ((filling, times), plan)))
    return incumbent


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece.

    Pieces of a sequence lie one after the other from 0 and take at most ``capacity`` tokens. No documents, no rows.
    Columns of docs besides doc_id and text are ignored, whatever their names.
    """
    spark = docs.sparkSession
    pieces = stored(pieces_of(docs, tokenizer_path, capacity, end_id).withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(RANK_PARTS)).cast("int")), "pieces", TEXT_ROWS)
    sizes = pieces.groupBy("length", "part").count()
    ahead = stored(sizes.select("length", "part", "count", (F.sum("count").over(Window.partitionBy("length").orderBy("part")) - F.col("count")).alias("ahead")), "ranks")
    counts = {r["length"]: r["n"] for r in ahead.groupBy("length").agg(F.sum("count").alias("n")).collect()}

    keys, firsts, offsets, done, base = [], [], [], dict.fromkeys(counts, 0), 0
    for filling, times in plan_bins(counts, capacity):
        at = 0
        for x in filling:
            keys.append((x << 40) + done[x])
            firsts.append(base)
            offsets.append(at)
            done[x] += times
            at += x
        base += times
    order = np.argsort(np.asarray(keys, dtype=np.int64), kind="stable")
    table = spark.sparkContext.broadcast(tuple(np.asarray(x, dtype=np.int64)[order] for x in (keys, firsts, offsets)))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, firsts, offsets = table.value
        for batch in batches:
            want = (batch["length"].to_numpy(dtype=np.int64) << 40) + batch.pop("rank").to_numpy(dtype=np.int64)
            at = np.searchsorted(keys, want, side="right") - 1
            yield batch.assign(sequence_id=firsts[at] + want - keys[at], offset=offsets[at])

    rank = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = pieces.withColumn("own", rank).join(ahead, ["length", "part"])
    rows = ranked.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNotNull().alias("has_id"), "piece", "start", "length", "ids_crc32", (F.col("own") - 1 + F.col("ahead")).alias("rank"))
    placed = rows.mapInPandas(place, "id long, has_id boolean, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return placed.select(F.when(F.col("has_id"), F.col("id")).alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
