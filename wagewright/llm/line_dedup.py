"""Line dedup by a log-template tree.

A line's place in the tree is its number of tokens and its leading tokens, with tokens that hold a digit taken as
variable fields. Under one leaf, lines that agree in enough positions form a template, in which the positions that
differ become variable too. A template that occurs in several documents is recurring: its first line (by doc_id, then
by place) stays and all its other lines are dropped.

Only the distinct lines of leaves that hold more than one of them are parsed further, a leaf in one pass and in the
order of its signatures. A line travels as its signature, one sign for each token, so that whole texts are not shuffled
for it.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import TEXT_ROWS, bounded, row_key, stored

VARIABLE = "<*>"
DIGIT = re.compile("[0-9]")
#: Templates of a leaf up to which a line is compared with each of them; beyond it an index names those that can match.
BLOCK = 256


def line_rows(text: str, min_tokens: int, depth: int, signs: dict[str, str]) -> Iterator[tuple[int, int, int, str]]:
    """(line_no, leaf, h, signature) of each line that has enough tokens.

    leaf and h are 64-bit hashes of the place in the tree and of the line with variable fields. A signature has one
    sign for each token: ``*`` for a variable field, else one of 83 by a hash of the token (``signs`` keeps them).
    """
    any_digit = DIGIT.search(text) is not None
    for line_no, line in enumerate(text.split("\n")):
        tokens = line.split()
        if len(tokens) < min_tokens:
            continue
        if any_digit and DIGIT.search(line):
            tokens = [VARIABLE if DIGIT.search(t) else t for t in tokens]
        try:
            sig = "".join([signs[t] for t in tokens])
        except KeyError:
            for t in tokens:
                if t not in signs:
                    n = zlib.crc32(t.encode()) % 83 + 43
                    signs[t] = "*" if t == VARIABLE else chr(n)
            sig = "".join([signs[t] for t in tokens])
        head = f"{len(tokens)} {' '.join(tokens[:depth])}"
        yield line_no, signed64(head), signed64(" ".join(tokens)), sig


def signed64(text: str) -> int:
    h = xxhash.xxh3_64_intdigest(text.encode())
    return h - (1 << 64) if h >> 63 else h


def lines_of(keyed: DataFrame, min_tokens: int, depth: int) -> DataFrame:
    """keyed: key, text (no nulls). Returns key, line_no, leaf, h, sig."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        signs: dict[str, str] = {}
        for batch in batches:
            for k in range(0, len(batch), 256):
                part = batch.iloc[k : k + 256]
                if len(signs) > 300_000:
                    signs.clear()
                made = [list(line_rows(text, min_tokens, depth, signs)) for text in part["text"]]
                rows = pd.DataFrame([r for own in made for r in own], columns=["line_no", "leaf", "h", "sig"])
                at = np.repeat(np.arange(len(part)), [len(own) for own in made])
                yield pd.concat([part[["has_id", "id", "h1", "h2"]].iloc[at].reset_index(drop=True), rows], axis=1)

    # pandas has no null in a column of longs, so ids travel with a flag.
    flat = keyed.select(F.col("key.id").isNotNull().alias("has_id"), F.coalesce("key.id", F.lit(0)).cast("long").alias("id"), "key.h1", "key.h2", "text")
    rows = flat.mapInPandas(cut, "has_id boolean, id long, h1 long, h2 long, line_no int, leaf long, h long, sig string")
    own = F.struct(F.when(F.col("has_id"), F.col("id")).alias("id"), "h1", "h2")
    return rows.select(own.alias("key"), "line_no", "leaf", "h", "sig")


class Leaf:
    """Templates of one leaf, whose signatures have one width.

    A line joins the template that most positions agree with (the first of equals), if they are at least the given
    share; positions that differ become variable. Otherwise it starts a template.

    If up to d positions may differ, then of d + 1 segments at least one agrees as a whole. So beyond ``block``
    templates a line is only compared with those that hold one of its segments, which loses none that can match.
    """

    def __init__(self, width: int, similarity: float, block: int = BLOCK):
        self.need = math.ceil(similarity * width)
        self.segments = width - self.need + 1
        self.block = block
        self.table = np.empty((4, width), dtype=np.uint8)
        self.first: list[int] = []
        self.index: dict[tuple[int, bytes], set[int]] | None = None

    def _enter(self, template: int, segments: Iterable[int]) -> None:
        line = self.table[template].tobytes()
        for s in segments:
            self.index.setdefault((s, line[s :: self.segments]), set()).add(template)

    def _leave(self, template: int, segments: Iterable[int]) -> None:
        line = self.table[template].tobytes()
        for s in segments:
            self.index[s, line[s :: self.segments]].discard(template)

    def place(self, line: bytes, h: int) -> int:
        """h of the first line of the template that the line joins."""
        n, row = len(self.first), np.frombuffer(line, dtype=np.uint8)
        if self.index is None and n > self.block:
            self.index = {}
            for template in range(n):
                self._enter(template, range(self.segments))
        if self.index is None:
            near, rows = None, self.table[:n]
        else:
            near = sorted(set().union(*(self.index.get((s, line[s :: self.segments]), ()) for s in range(self.segments))))
            rows = self.table[near]
        if len(rows):
            same = (rows == row).sum(1)
            at = int(same.argmax())
            if same[at] >= self.need:
                best = at if near is None else near[at]
                apart = np.flatnonzero(self.table[best] != row)
                moved = set((apart % self.segments).tolist()) if self.index is not None else ()
                self._leave(best, moved)
                self.table[best][apart] = ord("*")
                self._enter(best, moved)
                return self.first[best]
        if n == len(self.table):
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
        self.table[n] = row
        self.first.append(h)
        if self.index is not None:
            self._enter(n, range(self.segments))
        return h


def templates_of(lines: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """lines: leaf, h, sig (distinct). Returns leaf, h, t (h of the template's first line).

    A leaf's lines pass one by one through one task, which holds the leaf's templates and not its lines.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, templates = None, None
        for batch in batches:
            t = []
            for leaf, h, sig in zip(batch["leaf"].tolist(), batch["h"].tolist(), batch["sig"].tolist(), strict=True):
                if leaf != now:
                    now, templates = leaf, Leaf(len(sig), similarity, block)
                t.append(templates.place(sig.encode("latin-1"), h))
            yield pd.DataFrame({"leaf": batch["leaf"], "h": batch["h"], "t": np.array(t, dtype=np.int64)})

    dealt = lines.repartition("leaf").sortWithinPartitions("leaf", "sig", "h")
    return dealt.select("leaf", "h", "sig").mapInPandas(parse, "leaf long, h long, t long")


def dedup_lines(docs: DataFrame, min_tokens: int = 3, depth: int = 4, similarity: float = 0.8, min_docs: int = 2) -> DataFrame:
    """docs with text less the dropped lines, and the new columns n_lines and n_dropped (long).

    Lines of fewer than min_tokens tokens always stay. Repeated rows (same doc_id and text) are one document and are
    treated alike. A null text stays null and has no lines; a text whose lines are all dropped becomes empty.
    Columns of docs named n_lines or n_dropped are replaced.
    """
    keyed = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("text").alias("text"))
    lines = stored(lines_of(keyed.where(F.col("text").isNotNull()), min_tokens, depth), "lines", TEXT_ROWS)

    place = F.struct("key", "line_no")
    distinct = stored(lines.groupBy("leaf", "h").agg(F.min(place).alias("first"), F.max("key").alias("last_key"), F.min("sig").alias("sig")), "distinct")
    shared_leaf = distinct.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1").select("leaf")
    parsed = templates_of(distinct.select("leaf", "h", "sig").join(shared_leaf, "leaf", "left_semi"), similarity)

    grown = distinct.join(parsed, ["leaf", "h"], "left").select("leaf", "h", F.coalesce("t", "h").alias("t"), "first", "last_key")
    grown = stored(grown, "grown")
    if min_docs > 2:
        own = lines.select("leaf", "h", "key").distinct().join(grown.select("leaf", "h", "t"), ["leaf", "h"]).select("leaf", "t", "key").distinct()
        enough = own.groupBy("leaf", "t").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
        grown = grown.join(enough.select("leaf", "t"), ["leaf", "t"], "left_semi")
    recurring = grown.groupBy("leaf", "t").agg(F.min("first").alias("stays"), F.max("last_key").alias("last_key")).where(F.col("stays.key") < F.col("last_key"))
    goes = grown.join(recurring.select("leaf", "t", "stays"), ["leaf", "t"]).select("leaf", "h", "stays")
    dropped = lines.select("key", "line_no", "leaf", "h").join(goes, ["leaf", "h"]).where(place != F.col("stays")).groupBy(F.col("key").alias("__key")).agg(F.array_distinct(F.collect_list("line_no")).alias("__gone"))
    dropped = stored(dropped, "dropped")

    rest = F.array_join(F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains("__gone", i)), "\n")
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    out = docs.select(*columns, row_key(F.col("doc_id"), F.col("text")).alias("__key")).join(bounded(dropped), "__key", "left")
    return out.select(
        *(F.when(F.col("__gone").isNull(), F.col("text")).otherwise(rest).alias("text") if c == "text" else F.col(c) for c in columns),
        F.coalesce(F.when(F.col("text").isNotNull(), F.size(F.split("text", "\n"))), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
