"""Benchmark decontamination by winnowing, with DataFrame functions only.

Every k-gram of words is hashed, and in each run of w consecutive k-grams the least hash is kept as a fingerprint.
Two texts that share k + w - 1 consecutive words share a fingerprint, so with k + w - 1 equal to the window length no
shared window is missed. Documents' fingerprints are joined with the benchmark's, and around each hit the whole
windows are compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import ASCII_LOWER, ASCII_UPPER, bounded, row_key, stored

#: What lies between words, once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Documents from which the rarest word of a short item is estimated, and bits of the map that such words pass through.
SAMPLE, BITMAP = 2000, 1 << 16


def words_of(lowered: Column) -> Column:
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def exact_words(text: Column) -> Column:
    """Words with A-Z lower-cased, and no other letters: what some of them become depends on what follows the word."""
    return words_of(F.translate(F.coalesce(text, F.lit("")), ASCII_UPPER, ASCII_LOWER))


def after(values: str, n: int) -> Column:
    """The array from its element n on (from 0)."""
    return F.slice(values, n + 1, 1 << 30)


def with_grams(df: DataFrame, words: str, k: int, to: str) -> DataFrame:
    """Hash of the k words from each position on; the last k - 1 are of fewer words.

    By doubling. Each step is a column of its own, as a nested expression would be computed anew wherever it is used.
    """
    df = df.withColumn("__1", F.transform(words, lambda x: F.xxhash64(x)))
    size = 1
    while 2 * size <= k:
        df = df.withColumn(f"__{2 * size}", F.zip_with(f"__{size}", after(f"__{size}", size), lambda a, b: F.xxhash64(a, b)))
        size *= 2
    have, steps = size, [f"__{1 << i}" for i in range(size.bit_length())]
    df = df.withColumn(to, F.col(steps[-1]))
    for i in reversed(range(size.bit_length() - 1)):
        if (k - size) >> i & 1:
            df = df.withColumn(to, F.zip_with(to, after(f"__{1 << i}", have), lambda a, b: F.xxhash64(a, b)))
            have += 1 << i
    return df.drop(*steps)


def with_fingerprints(df: DataFrame, words: str, window: int, k: int, to: str) -> DataFrame:
    """Distinct least hashes of each window's k-grams; none if there are fewer words than a window."""
    df, have, w = with_grams(df, words, k, "__least"), 1, window - k + 1
    while have < w:
        step = min(have, w - have)
        df = df.withColumn("__least", F.zip_with("__least", after("__least", step), lambda a, b: F.least(a, b)))
        have += step
    kept = F.array_distinct(F.slice("__least", 1, F.greatest(F.size(words) - window + 1, F.lit(0))))
    return df.withColumn(to, F.when(F.size(words) >= window, kept).otherwise(F.array().cast("array<bigint>"))).drop("__least")


def windows_at(words: Column, starts: Column, length: int) -> Column:
    return F.transform(starts, lambda i: F.struct(i.alias("pos"), F.array_join(F.slice(words, i, length), " ").alias("window")))


def anchors_of(short: DataFrame, docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """short (len, window, items) with word and off: the word of the window by which it is looked for, and its place.

    It is the word that fewest of about ``sample`` documents hold (of equals the longest, then the first); another
    choice would cost more but find the same.
    """
    n = max(1, docs.count())
    some = docs.where(F.pmod(F.xxhash64("key"), F.lit(n)) < sample).select(F.explode(F.array_distinct(exact_words(F.col("text")))).alias("word"))
    each = short.select("len", "window", F.posexplode(F.split("window", " ")).alias("off", "word"))
    seen = some.join(each.select("word").distinct(), "word", "left_semi").groupBy("word").agg(F.count("*").alias("c"))
    ranked = each.join(seen, "word", "left").withColumn("rank", F.struct(F.coalesce("c", F.lit(0)).alias("c"), (-F.length("word")).alias("l"), "off"))
    best = ranked.groupBy("len", "window").agg(F.min_by(F.struct("word", "off"), "rank").alias("a"))
    return stored(short.join(best.select("len", "window", "a.word", "a.off"), ["len", "window"]), "anchors")


def marked_words(words: Column, anchors: DataFrame) -> Column:
    """Positions of words that may be an anchor: a bitmap over hashes lets all anchors pass, and few other words."""
    h = F.pmod(F.xxhash64("word"), F.lit(BITMAP))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (h % 64).cast("int"))
    rows = anchors.select(F.floor(h / 64).cast("int").alias("i"), bit.alias("bit")).groupBy("i").agg(F.bit_or("bit").alias("bits")).collect()  # at most BITMAP / 64
    table = [0] * (BITMAP // 64)
    for r in rows:
        table[r["i"]] = r["bits"]
    longs = F.array(*(F.lit(x).cast("long") for x in table))

    def place(w: Column, i: Column) -> Column:
        own = F.pmod(F.xxhash64(w), F.lit(BITMAP))
        held = F.call_function("shiftrightunsigned", F.get(longs, F.floor(own / 64).cast("int")), (own % 64).cast("int")).bitwiseAND(F.lit(1).cast("long"))
        return F.when(held == 1, i + 1)

    return F.filter(F.transform(words, place), lambda p: p.isNotNull())


def short_hits(docs: DataFrame, short: DataFrame, window: int) -> DataFrame:
    """key, pos, len, items of windows of fewer than ``window`` words: only around words that may be an anchor are the
    documents' words compared, so no document is taken apart into all its words."""
    anchors = anchors_of(short, docs)
    words = docs.select("key", exact_words(F.col("text")).alias("words"))
    spots = words.withColumn("at", marked_words(F.col("words"), anchors)).where(F.size("at") > 0).select("key", "words", F.explode("at").alias("at"))
    first = F.greatest(F.col("at") - (window - 2), F.lit(1))
    near = spots.select("key", "at", first.alias("first"), F.get("words", F.col("at") - 1).alias("word"), F.slice("words", first, 2 * window - 3).alias("around"))
    start = F.col("at") - F.col("off")
    found = near.join(bounded(anchors), "word").withColumn("pos", start).where(F.col("pos") >= 1)
    own = F.array_join(F.slice("around", F.col("pos") - F.col("first") + 1, F.col("len")), " ")
    return found.where(own == F.col("window")).select("key", "pos", "len", "items")


def occurrences(docs: DataFrame, items: DataFrame, window: int = 10, k: int = 5) -> tuple[DataFrame, DataFrame]:
    """(documents with key and n_words, occurrences: key, pos, len, items)."""
    own = stored(items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item"), exact_words(F.col("text")).alias("words")).where(F.size("words") > 0), "items")
    length = F.least(F.size("words"), F.lit(window))
    parts = own.select("item", length.alias("len"), F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - length + 1), lambda i: F.array_join(F.slice("words", i, length), " "))).alias("window"))
    windows = parts.groupBy("len", "window").agg(F.collect_set("item").alias("items"))
    whole, short = stored(windows.where(F.col("len") == window), "windows"), stored(windows.where(F.col("len") < window), "windows")
    marks = stored(with_fingerprints(own.select("words"), "words", window, k, "fps").select(F.explode("fps").alias("fp")).distinct(), "marks")

    keyed = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("text"))
    counted = keyed.select("doc_id", "key", exact_words(F.col("text")).alias("words"))
    base = stored(with_fingerprints(counted, "words", window, k, "fps").select("doc_id", "key", F.size("words").cast("long").alias("n_words"), "fps"), "prints")
    shared = base.select("key", F.explode("fps").alias("fp")).join(bounded(marks), "fp").groupBy("key").agg(F.collect_set("fp").alias("fps"))
    shared = stored(shared, "shared")

    # Extension: of the words around a shared k-gram, the windows that hold it are compared with the items' windows.
    near = keyed.join(bounded(shared), "key")
    near = with_grams(near.select("key", "fps", exact_words(F.col("text")).alias("words")), "words", k, "grams")
    at = F.filter(F.transform("grams", lambda g, i: F.when(F.array_contains("fps", g), i + 1)), lambda i: i.isNotNull())
    starts = F.array_distinct(F.flatten(F.transform(at, lambda p: F.sequence(F.greatest(p - (window - k), F.lit(1)), p))))
    fit = F.filter(starts, lambda s: s <= F.size("words") - window + 1)
    found = near.select("key", F.explode(windows_at(F.col("words"), fit, window)).alias("e")).select("key", F.lit(window).alias("len"), "e.pos", "e.window")
    hits = found.join(bounded(whole), ["len", "window"]).select("key", "pos", "len", "items")
    if not short.isEmpty():
        hits = hits.unionByName(short_hits(keyed, short, window))
    return base, hits


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, k: int = 5) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of docs.

    Columns of docs and items besides doc_id, text and item_id are ignored, whatever their names.
    Null and empty texts have no words and hit nothing. Repeated rows are judged alike. Items without words or
    without an id take no part; rows of one item id are one item. No items: nothing is contaminated.
    """
    base, hits = occurrences(docs, items, window, k)
    spans = F.sort_array(F.collect_set(F.struct("pos", "len")))
    union = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(1).alias("free")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["pos"] + s["len"] - F.greatest(s["pos"], acc["free"]), F.lit(0))).alias("n"),
            F.greatest(acc["free"], s["pos"] + s["len"]).alias("free"),
        ),
        lambda acc: acc["n"],
    )
    by_doc = hits.groupBy("key").agg(spans.alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    judged = by_doc.select("key", union.cast("long").alias("n_hit"), "items")
    out = base.select("doc_id", "key", "n_words").join(judged, "key", "left")
    own = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(own).cast("long").alias("n_items"), F.sha2(F.array_join(own, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, window: int = 10, k: int = 5) -> DataFrame:
    """The rows of docs without any word in a benchmark window, with docs' own columns, whatever their names.

    Null and empty texts stay. Repeated rows stay or go together. Without items everything stays; an empty table stays
    empty.
    """
    _, hits = occurrences(docs, items, window, k)
    leaks = stored(hits.select(F.col("key").alias("__key")).distinct(), "leaks")
    return docs.withColumn("__key", row_key(F.col("doc_id"), F.col("text"))).join(leaks, "__key", "left_anti").drop("__key")


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL
), iw AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0)
), dw AS (
  SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)
), hit AS (SELECT dw.r, dw.p, dw.n, iw.item FROM dw JOIN iw USING (n, win)
), pos AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT r, p, n FROM hit)) GROUP BY r
), its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
