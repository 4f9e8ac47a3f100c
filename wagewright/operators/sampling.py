"""Stratified samples of ads to label, and scores from the labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagewright.stores import written

#: Ads of each stratum in a sample of 200.
QUOTAS = {"text": 120, "structured": 20, "vague": 30, "none": 30}
PER_COMPANY = 8
#: Accepted spellings of each verdict.
VERDICTS = {
    "ok": "ok, correct, right, yes, corretto, corretta, giusto, giusta, si, sì, vero".split(", "),
    "wrong": "wrong, no, errato, errata, sbagliato, sbagliata, falso".split(", "),
    "partial": "partial, partly, parziale, parzialmente, quasi".split(", "),
    "missed": "missed, missing, mancata, mancato, persa, perso, non trovata".split(", "),
    "none": "none, nessuna, nessuno, assente, niente".split(", "),
}


def quotas(size: int) -> dict[str, int]:
    return {k: max(1, round(n * size / 200)) for k, n in QUOTAS.items()}


def stratified(rows: DataFrame, size: int, seed: int, key: str = "job_key", company: str = "company_id") -> DataFrame:
    """Rows (columns source, transparency) in random order by a seeded digest: few per company, then a quota per stratum.

    A row can be in two strata.
    """
    strata = F.filter(
        F.array(
            F.when(F.col("source") == "text", "text"), F.when(F.col("source") == "structured", "structured"),
            F.when(F.col("transparency") == "vague", "vague"), F.when(F.col("transparency") == "none", "none"),
        ), lambda s: s.isNotNull(),
    )
    order = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    placed = rows.withColumn("stratum", F.explode(strata)).withColumn("_o", order)
    few = placed.withColumn("_c", F.row_number().over(Window.partitionBy("stratum", company).orderBy("_o", key))).where(F.col("_c") <= PER_COMPANY)
    quota = F.coalesce(*(F.when(F.col("stratum") == k, n) for k, n in quotas(size).items()))
    return few.withColumn("_n", F.row_number().over(Window.partitionBy("stratum").orderBy("_o", key))).where(F.col("_n") <= quota).drop("_o", "_c", "_n")


def normal_verdict(value: Column, found_any: Column) -> Column:
    """The verdict in one spelling, NULL if unknown; where nothing was extracted, ok means none and an error means missed."""
    plain = F.lower(F.trim(value))
    known = F.coalesce(*(F.when(plain.isin(v), k) for k, v in VERDICTS.items()))
    return F.when(~found_any & (known == "ok"), "none").when(~found_any & known.isin("wrong", "partial"), "missed").otherwise(known)


def precision_recall(rows: DataFrame) -> DataFrame:
    """rows: verdict, source, ats. Precision and recall in total, by source and by ats."""
    n = {v: F.count_if(F.col("verdict") == v) for v in ("ok", "wrong", "partial", "missed")}
    measures = [
        F.count("*").alias("n"),
        F.round(n["ok"] / F.nullif(n["ok"] + n["wrong"] + n["partial"], F.lit(0)), 6).alias("precision"),
        F.round((n["ok"] + n["partial"]) / F.nullif(n["ok"] + n["partial"] + n["missed"], F.lit(0)), 6).alias("recall"),
    ]
    sets = rows.groupingSets([[], [F.col("source")], [F.col("ats")]], F.col("source"), F.col("ats"))
    out = sets.agg(*measures, F.grouping_id().alias("_g"))
    kind = F.when(F.col("_g") == 3, "TOTAL").when(F.col("_g") == 1, "source").otherwise("ats")
    return out.select(kind.alias("kind"), F.coalesce(F.when(F.col("_g") == 1, F.col("source")).when(F.col("_g") == 2, F.col("ats")), F.lit("TOTAL")).alias("value"), "n", "precision", "recall")


def capped(rows: DataFrame, keys: list[str], order: list[str], cap: int) -> DataFrame:
    """The first ``cap`` rows of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= cap).drop("_n")


def evenly(rows: DataFrame, order: str, size: int, parts: int = 32) -> DataFrame:
    """Every k-th row in order, k as large as leaves ``size`` of them; the first ``size``.

    Rows are dealt to ranges of the order; a row's number is its number in its range and the rows of the ranges before.
    """
    dealt = rows.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    counts = {r["_part"]: r["count"] for r in dealt.groupBy("_part").count().collect()}
    k = max(1, sum(counts.values()) // size)
    ahead = [sum(n for p, n in counts.items() if p < part) for part in range(parts)]
    number = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1 + F.get(F.array(*map(F.lit, ahead)), F.col("_part"))
    return dealt.withColumn("_n", number).where((F.col("_n") % k == 0) & (F.col("_n") < k * size)).drop("_n", "_part")


def unlabelled(jobs: DataFrame, samples: list[DataFrame]) -> DataFrame:
    """jobs whose url has no verdict in any of the samples."""
    for sample in samples:
        done = sample.where(F.trim(F.coalesce("verdict", F.lit(""))) != "").select("url")
        jobs = jobs.join(done, "url", "left_anti")
    return jobs


def unknown_verdicts(rows: DataFrame) -> DataFrame:
    """Verdicts that aren't one of the accepted spellings, with how often they occur."""
    own = F.trim("verdict")
    return rows.where((own != "") & normal_verdict(own, F.lit(True)).isNull()).groupBy(own.alias("verdict")).count()


def estimate(hits: Column, sampled: Column, total: Column) -> Column:
    """Hits in a whole of ``total`` from those in a sample."""
    return F.bround(hits / F.nullif(sampled, F.lit(0)) * total, 0).cast("long")
