"""Questions that a dashboard puts to published cells."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagewright.operators.cube import AXES


def slice_of(cells: DataFrame, filters: dict[str, str], dim: str) -> DataFrame:
    """The cells of one dimension under filters (axis: value; an axis not named is 'all')."""
    fits = reduce(lambda a, b: a & b, (F.col(a) == filters.get(a, "all") for a in AXES))
    return cells.where(fits & (F.col("dim") == dim))


def chart(cells: DataFrame, filters: dict[str, str], dim: str) -> DataFrame:
    """slice_of, but a filter on the dimension itself is taken out and its value marked."""
    axis = next((a for a, c in AXES.items() if c == dim), None)
    chosen = filters.get(axis, "all") if axis else "all"
    return slice_of(cells, {k: v for k, v in filters.items() if k != axis}, dim).withColumn("is_highlight", F.col("value") == chosen)


def usable_options(cells: DataFrame, filters: dict[str, str], axis: str) -> DataFrame:
    """Values of an axis that have a total cell under the other filters, and the current one."""
    others = {k: v for k, v in filters.items() if k != axis}
    fits = reduce(lambda a, b: a & b, (F.col(a) == others.get(a, "all") for a in AXES if a != axis))
    return cells.where(fits & (F.col("dim") == "total") | (F.col(axis) == filters.get(axis, "all"))).select(F.col(axis).alias("value")).distinct()


def workplace_mix(cells: DataFrame) -> DataFrame:
    """Per filter combination the share of each workplace in the total cell, and what remains hidden (0.5 or more)."""
    total = cells.where("dim = 'total'").select(*AXES, F.col("n_jobs").alias("total"))
    own = cells.where("dim = 'workplace_type'").groupBy(*AXES).pivot("value", ["onsite", "hybrid", "remote", "not_stated"]).agg(F.first("n_jobs"))
    share = {w: F.coalesce(100 * F.col(w) / F.col("total"), F.lit(0.0)) for w in ("onsite", "hybrid", "remote", "not_stated")}
    rest = 100 - sum(share.values())
    return total.join(own, list(AXES), "inner").select(*AXES, *(F.round(v, 3).alias(w) for w, v in share.items()), F.when(rest >= 0.5, F.round(rest, 3)).alias("hidden"))


def salary_domain(cells: DataFrame, dim: str) -> DataFrame:
    """Bounds of a salary axis, in ten thousands."""
    high = F.coalesce("ral_max_median", "ral_min_median")
    return cells.where((F.col("dim") == dim) & F.col("ral_min_median").isNotNull()).agg((F.floor(F.min("ral_min_median") / 10_000) * 10_000).alias("low"), (F.ceil(F.max(high) / 10_000) * 10_000).alias("high"))


def by_pct(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.desc("pct_with_salary"), F.desc("n_jobs"), "value")


def in_order(rows: DataFrame, values: list[str]) -> DataFrame:
    """By a fixed enumeration; values outside it last."""
    at = F.array_position(F.array(*map(F.lit, values)), F.col("value"))
    return rows.orderBy(F.when(at == 0, len(values) + 1).otherwise(at), "value")


def by_top_pay(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.desc(F.coalesce("ral_max_median", "ral_min_median")), "value")


def by_onsite(mix: DataFrame) -> DataFrame:
    """Rows of workplace_mix, those with most ads on site first."""
    return mix.orderBy(F.desc(F.coalesce("onsite", F.lit(0.0))), *AXES)


def with_all_axes(rows: DataFrame) -> DataFrame:
    """rows of cells with every axis: one that is missing or NULL is 'all'."""
    return rows.withColumns({a: F.coalesce(F.col(a), F.lit("all")) if a in rows.columns else F.lit("all") for a in AXES})
