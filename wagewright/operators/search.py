"""Search over stored ads, its summaries, and the history of searches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagewright.operators.selection import medians
from wagewright.stores import written


def search(jobs: DataFrame, companies: DataFrame, job_locations: DataFrame, locations: DataFrame, term: str, location: str | None = None, period: str | None = None, include_inactive: bool = False) -> DataFrame:
    """Ads with the term in title or description (case ignored; % and _ are wildcards), by company and title.

    A location is a city, province, region or macro-area of any of the ad's places, or remote. Ads without a company
    don't count. Parameters that are None aren't part of the plan.
    """
    like = f"%{term.lower()}%"
    found = jobs.where(F.lower("title").like(like) | F.lower("description").like(like))
    if not include_inactive:
        found = found.where(F.col("is_active") == 1)
    if period is not None:
        found = found.where(F.col("posting_period") == period)
    if location is not None:
        place = location.strip().lower()
        there = locations.where(F.exists(F.array("city", "province", "region", "macro_area"), lambda c: F.lower(c) == place))
        keys = job_locations.join(there.select("location_id"), "location_id", "left_semi").select("job_key").distinct()
        if place in ("remote", "remoto"):
            keys = keys.unionByName(jobs.where("is_remote = 1").select("job_key")).distinct()
        found = found.join(keys, "job_key", "left_semi")
    columns = ["job_key", "title", "salary_transparency", "posting_period", "ral_min_annual", "ral_max_annual"]
    return found.join(companies.select("company_id", F.col("name").alias("company")), "company_id").select(*columns, "company")


PAY = ["ral_min_annual", "ral_max_annual"]


def _counts() -> list:
    return [
        F.count("*").alias("n_jobs"),
        F.count_if(F.col("salary_transparency") == "figure").alias("n_jobs_with_salary"),
        F.count_if(F.col("salary_transparency") == "vague").alias("n_jobs_vague"),
    ]


def _rounded_pay() -> list:
    return [F.bround("ral_min_annual", 0).alias("ral_min_median"), F.bround("ral_max_annual", 0).alias("ral_max_median")]


def summary(rows: DataFrame) -> DataFrame:
    """One row of counts and of exact medians, which are found by counts by range, not from all values at once."""
    seen = written(rows.select("company", "salary_transparency", *PAY), "found")
    middle = medians(seen, [], PAY).select(*_rounded_pay())
    return seen.agg(*_counts(), F.count_distinct("company").alias("n_companies")).join(middle)  # one row each


def by_period(rows: DataFrame) -> DataFrame:
    figure = F.count_if(F.col("salary_transparency") == "figure")
    return rows.groupBy(F.coalesce("posting_period", F.lit("no date")).alias("period")).agg(F.count("*").alias("n_jobs"), F.bround(100 * figure / F.count("*"), 0).alias("pct_with_salary"))


def by_company(rows: DataFrame) -> DataFrame:
    """Companies with most ads first."""
    seen = written(rows.select("company", "salary_transparency", *PAY), "found")
    middle = medians(seen, ["company"], PAY).select("company", *_rounded_pay())
    return seen.groupBy("company").agg(*_counts()).join(middle, "company", "left").orderBy(F.desc("n_jobs"), "company")


def examples(rows: DataFrame, n: int) -> DataFrame:
    return rows.orderBy("company", "title", "job_key").limit(n)


def history_summary(searches: DataFrame) -> DataFrame:
    """Per term and location the latest run, the first one, and what changed between them, in one pass.

    Runs at the same moment are ordered by search_id.
    """
    key = [F.col("search_term"), F.coalesce("location", F.lit(""))]
    last = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("run_at"), F.desc("search_id")))
    whole = Window.partitionBy(*key)
    first = F.min(F.struct("run_at", "search_id", "n_jobs", "n_jobs_with_salary")).over(whole)
    ranked = searches.withColumn("rn", last).withColumn("n_runs", F.count("*").over(whole)).withColumn("first", first).where("rn = 1")
    share = lambda c: F.round(100.0 * F.col(c) / F.nullif(F.col("n_jobs"), F.lit(0)), 1)
    return ranked.select(
        "search_term", "location", "n_runs", F.col("first.run_at").alias("first_run"), F.col("run_at").alias("last_run"), "n_jobs", "n_companies", "n_jobs_with_salary",
        share("n_jobs_with_salary").alias("pct_with_salary"), "n_jobs_vague", share("n_jobs_vague").alias("pct_vague"), "ral_min_median", "ral_max_median",
        (F.col("n_jobs") - F.col("first.n_jobs")).alias("delta_n_jobs"), (F.col("n_jobs_with_salary") - F.col("first.n_jobs_with_salary")).alias("delta_with_salary"),
    )


def appended(searches: DataFrame, found: DataFrame, term: str, location: str | None, run_at) -> DataFrame:
    """searches with one more row: what a search found; its number follows the greatest."""
    number = searches.agg((F.coalesce(F.max("search_id"), F.lit(0)) + 1).alias("search_id"))
    row = summary(found).crossJoin(number).withColumns({"search_term": F.lit(term), "location": F.lit(location), "run_at": F.lit(run_at)})  # one row each
    return searches.unionByName(row.select(*(F.col(c).cast(searches.schema[c].dataType).alias(c) for c in searches.columns)))
