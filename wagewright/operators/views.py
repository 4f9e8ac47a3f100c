"""The engine's views: discovery coverage, public ads, and counts for the publication's header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagewright.functions.places import NAMES
from wagewright.schema import MACRO_SECTORS


def coverage(registry: DataFrame) -> DataFrame:
    """Tech, non tech and TOTAL: six counts. A NULL ats counts in none of them."""
    group = F.when(F.col("is_tech") == 1, "tech").otherwise("non tech")
    known, supported = F.col("ats") != "none", F.col("supported") == 1
    return (
        registry.withColumn("g", group)
        .rollup("g")
        .agg(
            F.count("*").alias("companies"),
            F.count_if(known).alias("with_ats"),
            F.count_if(supported & F.col("confidence").isin("high", "medium")).alias("supported_ready"),
            F.count_if(supported & (F.col("confidence") == "low")).alias("supported_to_review"),
            F.count_if(known & (F.col("supported") == 0)).alias("not_supported"),
            F.count_if(F.col("ats") == "none").alias("no_ats"),
            F.grouping("g").alias("_all"),
        )
        .select(F.when(F.col("_all") == 1, "TOTAL").otherwise(F.col("g")).alias("group_name"), "companies", "with_ats", "supported_ready", "supported_to_review", "not_supported", "no_ats")
    )


def by_ats(registry: DataFrame) -> DataFrame:
    counted = registry.groupBy("ats", "supported").agg(F.count("*").alias("n"), F.count_if(F.col("confidence") == "low").alias("n_low"))
    return counted.orderBy(F.desc("supported"), F.desc("n"), "ats")


#: Columns of public ads, of which neither texts nor phrases or raw fields of them are any.
PUBLIC_JOB = "job_key title url ats job_function seniority contract_type work_schedule workplace_type is_remote description_lang location_id city country salary_transparency salary_source salary_period salary_gross_net ral_min_annual ral_max_annual posted_at posted_date posting_period first_seen last_seen is_active".split()
PUBLIC_PLACE = "province province_code region macro_area city_size_band".split()
PUBLIC_COMPANY = {"name": "company", "sector": "sector", "micro_sector": "micro_sector", "is_tech": "is_tech", "company_type": "company_type", "size_band": "company_size"}


def jobs_public(jobs: DataFrame, companies: DataFrame, locations: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Ads with company and place, by the public columns alone; a column that a table lacks the view lacks too.

    ``by``: the columns that ads and companies are joined by, the first the company, as both are stored (``bucketed``).
    """
    by = by or ["company_id"]
    have = lambda df, names: [c for c in names if c in df.columns]
    own = jobs.select(*by, *have(jobs, PUBLIC_JOB))
    named = own.join(companies.select(*by, *(F.col(c).alias(PUBLIC_COMPANY[c]) for c in have(companies, PUBLIC_COMPANY))), by, "left").drop(*by[1:])
    placed = named.join(locations.select("location_id", *have(locations, PUBLIC_PLACE)), "location_id", "left")
    return placed.withColumn("posted_after_law", F.when(F.col("posting_period") == "post_law", 1).otherwise(0))


def cube_ads(jobs: DataFrame, companies: DataFrame, locations: DataFrame) -> DataFrame:
    """Stored ads as the cube takes them: the active ones of a known country, each with its company's macro-sector and
    a region, and with a seniority only where the ad states one."""
    macro = F.coalesce(*(F.when(F.col("sector").isin(sectors), name) for name, sectors in MACRO_SECTORS.items()), F.lit("other"))
    code = F.coalesce(*(F.when(F.col("country") == name, cc) for cc, name in NAMES.items()), F.col("country"))
    active = jobs.where((F.col("is_active") == 1) & F.col("country").isNotNull())
    named = active.join(companies.select("company_id", "sector"), "company_id")
    placed = named.join(locations.select("location_id", "region"), "location_id", "left")
    return placed.select(
        "job_key", "company_id", code.alias("country"), macro.alias("macro_sector"), "posting_period", region().alias("region"), "job_function",
        F.when(F.coalesce("seniority_source", F.lit("")) != "not_stated", F.col("seniority")).alias("seniority"),
        "contract_type", "workplace_type", "salary_transparency", "ral_min_annual", "ral_max_annual",
    )


def region() -> Column:
    """Region of the place, else Remote, else Unspecified."""
    return F.coalesce("region", F.when(F.col("is_remote") == 1, "Remote").otherwise("Unspecified"))


def meta_counts(public: DataFrame) -> DataFrame:
    counts = (F.col("is_active") == 1) & F.col("country").isNotNull()
    return public.agg(
        F.min("first_seen").alias("observed_from"),
        F.max("last_seen").alias("last_update"),
        F.count_if(counts).alias("n_jobs_active"),
        F.count_distinct(F.when(counts, F.col("company_id"))).alias("n_companies_active"),
    )


def region_or(jobs: DataFrame, locations: DataFrame) -> DataFrame:
    """job_key and region() of each ad."""
    return jobs.join(locations.select("location_id", "region"), "location_id", "left").select("job_key", region().alias("region"))


def ready_boards(registry: DataFrame) -> DataFrame:
    """Boards to crawl: supported, sure enough, with a slug; of equal slugs (case and blanks ignored) the first by company."""
    fine = registry.where((F.col("supported") == 1) & F.col("confidence").isin("high", "medium") & F.col("slug").isNotNull())
    first = F.row_number().over(Window.partitionBy(F.lower(F.trim("slug"))).orderBy("company", "company_id"))
    return fine.withColumn("_n", first).where("_n = 1").drop("_n")
