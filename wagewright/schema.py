"""Schemas of the engine's tables, and label maps of its closed sets of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPANIES = "company_id string, name string, website string, website_verified int, sector string, is_tech int, micro_sector string, company_type string, hq_city string, size_band string, source string, updated_at string"
ATS_REGISTRY = "company_id string, company string, sector string, is_tech int, ats string, slug_or_url string, instance string, supported int, detection_method string, confidence string, n_jobs_total int, n_jobs_italy int, n_jobs_scope int, careers_url string, evidence string, last_checked string, notes string"
LOCATIONS = "location_id string, city string, istat_code string, province string, province_code string, region string, region_code string, macro_area string, country string, country_code string, population bigint, city_size_band string, is_capoluogo int, lat double, lon double, is_remote int"
JOBS = (
    "job_key string, ats string, slug_or_url string, job_id string, company_id string, title string, department string, job_function string, seniority string, seniority_source string, experience_years int, contract_type string, work_schedule string, "
    "workplace_type string, workplace_ats string, workplace_source string, location_raw string, location_id string, city string, country string, is_remote int, n_locations int, url string, description string, description_lang string, description_length int, "
    "posted_at string, posted_date date, posting_period string, salary_structured_json string, salary_source string, salary_min double, salary_max double, salary_currency string, salary_period string, salary_gross_net string, ral_min_annual double, ral_max_annual double, "
    "salary_text_matches array<string>, salary_vague int, salary_transparency string, first_seen string, last_seen string, is_active int, content_hash string"
)
JOB_LOCATIONS = "job_key string, location_id string, location_raw string"
CRAWL_RUNS = "run_id bigint, company_id string, ats string, slug_or_url string, started_at string, finished_at string, n_jobs_seen bigint, n_jobs_new bigint, status string, error string"
SEARCHES = "search_id bigint, search_term string, location string, run_at string, n_jobs bigint, n_companies bigint, n_jobs_with_salary bigint, n_jobs_vague bigint, ral_min_median double, ral_max_median double"
TABLES = {"companies": COMPANIES, "ats_registry": ATS_REGISTRY, "locations": LOCATIONS, "jobs": JOBS, "job_locations": JOB_LOCATIONS, "crawl_runs": CRAWL_RUNS, "searches": SEARCHES}

# Sectors of each macro-sector; others count as other.
MACRO_SECTORS = {
    "finance": ["banks", "asset_management", "insurance", "financial_services", "fintech"],
    "consulting": ["big4", "consulting", "it_consulting"],
    "tech_media": ["software_saas", "big_tech", "ecommerce_marketplace", "education", "marketing_media", "media_publishing"],
    "energy_infrastructure": ["energy_utilities", "telco", "infrastructure", "transport_logistics"],
    "industry_pharma": ["industrial", "automotive", "pharma_health", "food_beverage", "consumer_goods"],
    "fashion_retail": ["fashion_luxury", "retail"],
}

# Labels shown for codes.
LABELS = {
    "country": {"IT": "Italy", "DE": "Germany", "NL": "Netherlands", "FR": "France", "not_stated": "Remote in Europe"},
    "macro_sector": {"finance": "Finance and insurance", "consulting": "Consulting", "tech_media": "Technology and media", "energy_infrastructure": "Energy, telco and infrastructure", "industry_pharma": "Industry and pharma", "fashion_retail": "Fashion and retail"},
    "sector": {
        "banks": "Banks", "asset_management": "Asset management", "insurance": "Insurance", "financial_services": "Financial services", "fintech": "Fintech and insurtech", "big4": "Big Four", "consulting": "Consulting", "it_consulting": "IT consulting",
        "marketing_media": "Marketing and media agencies", "media_publishing": "Media and publishing", "energy_utilities": "Energy and utilities", "telco": "Telecommunications", "fashion_luxury": "Fashion and luxury", "retail": "Retail and grocery",
        "industrial": "Industrial", "automotive": "Automotive", "food_beverage": "Food and beverage", "consumer_goods": "Consumer goods", "pharma_health": "Pharma and healthcare", "transport_logistics": "Transport and logistics", "infrastructure": "Infrastructure",
        "big_tech": "Big tech", "software_saas": "Software", "ecommerce_marketplace": "E-commerce and marketplaces", "education": "Education",
    },
    "job_function": {
        "engineering": "Engineering and IT", "data": "Data and analytics", "product": "Product", "design": "Design", "project_management": "Project management", "sales": "Sales", "retail": "Stores", "marketing": "Marketing and communication",
        "finance": "Finance and accounting", "insurance": "Insurance (claims, actuarial)", "hr": "Human resources", "legal": "Legal, compliance and tenders", "strategy": "Strategy and planning", "admin": "Office support and back office",
        "customer_service": "Customer service", "operations": "Operations, production and technicians", "consulting": "Consulting", "healthcare": "Healthcare", "hospitality": "Food service and hospitality", "other": "Other",
    },
    "seniority": {"intern": "Internship", "junior": "Junior", "mid": "Mid-level", "senior": "Senior", "lead": "Lead / expert specialist", "manager": "Manager", "director": "Director", "executive": "Executive"},
    "contract_type": {"permanent": "Permanent", "fixed_term": "Fixed term", "internship": "Internship", "apprenticeship": "Apprenticeship", "freelance": "Freelance", "agency": "Agency work"},
    "workplace_type": {"onsite": "On site", "hybrid": "Hybrid", "remote": "Remote"},
    "salary_transparency": {"figure": "States the pay", "vague": "Vague wording only", "none": "No information"},
    "posting_period": {"post_law": "From 7 June 2026", "pre_law": "Before the law", "old": "Online for over a year"},
    "region": {"Remote": "Remote", "Unspecified": "Location not stated"},
}


def fields(ddl: str) -> T.StructType:
    """A schema from its text, without needing a session's parser."""
    kinds = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType(), "array<string>": T.ArrayType(T.StringType())}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in (x.split(" ") for x in ddl.split(", "))])


def conform(df: DataFrame, table: str) -> DataFrame:
    """df with exactly a table's columns: missing ones are NULL, others go."""
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields(TABLES[table])))


def labelled(df: DataFrame, column: str, to: str = "label") -> DataFrame:
    """df with the label of a code; a code without one is shown as it is, none as not_stated."""
    pairs = [F.lit(x) for kv in LABELS[column].items() for x in kv]
    own = F.coalesce(F.col(column), F.lit("not_stated"))
    return df.withColumn(to, F.coalesce(F.element_at(F.create_map(*pairs), own), own))


def percent(value: Column, digits: int = 0) -> Column:
    return F.concat(F.format_number(value, digits), F.lit(" %"))


def euro(value: Column) -> Column:
    return F.concat(F.lit("€"), F.format_number(value, 0))


def pay_range(low: Column, high: Column) -> Column:
    """One amount, or two with a dash; NULL without the lower one."""
    return F.when(high.isNull() | (high == low), euro(low)).otherwise(F.concat(euro(low), F.lit(" – "), euro(high)))
