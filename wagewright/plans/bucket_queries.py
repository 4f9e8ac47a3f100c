"""Queries over stored tables that are bucketed by company and by ad."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.adapters import load, with_views
from wagewright.bucketed import PART, copied, dealt, store
from wagewright.operators import views
from wagewright.plans.queries import PUBLIC, query
from wagewright.stores import bounded, written

#: Buckets of the queries' tables, and places over which one company's ads are dealt out.
BUCKETS, PARTS = 32, 8


@query("jobs_public_bucketed", f"{PUBLIC} SELECT * FROM public")
def jobs_public_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The public view of stored ads, read from tables bucketed by company."""
    keys = ["company_id", PART]
    jobs = store(dealt(load(spark, sf_dir, "jobs"), "job_key", PARTS), "jobs", keys, BUCKETS)
    companies = store(copied(load(spark, sf_dir, "companies"), PARTS), "companies", keys, BUCKETS)
    locations = bounded(written(load(spark, sf_dir, "locations"), "locations"))
    return views.jobs_public(jobs, companies, locations, by=keys)


@query("places_bucketed", with_views("jobs", "job_locations") + """ SELECT job_key, any_value(is_active) AS is_active, count(l.location_id) AS n_locations, min(l.location_id) AS first_location
  FROM jobs LEFT JOIN job_locations l USING (job_key) GROUP BY job_key""")
def places_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places by ad, joined and counted within the buckets of both tables."""
    jobs = store(load(spark, sf_dir, "jobs").select("job_key", "is_active"), "jobs", ["job_key"], BUCKETS)
    places = store(load(spark, sf_dir, "job_locations"), "job_locations", ["job_key"], BUCKETS)
    joined = jobs.join(places, "job_key", "left")
    return joined.groupBy("job_key").agg(F.any_value("is_active").alias("is_active"), F.count("location_id").alias("n_locations"), F.min("location_id").alias("first_location"))
