"""From ads as boards give them to stored ads: places, rules, pay, history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.functions import pay, places, rules, text
from wagewright.operators.history import insert_or_ignore, replace_children
from wagewright.schema import conform

#: Systems whose employment field isn't read again from stored ads, as it isn't stored.
REPROCESSED_WORKPLACE = ["ashby", "lever", "oracle", "recruitee", "teamtailor", "workable", "workday"]


def places_of(ads: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """job_key, ordinal, raw and the place of each of an ad's places that is observed.

    The ad's own location comes first, then all others; an ad with none but a country is placed by that.
    """
    named = F.filter(F.concat(F.array("location"), F.coalesce("locations_all", F.array().cast("array<string>"))), lambda x: x.isNotNull() & (x != ""))
    listed = F.when(F.size(named) > 0, named).when(F.coalesce("country", F.lit("")) != "", F.array(F.lit("")))
    rows = ads.select("job_key", "country", F.col("workplace_type").alias("workplace"), F.posexplode(listed).alias("ordinal", "raw"))
    found = places.geocode(rows, gazetteer)
    return found.where(places.kept(F.col("location_id")))


def derived(ads: DataFrame) -> DataFrame:
    """ads (title, description, department, employment_type, salary_structured, posted_at, first_seen, country_code,
    workplace_type, location_raw, is_remote) with all columns that rules derive."""
    title, description = F.col("title"), F.coalesce("description", F.lit(""))
    out = ads.withColumn("_level", rules.seniority_with_source(title, description)).withColumn("contract_type", rules.contract_type(F.col("employment_type"), title, description))
    out = out.withColumn("_with", rules.with_contract(F.col("_level.level"), F.col("_level.source"), F.col("contract_type")))
    out = out.withColumns({
        "seniority": F.col("_with.level"), "seniority_source": F.col("_with.source"), "experience_years": F.col("_level.years"),
        "job_function": rules.job_function(title, F.col("department")), "work_schedule": rules.work_schedule(F.col("employment_type"), title, description),
        "description_lang": rules.description_lang(description), "posted_date": rules.posted_date(F.col("posted_at")), "workplace_ats": F.col("workplace_type"),
        "_workplace": rules.workplace_with_source(F.col("workplace_type"), F.col("location_raw"), description, title),
    })
    remote = F.col("_workplace.value").isNull() & (F.col("is_remote") == 1)
    out = out.withColumns({"workplace_type": F.when(remote, "remote").otherwise(F.col("_workplace.value")), "workplace_source": F.when(remote, "location").otherwise(F.col("_workplace.source"))})
    out = out.withColumn("posting_period", rules.posting_period(F.col("posted_date"), rules.posted_date(F.col("first_seen").cast("string"))))
    out = out.withColumn("_pay_text", F.concat_ws(" ", title, description)).withColumn("is_intern", (F.col("seniority") == "intern") | F.coalesce(F.col("contract_type") == "internship", F.lit(False)))
    return pay.with_pay(out, text="_pay_text").drop("_level", "_with", "_workplace", "_pay_text", "is_intern")


def country_code(country: Column) -> Column:
    """Of the English name; an ad without one counts as Italy's."""
    return F.coalesce(*(F.when(country == name, code) for code, name in places.NAMES.items()), F.lit("IT"))


def last_rows(ads: DataFrame) -> DataFrame:
    """One row of each ad: that with the greatest ordinal where raw has one (the order in which ads were read), of equal
    ones the greatest by its other columns."""
    columns = [c for c in ads.columns if c not in ("job_key", "ordinal")]
    order = [F.col(c) for c in (["ordinal"] if "ordinal" in ads.columns else []) + columns]
    return ads.groupBy("job_key").agg(F.max(F.struct(*order)).alias("a")).select("job_key", "a.*")


def build(raw: DataFrame, boards: DataFrame, gazetteer: DataFrame, known: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """(ads, their places) of one crawl.

    raw: RAW_AD; boards: board, company_id; known: job_key, first_seen. Open applications, ads without an id and ads
    outside the observed countries don't count. Personal data in texts is scrubbed before anything else reads them.
    """
    ads = raw.where(F.coalesce("job_id", F.lit("")) != "").where(~rules.is_open_application(F.col("title")))
    ads = ads.withColumn("job_key", F.concat_ws("|", "ats", "board", "job_id"))
    ads = last_rows(ads)
    spots = places_of(ads, gazetteer)
    main = spots.groupBy("job_key").agg(F.min_by(F.struct("location_id", "city", "place_country", "is_remote"), "ordinal").alias("p"))
    seen = ads.join(main, "job_key").join(known.select("job_key", F.col("first_seen").alias("_first")), "job_key", "left").join(boards.select("board", "company_id"), "board", "left")
    seen = seen.withColumns({
        "location_raw": F.col("location"), "location_id": F.col("p.location_id"), "city": F.col("p.city"), "is_remote": F.col("p.is_remote"), "_country": F.col("p.place_country"),
        "n_locations": 1 + F.coalesce(F.size("locations_all"), F.lit(0)), "description": text.scrub_personal_data(F.col("description")), "first_seen": F.coalesce("_first", F.lit(now)), "last_seen": F.lit(now),
        "is_active": F.lit(1), "slug_or_url": F.col("board"), "salary_structured_json": F.col("salary_structured"),
    })
    seen = seen.withColumn("country", F.col("_country")).withColumn("country_code", country_code(F.col("_country"))).withColumn("description_length", F.length("description"))
    full = derived(seen.drop("p", "_first", "_country")).withColumn("content_hash", text.content_hash(F.col("title"), F.col("description")))
    children = spots.where(F.col("raw") != "").groupBy("job_key", F.col("raw").alias("location_raw")).agg(F.min_by("location_id", "ordinal").alias("location_id"))
    return conform(full, "jobs"), conform(children, "job_locations")


def save(jobs: DataFrame, children: DataFrame, new_jobs: DataFrame, new_children: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored ads and places with those of a crawl in place of their own."""
    kept = jobs.join(new_jobs.select("job_key"), "job_key", "left_anti").unionByName(new_jobs)
    parents = children.join(new_jobs.select("job_key"), "job_key", "left_anti")
    return kept, insert_or_ignore(replace_children(parents, new_children, "job_key"), new_children.limit(0), ["job_key", "location_raw"], "location_id")


def reprocess(jobs: DataFrame) -> DataFrame:
    """Stored ads with all derived columns computed anew; what turns out an open application becomes inactive."""
    ats_value = F.when(F.col("ats").isin(REPROCESSED_WORKPLACE), F.coalesce("workplace_ats", F.when(F.col("workplace_source") == "ats", F.col("workplace_type")))).otherwise(F.col("workplace_ats"))
    again = jobs.withColumns({"workplace_type": ats_value, "employment_type": F.lit(None).cast("string"), "salary_structured": F.col("salary_structured_json"), "country_code": country_code(F.col("country"))})
    out = derived(again)
    return conform(out.withColumn("is_active", F.when(rules.is_open_application(F.col("title")), 0).otherwise(F.col("is_active"))), "jobs")
