"""Ads of applicant-tracking systems: one text column of a board's answer to rows of one schema.

No network: texts come from files or tables. Every parser takes a DataFrame with board and body, and returns RAW_AD.
"""

from __future__ import annotations

from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagewright.functions.ids import site_root
from wagewright.functions.places import scope_country
from wagewright.functions.text import _unescape, clean_html
from wagewright.stores import written

RAW_AD = ["ats", "board", "job_id", "title", "location", "locations_all", "country", "department", "employment_type", "workplace_type", "posted_at", "url", "description", "salary_structured"]
PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def parser(ats: str) -> Callable:
    def register(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        PARSERS[ats] = f
        return f

    return register


def _ads(rows: DataFrame, ats: str, **fields: Column) -> DataFrame:
    """RAW_AD; a field not named is NULL, an ad without an id is none."""
    kinds = {"locations_all": "array<string>"}
    columns = [F.lit(ats).alias("ats"), F.col("board")] + [fields.get(c, F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in RAW_AD[2:]]
    return rows.select(*columns).where(F.col("job_id").isNotNull() & (F.col("job_id") != ""))


def _each(docs: DataFrame, schema: str, path: str | None = None) -> DataFrame:
    parsed = docs.select("board", F.from_json("body", schema).alias("p"))
    return parsed.select("board", F.explode(F.col(f"p.{path}") if path else F.col("p")).alias("a"))


@parser("greenhouse")
def greenhouse(docs: DataFrame) -> DataFrame:
    a = "struct<id bigint, title string, location struct<name string>, offices array<struct<name string, location string>>, departments array<struct<name string>>, first_published string, updated_at string, absolute_url string, content string>"
    rows = _each(docs, f"struct<jobs array<{a}>>", "jobs")
    offices = F.filter(F.transform("a.offices", lambda o: F.coalesce(F.nullif(o["location"], F.lit("")), o["name"])), lambda x: x.isNotNull())
    return _ads(rows, "greenhouse", job_id=F.col("a.id"), title=F.col("a.title"), location=F.col("a.location.name"), locations_all=offices, department=F.nullif(F.array_join("a.departments.name", ", "), F.lit("")), posted_at=F.coalesce("a.first_published", "a.updated_at"), url=F.col("a.absolute_url"), description=clean_html(F.col("a.content")))


@parser("lever")
def lever(docs: DataFrame) -> DataFrame:
    a = "struct<id string, text string, categories struct<location string, allLocations array<string>, department string, team string, commitment string>, country string, workplaceType string, createdAt bigint, hostedUrl string, descriptionPlain string, lists array<struct<text string, content string>>, additionalPlain string, salaryRange string>"
    rows = _each(docs, f"array<{a}>")
    lists = F.array_join(F.flatten(F.transform("a.lists", lambda x: F.array(F.coalesce(x["text"], F.lit("")), F.regexp_replace(F.coalesce(x["content"], F.lit("")), "<[^>]+>", " ")))), " ")
    text = F.concat_ws(" ", "a.descriptionPlain", lists, "a.additionalPlain")
    posted = F.date_format(F.timestamp_millis(F.col("a.createdAt")), "yyyy-MM-dd'T'HH:mm:ssXXX")
    return _ads(rows, "lever", job_id=F.col("a.id"), title=F.col("a.text"), location=F.col("a.categories.location"), locations_all=F.col("a.categories.allLocations"), country=F.col("a.country"), department=F.coalesce("a.categories.department", "a.categories.team"), employment_type=F.col("a.categories.commitment"), workplace_type=F.col("a.workplaceType"), posted_at=posted, url=F.col("a.hostedUrl"), description=F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), salary_structured=F.col("a.salaryRange"))


@parser("ashby")
def ashby(docs: DataFrame) -> DataFrame:
    a = "struct<id string, title string, location string, secondaryLocations array<struct<location string>>, address struct<postalAddress struct<addressCountry string>>, department string, employmentType string, workplaceType string, isRemote boolean, publishedAt string, jobUrl string, descriptionPlain string, compensation struct<scrapeableCompensationSalarySummary string, compensationTierSummary string, summaryComponents string>>"
    rows = _each(docs, f"struct<jobs array<{a}>>", "jobs")
    said = F.nullif(F.coalesce("a.compensation.scrapeableCompensationSalarySummary", "a.compensation.compensationTierSummary"), F.lit(""))
    pay = F.coalesce(F.col("a.compensation.summaryComponents"), F.when(said.isNotNull(), F.concat(F.lit('"'), said, F.lit('"'))))
    return _ads(rows, "ashby", job_id=F.col("a.id"), title=F.col("a.title"), location=F.col("a.location"), locations_all=F.col("a.secondaryLocations.location"), country=F.col("a.address.postalAddress.addressCountry"), department=F.col("a.department"), employment_type=F.col("a.employmentType"), workplace_type=F.coalesce("a.workplaceType", F.when(F.col("a.isRemote"), "Remote")), posted_at=F.col("a.publishedAt"), url=F.col("a.jobUrl"), description=F.col("a.descriptionPlain"), salary_structured=pay)


@parser("workable")
def workable(docs: DataFrame) -> DataFrame:
    a = "struct<shortcode string, title string, city string, state string, country string, locations array<struct<city string, region string, country string>>, department string, employment_type string, telecommuting boolean, published_on string, url string, description string>"
    rows = _each(docs, f"struct<jobs array<{a}>>", "jobs")
    all_of = F.transform("a.locations", lambda x: F.concat_ws(", ", x["city"], x["region"], x["country"]))
    return _ads(rows, "workable", job_id=F.col("a.shortcode"), title=F.col("a.title"), location=F.nullif(F.concat_ws(", ", "a.city", "a.state", "a.country"), F.lit("")), locations_all=all_of, country=F.col("a.country"), department=F.col("a.department"), employment_type=F.col("a.employment_type"), workplace_type=F.when(F.col("a.telecommuting"), "remote"), posted_at=F.col("a.published_on"), url=F.col("a.url"), description=clean_html(F.col("a.description")))


@parser("recruitee")
def recruitee(docs: DataFrame) -> DataFrame:
    a = "struct<id bigint, title string, location string, locations array<struct<name string, city string, country string>>, country_code string, department string, employment_type_code string, remote boolean, hybrid boolean, on_site boolean, published_at string, careers_url string, description string, requirements string, salary struct<min string, max string, currency string, period string>>"
    rows = _each(docs, f"struct<offers array<{a}>>", "offers")
    mode = F.when(F.col("a.remote"), "remote").when(F.col("a.hybrid"), "hybrid").when(F.col("a.on_site"), "onsite")
    s = F.col("a.salary")
    pay = F.when(s["min"].isNotNull() | s["max"].isNotNull(), F.to_json(F.struct(s["min"].cast("double").alias("min"), s["max"].cast("double").alias("max"), s["currency"].alias("currency"), s["period"].alias("period"))))
    names = F.transform("a.locations", lambda x: F.coalesce(x["name"], F.concat_ws(", ", x["city"], x["country"])))
    return _ads(rows, "recruitee", job_id=F.col("a.id"), title=F.col("a.title"), location=F.col("a.location"), locations_all=names, country=F.col("a.country_code"), department=F.col("a.department"), employment_type=F.col("a.employment_type_code"), workplace_type=mode, posted_at=F.col("a.published_at"), url=F.col("a.careers_url"), description=clean_html(F.concat_ws(" ", "a.description", "a.requirements")), salary_structured=pay)


@parser("workday")
def workday(docs: DataFrame) -> DataFrame:
    """A board's list joined with its details by the caller: one answer holds postings with their details."""
    a = "struct<externalPath string, title string, locationsText string, jobPostingInfo struct<location string, additionalLocations array<string>, country struct<descriptor string>, timeType string, remoteType string, startDate string, externalUrl string, jobDescription string>>"
    rows = _each(docs, f"struct<jobPostings array<{a}>>", "jobPostings")
    i = F.col("a.jobPostingInfo")
    out = _ads(rows, "workday", job_id=F.element_at(F.split("a.externalPath", "/"), -1), title=F.col("a.title"), location=F.coalesce(i["location"], F.col("a.locationsText")), locations_all=i["additionalLocations"], country=i["country"]["descriptor"], employment_type=i["timeType"], workplace_type=i["remoteType"], posted_at=i["startDate"], url=i["externalUrl"], description=clean_html(i["jobDescription"]))
    first = out.withColumn("_at", F.monotonically_increasing_id()).groupBy("board", "job_id").agg(F.min_by(F.struct(*(c for c in RAW_AD if c not in ("board", "job_id"))), "_at").alias("a"))
    return first.select("board", "job_id", "a.*").select(*RAW_AD)


MANY_PLACES = r"(?i)^\d+ (?:locations|sedi|località|standorte|lieux|locaties)$"


def workday_ads(lists: DataFrame, details: DataFrame, cap: int | None = None) -> DataFrame:
    """RAW_AD of boards whose lists and details are separate answers.

    lists: board, facet (the country the list was asked for, NULL for none), offset, body (a page of postings); details:
    board, path, body. Of each board and country at most ``cap`` postings count, so that none crowds out another; an
    ad in two countries counts once. Without a country's list only postings that name an observed place or several
    places are looked up. A posting without details is left out.
    """
    posting = "array<struct<externalPath string, title string, locationsText string>>"
    rows = lists.select("board", "facet", "offset", F.posexplode(F.from_json("body", f"struct<jobPostings {posting}>")["jobPostings"]).alias("i", "p")).select("board", "facet", "offset", "i", "p.*")
    place = F.coalesce("locationsText", F.lit(""))
    rows = rows.where(F.col("externalPath").isNotNull() & (F.col("facet").isNotNull() | scope_country(place, F.lit(None)).isNotNull() | place.rlike(MANY_PLACES)))
    if cap is not None:
        rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("board", "facet").orderBy("offset", "i"))).where(F.col("_n") <= cap)
    return workday_details(rows.withColumn("at", F.struct("facet", "offset", "i")), details)


POSTING = "struct<externalPath string, title string, locationsText string>"


def workday_postings(lists: DataFrame, details: DataFrame) -> DataFrame:
    """RAW_AD of postings that the paged source has read: board, facet, ordinal, posting."""
    rows = lists.select("board", F.struct("facet", "ordinal").alias("at"), F.from_json("posting", POSTING).alias("p")).select("board", "at", "p.*")
    return workday_details(rows.where(F.col("externalPath").isNotNull()), details)


def workday_details(rows: DataFrame, details: DataFrame) -> DataFrame:
    """RAW_AD of postings (board, at, externalPath, title, locationsText) that have details; the first of each counts."""
    once = rows.groupBy("board", "externalPath").agg(F.min_by(F.struct("title", "locationsText"), "at").alias("p"))
    info = "struct<jobPostingInfo struct<jobReqId string, id string, title string, location string, additionalLocations array<string>, country struct<descriptor string>, timeType string, remoteType string, startDate string, externalUrl string, jobDescription string>>"
    told = details.select("board", F.col("path").alias("externalPath"), F.from_json("body", info)["jobPostingInfo"].alias("d"))
    full = once.join(told, ["board", "externalPath"])
    several = F.when(F.size("d.additionalLocations") > 0, F.concat(F.array("d.location"), F.col("d.additionalLocations")))
    return _ads(full, "workday", job_id=F.coalesce("d.jobReqId", "d.id", "externalPath"), title=F.coalesce("d.title", "p.title"), location=F.coalesce("d.location", "p.locationsText"), locations_all=several, country=F.col("d.country.descriptor"), employment_type=F.col("d.timeType"), workplace_type=F.col("d.remoteType"), posted_at=F.col("d.startDate"), url=F.coalesce("d.externalUrl", F.concat("board", "externalPath")), description=clean_html(F.col("d.jobDescription")))


REQUISITION = "struct<Id string, Title string, PrimaryLocation string, PrimaryLocationCountry string, secondaryLocations array<struct<Name string, CountryCode string>>, JobFamily string, JobFunction string, ContractType string, JobSchedule string, WorkplaceType string, WorkplaceTypeCode string, PostedDate string, ExternalDescriptionStr string>"


def _requisitions(docs: DataFrame) -> DataFrame:
    rows = _each(docs, f"struct<items array<struct<requisitionList array<{REQUISITION}>>>>", "items")
    return rows.select("board", F.explode("a.requisitionList").alias("a"))


def _oracle_fields() -> dict[str, Column]:
    secondary = F.filter("a.secondaryLocations.Name", lambda x: F.coalesce(x, F.lit("")) != "")
    several = F.when(F.size(secondary) > 0, F.concat(F.array("a.PrimaryLocation"), secondary))
    return {"job_id": F.col("a.Id"), "title": F.col("a.Title"), "location": F.col("a.PrimaryLocation"), "locations_all": several, "country": F.col("a.PrimaryLocationCountry"), "department": F.coalesce("a.JobFamily", "a.JobFunction"), "employment_type": F.nullif(F.concat_ws(" ", "a.ContractType", "a.JobSchedule"), F.lit("")), "workplace_type": F.coalesce("a.WorkplaceTypeCode", "a.WorkplaceType"), "posted_at": F.col("a.PostedDate")}


@parser("oracle")
def oracle(docs: DataFrame) -> DataFrame:
    return _ads(_requisitions(docs), "oracle", **_oracle_fields(), description=clean_html(F.col("a.ExternalDescriptionStr")))


def oracle_ads(lists: DataFrame, details: DataFrame) -> DataFrame:
    """RAW_AD of boards whose lists (board, body) and details (board, job_id, body) are separate answers.

    Only ads of observed countries are looked up; one without details has an empty description.
    """
    return oracle_details(_requisitions(lists), details)


def oracle_postings(lists: DataFrame, details: DataFrame) -> DataFrame:
    """RAW_AD of requisitions that the paged source has read: board, facet, ordinal, posting."""
    return oracle_details(lists.select("board", F.from_json("posting", REQUISITION).alias("a")), details)


def oracle_details(rows: DataFrame, details: DataFrame) -> DataFrame:
    """RAW_AD of requisitions (board, a) in observed countries, with their details where there are any."""
    codes = F.concat(F.array("a.PrimaryLocationCountry"), F.coalesce("a.secondaryLocations.CountryCode", F.array().cast("array<string>")))
    places = F.concat(F.array("a.PrimaryLocation"), F.coalesce("a.secondaryLocations.Name", F.array().cast("array<string>")))
    seen = rows.withColumn("_c", F.array_join(codes, "|")).withColumn("_in", F.col("_c").rlike(r"(?i)(?:^|\|)(?:IT|DE|NL|FR)(?:\||$)") | scope_country(F.array_join(places, ", "), F.lit(None)).isNotNull())
    told = details.select("board", "job_id", F.from_json("body", "struct<items array<struct<ExternalDescriptionStr string, ExternalResponsibilitiesStr string, ExternalQualificationsStr string>>>")["items"][0].alias("d"))
    full = seen.where("_in").withColumn("job_id", F.col("a.Id")).join(told, ["board", "job_id"], "left")
    text = clean_html(F.concat_ws(" ", "d.ExternalDescriptionStr", "d.ExternalResponsibilitiesStr", "d.ExternalQualificationsStr"))
    return _ads(full, "oracle", **_oracle_fields(), description=text)


def first_answers(answers: DataFrame, instances: tuple[str, ...] = ("us", "eu")) -> DataFrame:
    """board, instance, body: of each board's answers (board, instance, status, body) the first good one in order."""
    order = F.array_position(F.array(*map(F.lit, instances)), F.col("instance"))
    fine = answers.where((F.col("status") == 200) & (order > 0))
    return fine.groupBy("board").agg(F.min_by(F.struct("instance", "body"), order).alias("a")).select("board", "a.*")


@parser("personio")
def personio(docs: DataFrame) -> DataFrame:
    schema = "struct<position array<struct<id string, name string, office string, additionalOffices struct<office array<string>>, department string, employmentType string, schedule string, createdAt string, jobDescriptions struct<jobDescription array<struct<name string, value string>>>>>>"
    rows = docs.select("board", F.from_xml("body", schema).alias("p")).select("board", F.explode("p.position").alias("a"))
    parts = F.array_join(F.transform("a.jobDescriptions.jobDescription", lambda d: F.concat_ws(" ", d["name"], d["value"])), " ")
    return _ads(rows, "personio", job_id=F.col("a.id"), title=F.col("a.name"), location=F.col("a.office"), locations_all=F.col("a.additionalOffices.office"), department=F.col("a.department"), employment_type=F.concat_ws(" ", "a.employmentType", "a.schedule"), posted_at=F.col("a.createdAt"), description=clean_html(parts))


@parser("teamtailor")
def teamtailor(docs: DataFrame) -> DataFrame:
    """RSS; tags' namespaces are dropped first. The id is the number in the link, else the guid."""
    plain = F.regexp_replace("body", r"<(/?)[A-Za-z0-9]+:", "<$1")
    schema = "struct<channel struct<item array<struct<title string, link string, guid string, pubDate string, description string, remoteStatus string, department string, locations struct<location array<struct<name string, city string, country string>>>>>>>"
    rows = docs.select("board", F.from_xml(plain, schema).alias("p")).select("board", F.explode("p.channel.item").alias("a"))
    day = F.try_to_timestamp(F.regexp_replace("a.pubDate", r"^[A-Za-z]{3}, ", ""), F.lit("dd MMM yyyy HH:mm:ss Z"))
    names = F.transform("a.locations.location", lambda x: F.coalesce(F.nullif(F.concat_ws(", ", x["city"], x["country"]), F.lit("")), x["name"]))
    number = F.nullif(F.regexp_extract(F.coalesce("a.link", F.lit("")), r"/jobs/(\d+)", 1), F.lit(""))
    return _ads(rows, "teamtailor", job_id=F.coalesce(number, F.col("a.guid")), title=F.col("a.title"), location=F.try_element_at(names, F.lit(1)), locations_all=names, department=F.col("a.department"), workplace_type=F.col("a.remoteStatus"), posted_at=F.date_format(day, "yyyy-MM-dd"), url=F.col("a.link"), description=clean_html(F.col("a.description")))


class _Inner(HTMLParser):
    """The inner HTML of the first element that has an attribute value, whatever is nested in it."""

    EMPTY = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self, value: str):
        super().__init__(convert_charrefs=False)
        self.value, self.depth, self.done, self.parts = value, 0, False, []

    def handle_starttag(self, tag, attrs):
        if self.depth:
            self.parts.append(self.get_starttag_text())
        if not self.done and tag not in self.EMPTY and (self.depth or self.value in [v for _, v in attrs]):
            self.depth += 1

    def handle_startendtag(self, tag, attrs):
        if self.depth:
            self.parts.append(self.get_starttag_text())

    def handle_endtag(self, tag):
        if self.depth and tag not in self.EMPTY:
            self.depth -= 1
            self.done = not self.depth
        if self.depth:
            self.parts.append(f"</{tag}>")

    def handle_data(self, data):
        if self.depth:
            self.parts.append(data)

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def handle_charref(self, name):
        self.handle_data(f"&#{name};")


def inner_html(page: str | None, value: str) -> str | None:
    found = _Inner(value)
    found.feed(page or "")
    return "".join(found.parts) if found.parts or found.done else None


@F.pandas_udf(T.StringType())
def inner_html_column(pages: pd.Series, values: pd.Series) -> pd.Series:
    return pd.Series([inner_html(p, v) for p, v in zip(pages, values, strict=True)], dtype=object)


@parser("successfactors")
def successfactors(docs: DataFrame) -> DataFrame:
    """One ad page per row, with the column url. The place is city, region and country, else what the address says."""
    def prop(name: str) -> Column:
        return F.nullif(F.trim(_unescape(F.regexp_extract("body", rf'(?is)<meta[^>]*itemprop="{name}"[^>]*content="([^"]*)"', 1))), F.lit(""))

    og = F.nullif(F.regexp_extract("body", r'(?is)<meta[^>]*property="og:title"[^>]*content="([^"]*)"', 1), F.lit(""))
    title = F.coalesce(F.nullif(clean_html(F.regexp_extract("body", r'(?is)itemprop="title"[^>]*>(.*?)</', 1)), F.lit("")), clean_html(og))
    day = F.try_to_timestamp(F.regexp_replace(prop("datePosted"), r"^[A-Za-z]{3} ", ""), F.lit("MMM dd HH:mm:ss z yyyy"))
    number = F.regexp_extract("url", r"/(\d+)/?$", 1)
    named = F.nullif(F.concat_ws(", ", prop("addressLocality"), prop("addressRegion"), prop("addressCountry")), F.lit(""))
    part = F.regexp_extract("url", r"/job/([^/]+)", 1)
    said = F.nullif(F.regexp_replace(F.coalesce(F.try_url_decode(part), part), "[-_]+", " "), F.lit(""))
    text = F.substring(clean_html(inner_html_column(F.col("body"), F.lit("description"))), 1, 20_000)
    return _ads(docs, "successfactors", job_id=number, title=title, location=F.coalesce(named, said), country=prop("addressCountry"), employment_type=prop("employmentType"), posted_at=F.coalesce(F.date_format(day, "yyyy-MM-dd"), prop("datePosted")), url=F.col("url"), description=text)


NO_AD = r"(?i)talent-?community|candidatura-spontanea|spontaneous"


def sitemap_urls(docs: DataFrame, most: int = 10) -> DataFrame:
    """board, url: the different ad addresses of a site's maps; open applications left out.

    docs: board, url, body of the maps that were fetched. The walk begins at the board's sitemap.xml and follows maps
    that maps name on the same host, ``most`` of them at most, the nearest to the first and then the first named.
    """
    maps = docs.select("board", "url", "body")
    reached = maps.select("board", F.concat(site_root(F.col("board")), F.lit("/sitemap.xml")).alias("url")).distinct().withColumn("at", F.lit("0"))
    known = level = written(reached, "maps")
    for depth in range(1, most):
        nested = level.join(maps, ["board", "url"]).select("board", "at", F.posexplode(F.regexp_extract_all("body", F.lit(r"<sitemap>\s*<loc>\s*([^<\s]+)\s*</loc>"), 1)).alias("i", "url"))
        here = nested.where(site_root(F.col("url")) == site_root(F.col("board"))).join(known, ["board", "url"], "left_anti")
        place = F.concat_ws(".", F.lit(str(depth)), F.regexp_replace("at", r"^\d+\.?", ""), F.lpad(F.col("i").cast("string"), 6, "0"))
        level = written(here.groupBy("board", "url").agg(F.min(place).alias("at")), "maps")
        if level.isEmpty():
            break
        known = known.unionByName(level)
    walked = known.withColumn("_n", F.row_number().over(Window.partitionBy("board").orderBy("at", "url"))).where(F.col("_n") <= most)
    urls = walked.join(maps, ["board", "url"]).select("board", F.explode(F.regexp_extract_all("body", F.lit(r"<loc>\s*([^<\s]*/job/[^<\s]*)\s*</loc>"), 1)).alias("url")).distinct()
    return urls.select("board", F.replace("url", F.lit("&amp;"), F.lit("&")).alias("url")).where(~F.col("url").rlike(NO_AD))


def facet_counts(docs: DataFrame) -> DataFrame:
    """board, country code, n: ads by country in a tree of facets of any depth; per country the greatest count anywhere."""
    v = F.try_parse_json("body")
    level = written(docs.select("board", F.explode(F.try_variant_get(v, "$.facets", "array<variant>")).alias("v")), "facets")
    every = level
    while not level.isEmpty():
        level = written(level.select("board", F.explode(F.try_variant_get("v", "$.values", "array<variant>")).alias("v")), "facets")
        every = every.unionByName(level)
    named = every.select("board", scope_country(F.lit(""), F.try_variant_get("v", "$.descriptor", "string")).alias("cc"), F.try_variant_get("v", "$.count", "bigint").alias("n"))
    return named.where("cc is not null and n is not null").groupBy("board", "cc").agg(F.max("n").alias("n"))


def facet_totals(docs: DataFrame) -> DataFrame:
    """board, n_jobs_italy, n_jobs_scope by the facets; NULL where they name no country."""
    counts = facet_counts(docs).groupBy("board").agg(F.max(F.when(F.col("cc") == "IT", F.col("n"))).alias("n_jobs_italy"), F.sum("n").alias("n_jobs_scope"))
    return docs.select("board").distinct().join(counts, "board", "left")


def parse(docs: DataFrame, ats: str) -> DataFrame:
    return PARSERS[ats](docs)
