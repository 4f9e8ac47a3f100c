"""The relational operators over small tables: against their SQL, and by properties."""

import glob
import os
import random
import re
import statistics
from collections import Counter
from functools import cache

import pytest
from pyspark.sql import functions as F

from wagewright.functions import ids
from wagewright.operators import cells as cell_queries
from wagewright.operators import cube, disclosure, history, registry, sampling, search, views
from wagewright.plans import board_queries, file_queries, state_queries  # noqa: F401  (they register their queries)
from wagewright.plans.queries import ORACLES, QUERIES
from wagewright.schema import conform
from wagewright.sources import ads as sources

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"cube_cells", "disclosure_primary", "disclosure_medians", "usable_filter_options", "dimension_chart", "salary_domain", "workplace_mix", "disclosure_difference"}


def plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, (bool, str)):
        return value
    if isinstance(value, int):
        return float(value)
    return round(float(value), 6) if isinstance(value, float) or type(value).__name__ == "Decimal" else str(value)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_same_as_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    ours = Counter(tuple(plain(r[c]) for c in columns) for r in got.collect())
    names = list(want.columns)
    theirs = Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in want.fetchall())
    assert ours == theirs


def ads_of(spark, rows):
    return spark.createDataFrame(
        rows,
        "company_id int, country string, macro_sector string, posting_period string, region string, job_function string, seniority string, contract_type string, workplace_type string, salary_transparency string, ral_min_annual double, ral_max_annual double",
    )


def random_ads(spark, seed, n):
    rng = random.Random(seed)
    pick = rng.choice
    return ads_of(spark, [
        (rng.randint(1, 9), pick(["IT", "DE"]), pick(["a", "b"]), pick(["post_law", "pre_law", None]), pick(["r", None, ""]), pick(["data", "hr"]), pick(["mid", None]), pick(["p", None]),
         pick(["onsite", "hybrid", "field", None]), pick(["figure", "vague", "none"]), pick([None, 30000.0, 41000.0]), pick([None, 50000.0])) for _ in range(n)
    ])


@pytest.mark.parametrize("seed", [1, 2])
def test_disclosure_levels_equal_a_sequential_pass(spark, seed):
    ads = random_ads(spark, seed, 160)
    own = cube.Cube(ads)
    got = own.decoded(disclosure.hide_differences(disclosure.primary(own.cells(medians=False)), own).where("visible"))
    companies: dict[tuple, Counter] = {}
    for r in own.decoded(own.by_company()).collect():
        companies.setdefault(tuple(r[c] for c in cube.CELL), Counter())[r["company_id"]] = r["n"]

    def fine(counts):
        return sum(counts) >= 5 and len(counts) >= 3 and max(counts) <= 0.7 * sum(counts) if counts else False

    def tells(parent, key):
        left = [n for n in (companies[parent] - companies[key]).values() if n]
        return bool(left) and not fine(left)

    def parents(key, axes):
        return [key[:i] + ("all",) + key[i + 1 :] for i in axes if key[i] != "all"]

    @cache
    def shown(key):
        return fine(list(companies[key].values())) and not any(shown(p) and tells(p, key) for p in parents(key, range(1, 5)))

    periods = {p for key in companies if fine(list(companies[key].values())) for p in parents(key, [0]) if fine(list(companies[p].values())) and tells(p, key)}
    assert {tuple(r[c] for c in cube.CELL) for r in got.collect()} == {key for key in companies if shown(key)} - periods


def test_cells_of_some_dimensions_are_the_same(spark):
    ads = random_ads(spark, 4, 120)
    rows = lambda df: {tuple(r) for r in df.select(*cube.CELL, "n_jobs", "ral_min_median", "ral_max_median").collect()}
    whole = rows(disclosure.published(ads))
    assert rows(disclosure.published(ads, ["region", "total"])) == {r for r in whole if r[5] in ("region", "total")}


def test_medians(spark):
    rng = random.Random(7)
    pay = [(rng.choice("ab"), rng.choice([None, *range(20_000, 20_400)]), rng.choice([None, 40_000, 50_123])) for _ in range(400)]
    ads = ads_of(spark, [(1, c, "m", "post_law", "r", "f", "s", "p", "onsite", "figure", low and float(low), high and float(high)) for c, low, high in pay])
    found = {(r["dim"], r["value"]): (r["ral_min_median"], r["ral_max_median"]) for r in cube.cells(ads, ["total", "country"]).where("period = 'all' and country = 'all' and macro = 'all' and function = 'all' and workplace = 'all'").collect()}
    for dim, value, own in [("total", "all", pay), *(("country", c, [p for p in pay if p[0] == c]) for c in "ab")]:
        lows = [low for _, low, _ in own if low is not None]
        highs = [high for _, low, high in own if low is not None and high is not None]
        assert found[dim, value] == (round(statistics.median(lows), -2), round(statistics.median(highs), -2))


def test_cube_properties(spark):
    ads = random_ads(spark, 5, 80)
    found = cube.cells(ads).collect()
    totals = {tuple(r[a] for a in cube.AXES): r["n_jobs"] for r in found if r["dim"] == "total"}
    sums: Counter = Counter()
    for r in found:
        if r["dim"] != "total":
            sums[(*(r[a] for a in cube.AXES), r["dim"])] += r["n_jobs"]
    assert all(totals[k[:-1]] == n for k, n in sums.items())
    assert totals[("all",) * 5] == 80
    assert {r["value"] for r in found if r["dim"] == "region"} == {"r", "not_stated"}
    assert not [r for r in found if r["dim"] == "posting_period" and r["period"] != "all"]


def cell_rows(spark, rows):
    data = [("all", "all", "all", "all", "all", "region", v, n, c, s, 0, 0, 1.0, 30000.0, 40000.0) for v, n, c, s in rows]
    return spark.createDataFrame(data, "period string, country string, macro string, function string, workplace string, dim string, value string, n_jobs long, n_companies long, top_share double, n_ral long, n_ral_companies long, ral_top_share double, ral_min_median double, ral_max_median double")


def test_thresholds_and_secondary(spark):
    rows = [("Lombardia", 100, 10, 0.3), ("Lazio", 50, 6, 0.4), ("Piemonte", 40, 5, 0.5), ("Molise", 4, 3, 0.5), ("Umbria", 20, 2, 0.5), ("Marche", 30, 4, 0.9)]
    def seen(own):
        shown = disclosure.secondary(disclosure.primary(cell_rows(spark, own)), F.concat_ws("|", *cube.AXES, "dim"), F.col("dim") == "total", "value")
        return {r["value"] for r in shown.where("visible").collect()}

    assert seen(rows) == {"Lombardia", "Lazio", "Piemonte"}
    assert seen(rows[:2] + rows[3:4]) == {"Lombardia"}
    assert {r["ral_min_median"] for r in disclosure.primary(cell_rows(spark, rows)).collect()} == {None}


def test_snapshot_merge(spark):
    old = spark.createDataFrame([("a", "1", "d1", "d1", 1, 1.0), ("a", "2", "d1", "d1", 1, 2.0), ("b", "3", "d1", "d1", 1, 3.0), ("c", "4", "d1", "d1", 1, 4.0)], "board string, job_key string, first_seen string, last_seen string, is_active int, pay double")
    seen = spark.createDataFrame([("a", "1", 1, 9.0), ("a", "1", 2, None), ("a", "5", 3, 5.0), ("b", "6", 4, 6.0)], "board string, job_key string, ordinal int, pay double")
    boards = spark.createDataFrame([("a", True), ("b", False), ("c", True)], "board string, ok boolean")
    got = {r["job_key"]: (r["first_seen"], r["last_seen"], r["is_active"], r["pay"]) for r in history.merge_snapshot(old, seen, boards, "d2").collect()}
    assert got == {"1": ("d1", "d2", 1, None), "2": ("d1", "d1", 0, 2.0), "3": ("d1", "d1", 1, 3.0), "4": ("d1", "d1", 0, 4.0), "5": ("d2", "d2", 1, 5.0)}


def test_upserts(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, s string")
    new = spark.createDataFrame([("b", 3, None), ("c", 4, "z")], "k string, n int, s string")
    assert {tuple(r) for r in history.upsert(old, new, ["k"]).collect()} == {("a", 1, "x"), ("b", 3, None), ("c", 4, "z")}
    assert {tuple(r) for r in history.insert_or_ignore(old, new, ["k"], "n").collect()} == {("a", 1, "x"), ("b", 2, "y"), ("c", 4, "z")}
    assert {tuple(r) for r in history.replace_children(old, new, "k").collect()} == {("a", 1, "x"), ("b", 3, None), ("c", 4, "z")}


def test_sampling(spark):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("job_key"), (F.col("id") % 3).alias("company_id"), F.lit("text").alias("source"), F.when(F.col("id") % 2 == 0, "vague").otherwise("figure").alias("transparency"))
    out = sampling.stratified(rows, 200, 1)
    assert {(r["stratum"], r["n"]) for r in out.groupBy("stratum").agg(F.count("*").alias("n")).collect()} == {("text", 24), ("vague", 24)}
    assert sampling.quotas(10) == {"text": 6, "structured": 1, "vague": 2, "none": 2}
    assert [r["id"] for r in sampling.evenly(spark.range(10), "id", 3).collect()] == [0, 3, 6]


def test_chart_and_options(spark):
    rows = spark.createDataFrame([("all", "all", "all", "all", "all", "country", "IT", 9, 10.0), ("all", "all", "all", "all", "all", "country", "DE", 5, 20.0), ("all", "IT", "all", "all", "all", "total", "all", 9, 10.0)], "period string, country string, macro string, function string, workplace string, dim string, value string, n_jobs long, pct_with_salary double")
    assert {(r["value"], r["is_highlight"]) for r in cell_queries.chart(rows, {"country": "IT"}, "country").collect()} == {("IT", True), ("DE", False)}
    assert {r["value"] for r in cell_queries.usable_options(rows, {"country": "IT"}, "country").collect()} == {"IT"}
    assert [r["value"] for r in cell_queries.in_order(rows.where("dim = 'country'"), ["DE", "IT"]).collect()] == ["DE", "IT"]


def test_fingerprint_evidence_and_escapes(spark):
    rows = [(2, "two.workable.com apply.workable.com/one apply.workable.com/two"), (1, "https://acme%2Dgroup.recruitee.com%2Fx https%3A%5C%2F%5C%2FJOBS.lever.co%2fcaf%C3%A9%ff &#x2F; 100% apply.workable.com/two"), (3, "no board at all"), (4, None)]
    found = registry.fingerprints(spark.createDataFrame(rows, "page_id int, html string"))
    got = {(r["page_id"], r["slug"]): r["evidence"] for r in found.collect()}
    assert got[(2, "two")] == "apply.workable.com/two" and got[(2, "one")] == "apply.workable.com/one" and got[(1, "acme-group")] == "acme-group.recruitee.com" and (1, "caf") in got
    assert {r["slug"]: (r["n"], r["evidence"]) for r in registry.merged(found).collect()}["two"] == (3, "apply.workable.com/two")
    assert set(registry.LITERALS) == {ats for ats, _ in registry.FINGERPRINTS} | {"workday"}


def test_fingerprints(spark):
    page = spark.createDataFrame([(1, r'<a href="https:\/\/jobs.eu.lever.co\/acme/abc-123"> jobs.lever.co/acme www.recruitee.com')], "page_id int, html string")
    got = registry.fingerprints(page).collect()
    assert {(r["ats"], r["slug"], r["instance"], r["n"]) for r in got} == {("lever", "acme", "eu", 1), ("lever", "acme", "us", 1)}
    html = (
        '<a href="https://boards.greenhouse.io/embed/job_board?a=b&amp;for=Co-1"> //x.taleo.net/a https%3A%2F%2Fy.intervieweb.it//teamtailor-cdn.com/app.js '
        "https://acme.wd3.myworkdayjobs.com/it-IT/Ext/job/9 wd3.myworkdaysite.com/en-US/recruiting/acme/Group https://h1.fa.ocs.oraclecloud.com/hcmUI/CandidateExperience/it/sites/CX_1 https://jobs.eu.lever.co/acme"
    )
    got = registry.fingerprints(spark.createDataFrame([(1, html)], "page_id int, html string"))
    found = {(r["ats"], r["slug"], r["instance"], r["supported"]) for r in got.collect()}
    assert found == {
        ("greenhouse", "Co-1", "us", True), ("taleo", "x", None, False), ("inrecruiting", "y", None, False), ("inrecruiting", None, None, False), ("teamtailor", None, None, True), ("lever", "acme", "eu", True),
        ("workday", "https://acme.wd3.myworkdayjobs.com/Ext", None, True), ("workday", "https://wd3.myworkdaysite.com/recruiting/acme/Group", None, True), ("oracle", "h1.fa.ocs.oraclecloud.com/hcmUI/CandidateExperience/it/sites/CX_1", None, True),
    }
    first = registry.ranked(got, "page_id").orderBy("rank").collect()
    assert first[0]["supported"] and not first[-1]["supported"] and first[0]["evidence"]
    row = spark.createDataFrame([("taleo", 0, None), ("lever", 0, None), ("successfactors", 0, "no public job list"), ("lever", 1, None)], "ats string, supported int, notes string")
    assert [r["x"] for r in row.select(registry.newly_supported(F.col("ats"), F.col("supported"), F.col("notes")).alias("x")).collect()] == [False, True, False, False]


def test_career_links(spark):
    html = '<a href="/about">About</a> <a class=x href=\'/lavora-con-noi\'>Qui</a> <a href="https://jobs.acme.it/?a=1&amp;b=2">Open positions</a> <a href="https://www.linkedin.com/jobs">jobs</a> <a href="../team/">Join us</a> <a href="https://acme.it/x/y/">careers</a> <a href="mailto:jobs@acme.it">jobs</a>'
    got = ids.career_links(spark.createDataFrame([(1, html, "https://acme.it/x/y")], "page_id int, html string, base string"), "page_id", "html", "base")
    assert {(r["url"], r["score"]) for r in got.collect()} == {("https://jobs.acme.it/?a=1&b=2", 6), ("https://acme.it/lavora-con-noi", 2), ("https://acme.it/team/", 2)}


def test_public_ads_have_no_texts(spark):
    job = conform(spark.createDataFrame([("k", "c", "l", "secret text", "secret phrase")], "job_key string, company_id string, location_id string, description string, content_hash string"), "jobs")
    companies = conform(spark.createDataFrame([("c", "Acme")], "company_id string, name string"), "companies")
    places_table = conform(spark.createDataFrame([("l", "Lazio")], "location_id string, region string"), "locations")
    public = views.jobs_public(job, companies, places_table)
    assert len(public.columns) == 39 and not {"description", "salary_text_matches", "salary_structured_json", "content_hash", "location_raw"} & set(public.columns)
    assert (public.first()["company"], public.first()["region"]) == ("Acme", "Lazio")


def test_samples_leave_labelled_ads_out(spark):
    jobs = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "url string")
    labelled = spark.createDataFrame([("u1", "ok"), ("u2", " "), ("u9", "dunno")], "url string, verdict string")
    assert {r["url"] for r in sampling.unlabelled(jobs, [labelled]).collect()} == {"u2", "u3"}
    assert [tuple(r) for r in sampling.unknown_verdicts(labelled).collect()] == [("dunno", 1)]
    assert [r["id"] for r in sampling.evenly(spark.range(1000), "id", 4, parts=7).orderBy("id").collect()] == [0, 250, 500, 750]


def test_searches_are_appended(spark):
    runs = spark.createDataFrame([], "search_id bigint, search_term string, location string, run_at string, n_jobs bigint, n_companies bigint, n_jobs_with_salary bigint, n_jobs_vague bigint, ral_min_median double, ral_max_median double")
    found = spark.createDataFrame([("a", "figure", 30000.0, None), ("b", "none", None, None)], "company string, salary_transparency string, ral_min_annual double, ral_max_annual double")
    runs = search.appended(search.appended(runs, found, "data", None, "d1"), found, "data", "milano", "d2")
    assert [(r["search_id"], r["location"], r["n_jobs"], r["ral_min_median"]) for r in runs.orderBy("search_id").collect()] == [(1, None, 2, 30000.0), (2, "milano", 2, 30000.0)]


def test_named_companies_and_axes(spark):
    rows = spark.createDataFrame([("acme-spa",), ("other",)], "company_id string")
    assert [r["company_id"] for r in history.named_companies(rows, ["Acme S.p.A.", "Nobody"]).collect()] == ["acme-spa"]
    assert tuple(cell_queries.with_all_axes(spark.createDataFrame([("IT", None)], "country string, macro string")).select(*cube.AXES).first()) == ("all", "IT", "all", "all", "all")


def test_lists_and_details(spark):
    posting = lambda path, place: f'{{"externalPath": "{path}", "title": "T", "locationsText": "{place}"}}'
    lists = spark.createDataFrame(
        [("b", "it", 0, f'{{"jobPostings": [{posting("/1", "Milan")}, {posting("/2", "Milan")}]}}'), ("b", "de", 0, f'{{"jobPostings": [{posting("/1", "Berlin")}, {posting("/3", "Berlin")}, {posting("/4", "Berlin")}]}}'),
         ("c", None, 0, f'{{"jobPostings": [{posting("/5", "London")}, {posting("/6", "3 Locations")}, {posting("/7", "Roma")}]}}')], "board string, facet string, offset int, body string")
    details = spark.createDataFrame([(b, f"/{i}", f'{{"jobPostingInfo": {{"jobReqId": "R{i}", "location": "Milan", "additionalLocations": ["Rome"], "jobDescription": "<p>x</p>"}}}}') for b, i in (("b", 1), ("b", 2), ("b", 3), ("b", 4), ("c", 5), ("c", 6))], "board string, path string, body string")
    got = sources.workday_ads(lists, details, cap=2)
    assert {(r["board"], r["job_id"]) for r in got.collect()} == {("b", "R1"), ("b", "R2"), ("b", "R3"), ("c", "R6")}
    assert got.first()["locations_all"] == ["Milan", "Rome"] and got.count() == 4
    reqs = spark.createDataFrame([("b", '{"items": [{"requisitionList": [{"Id": "1", "PrimaryLocation": "Rome", "PrimaryLocationCountry": "IT"}, {"Id": "2", "PrimaryLocationCountry": "US", "PrimaryLocation": "Austin"}, {"Id": "3", "PrimaryLocationCountry": "US", "secondaryLocations": [{"Name": "Munich", "CountryCode": "DE"}]}]}]}')], "board string, body string")
    told = spark.createDataFrame([("b", "1", '{"items": [{"ExternalDescriptionStr": "a", "ExternalQualificationsStr": "b"}]}')], "board string, job_id string, body string")
    assert {(r["job_id"], r["description"]) for r in sources.oracle_ads(reqs, told).collect()} == {("1", "a b"), ("3", "")}
    answers = spark.createDataFrame([("x", "us", 404, None), ("x", "eu", 200, "e"), ("y", "eu", 200, "e"), ("y", "us", 200, "u"), ("z", "us", 500, None)], "board string, instance string, status int, body string")
    assert {tuple(r) for r in sources.first_answers(answers).collect()} == {("x", "eu", "e"), ("y", "us", "u")}


def test_nested_sitemaps(spark):
    loc = lambda u: f"<loc>{u}</loc>"
    h = "https://h.it"
    maps = [
        (h, f"{h}/sitemap.xml", f"<sitemap>{loc(f'{h}/a.xml')}</sitemap><sitemap>{loc('https://other.it/b.xml')}</sitemap>"), (h, f"{h}/a.xml", f"<sitemap>{loc(f'{h}/c.xml')}</sitemap>" + loc(f"{h}/job/Rome/1/") + loc(f"{h}/about")),
        (h, f"{h}/c.xml", loc(f"{h}/job/x?a=1&amp;b=2") + loc(f"{h}/job/Rome/1/") + loc(f"{h}/job/Talent-Community/3/") + f"<sitemap>{loc(f'{h}/a.xml')}</sitemap>"), (h, "https://other.it/b.xml", loc("https://other.it/job/9")),
    ]
    got = sources.sitemap_urls(spark.createDataFrame(maps, "board string, url string, body string"))
    assert {r["url"] for r in got.collect()} == {f"{h}/job/Rome/1/", f"{h}/job/x?a=1&b=2"}


def test_registry(spark):
    found = spark.createDataFrame([("c", "lever", "other", 1), ("c", "lever", "acmespa", 2), ("c", "ashby", "acme", 3)], "company_id string, ats string, slug string, rank int")
    names = spark.createDataFrame([("c", "Acme S.p.A.")], "company_id string, name string")
    assert [r["slug"] for r in registry.own_slug_first(found, names).orderBy("rank").collect()] == ["acmespa", "other", "acme"]
    facets = spark.createDataFrame([("b", "country", "x", 5), ("b", "country", "y", 2), ("b", "city", "z", 6)], "board string, param string, id string, n int")
    assert [(r["param"], r["ids"]) for r in registry.best_facet(facets).collect()] == [("country", ["x", "y"])]
    ads = spark.createDataFrame([("b", "1", None, "Milano", None), ("b", "2", None, "London", ["Berlin"]), ("b", "3", "GB", "London", None)], "board string, job_id string, country string, location string, locations_all array<string>")
    assert tuple(registry.scope_counts(ads).first()) == ("b", 3, 1, 2)
    tenants = spark.createDataFrame([("c", f"t{i}", i) for i in range(1, 7)], "company_id string, tenant string, t int")
    servers = spark.createDataFrame([(f"s{i}", i) for i in range(1, 12)], "server string, s int")
    assert registry.probe_plan(tenants, servers).count() == 2 * 11 + 2 * 4


def test_verdicts(spark):
    rows = spark.createDataFrame([("Sì ", True), ("partly", True), ("ok", False), ("no", False), ("??", True), (None, True)], "v string, found boolean")
    assert [r["x"] for r in rows.select(sampling.normal_verdict(F.col("v"), F.col("found")).alias("x")).collect()] == ["ok", "partial", "none", "missed", None, None]


def test_sources(spark):
    def ads(ats, body, **more):
        row = {"board": "b", "body": body, **more}
        return sources.parse(spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row)), ats).collect()

    green = ads("greenhouse", '{"jobs": [{"id": 7, "title": "Dev", "location": {"name": "Milan"}, "offices": [{"name": "HQ", "location": null}], "departments": [{"name": "IT"}, {"name": "R&D"}], "updated_at": "2026-07-01T00:00:00Z", "absolute_url": "u", "content": "&lt;p&gt;Hi&lt;/p&gt;"}, {"id": null}]}')
    assert len(green) == 1 and (green[0]["job_id"], green[0]["description"], green[0]["department"], green[0]["locations_all"]) == ("7", "Hi", "IT, R&D", ["HQ"])
    lev = ads("lever", '[{"id": "x", "text": "T", "categories": {"location": "Rome", "commitment": "Full-time"}, "createdAt": 1780000000000, "descriptionPlain": "A", "lists": [{"text": "B", "content": "<li>C</li>"}]}]')
    assert lev[0]["posted_at"].startswith("2026-05-28") and lev[0]["description"] == "A B C"
    ash = ads("ashby", '{"jobs": [{"id": "1", "title": "T", "isRemote": true, "compensation": {"compensationTierSummary": "€35K – €45K"}}]}')
    assert ash[0]["workplace_type"] == "Remote" and ash[0]["salary_structured"] == '"€35K – €45K"'
    rec = ads("recruitee", '{"offers": [{"id": 3, "title": "T", "hybrid": true, "salary": {"min": null, "max": null, "currency": "EUR"}}]}')
    assert rec[0]["workplace_type"] == "hybrid" and rec[0]["salary_structured"] is None
    per = ads("personio", "<workzag-jobs><position><id>9</id><name>Dev</name><office>Berlin</office></position><position><id>10</id><name>Ops</name></position></workzag-jobs>")
    assert [r["job_id"] for r in per] == ["9", "10"]
    team = ads("teamtailor", "<rss><channel><item><title>Dev</title><link>https://x.teamtailor.com/jobs/123-dev</link><guid>g</guid><pubDate>Tue, 07 Jul 2026 10:00:00 +0200</pubDate><tt:locations><tt:location><tt:city>Rome</tt:city><tt:country>Italy</tt:country></tt:location></tt:locations></item></channel></rss>")
    assert (team[0]["job_id"], team[0]["posted_at"], team[0]["location"]) == ("123", "2026-07-07", "Rome, Italy")
    sf = ads("successfactors", '<meta property="og:title" content="Dev"><meta itemprop="datePosted" content="Tue Jul 07 00:00:00 UTC 2026"><div itemprop="description"><div>A <b>b</b></div><p>c</p></div><div>other</div>', url="https://h/job/Rome-Dev/77/")
    assert (sf[0]["job_id"], sf[0]["title"], sf[0]["posted_at"], sf[0]["description"]) == ("77", "Dev", "2026-07-07", "A b c")
    assert sources.inner_html('<a id="x">1<br>2<i>3</i></a>4', "x") == "1<br>2<i>3</i>"
    work = ads("workable", '{"jobs": [{"shortcode": "S", "title": "T", "city": "Rome", "country": "Italy", "telecommuting": true}]}')
    assert (work[0]["location"], work[0]["workplace_type"]) == ("Rome, Italy", "remote")
    orc = ads("oracle", '{"items": [{"requisitionList": [{"Id": "5", "Title": "T", "PrimaryLocationCountry": "IT"}]}]}')
    assert orc[0]["job_id"] == "5"
    facets = spark.createDataFrame([("b", '{"facets": [{"descriptor": "x", "values": [{"descriptor": "Italy", "count": 3}, {"descriptor": "g", "values": [{"descriptor": "Italy", "count": 5}, {"descriptor": "Germany", "count": 2}]}]}]}')], "board string, body string")
    assert {(r["cc"], r["n"]) for r in sources.facet_counts(facets).collect()} == {("IT", 5), ("DE", 2)}
    none = spark.createDataFrame([("n", '{"facets": [{"descriptor": "x"}]}')], "board string, body string")
    assert {tuple(r) for r in sources.facet_totals(facets.unionByName(none)).collect()} == {("b", 5, 7), ("n", None, None)}
    page = '<meta itemprop="addressLocality" content="Roma"><meta itemprop="addressRegion" content="Lazio &amp; c"><meta itemprop="addressCountry" content="IT"><meta itemprop="employmentType" content="FULL"><span itemprop="title">Dev</span>'
    placed = ads("successfactors", page, url="https://h/job/Mantova-Dev/7/")[0]
    assert (placed["location"], placed["employment_type"], placed["title"]) == ("Roma, Lazio & c, IT", "FULL", "Dev")
    assert sf[0]["location"] == "Rome Dev"


def test_stream_of_snapshots(spark, tmp_path):
    from wagewright.streaming import snapshots

    schema = "board string, job_key string, ordinal int, ts timestamp, pay double"
    for i, rows in enumerate(([("a", "1", 1, "2026-01-01", 1.0), ("a", "2", 2, "2026-01-01", 2.0)], [("a", "2", 1, "2026-01-02", 3.0)], [("b", "9", 1, "2026-01-03", 7.0)])):
        data = spark.createDataFrame(rows, "board string, job_key string, ordinal int, ts string, pay double").withColumn("ts", F.col("ts").cast("timestamp"))
        data.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        snapshots.ingest(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(60)
    version = max(int(p.rsplit("v", 1)[1]) for p in glob.glob(str(tmp_path / "out" / "v*")))
    now = snapshots.stored_ads(spark, str(tmp_path / "out"), version)
    assert {(r["board"], r["job_key"], r["is_active"], r["pay"]) for r in now.collect()} == {("a", "1", 0, 1.0), ("a", "2", 1, 3.0), ("b", "9", 1, 7.0)}


def test_values_for_medians_are_shuffled_once(spark):
    """They are joined and put in order by the same key, and the ads aren't kept once they are summed up."""
    own = cube.Cube(random_ads(spark, 5, 300))
    found = own.cells()
    plan = own.medians()._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(slot#", plan) and not re.search(r"hashpartitioning\(cell#\d+L?, range#", plan)
    kept = glob.glob(f"{spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix('file:')}/ads-*")
    before = len(kept)
    assert found.where("ral_min_median is not null").count() > 0
    cube.Cube(random_ads(spark, 6, 300)).cells()
    assert len(glob.glob(f"{spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix('file:')}/ads-*")) == before
