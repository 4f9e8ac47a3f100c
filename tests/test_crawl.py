"""From files and raw ads to stored ads and exports."""

import glob
import json

from pyspark.sql import functions as F

from wagewright.functions import rules
from wagewright.operators import publish
from wagewright.plans import crawl
from wagewright.schema import JOBS, conform, fields, labelled
from wagewright.sources import files

RAW = "ats string, board string, job_id string, title string, location string, locations_all array<string>, country string, department string, employment_type string, workplace_type string, posted_at string, url string, description string, salary_structured string"
PLACES = "location_id string, city string, region string, region_code string, country_code string, population long"


def test_files(spark, tmp_path):
    (tmp_path / "seed.csv").write_text("name,website,is_tech,sector\nAcme S.p.A.,https://a.it,1,banks\n  ,x,1,y\nBeta,,x,\n", encoding="utf-8")
    rows = files.companies(spark, str(tmp_path / "seed.csv")).collect()
    assert {(r["company_id"], r["is_tech"]) for r in rows} == {("acme-spa", 1), ("beta", 0)}
    (tmp_path / "over.csv").write_text("company,ats\nBeta,lever\nbeta,ashby\n", encoding="utf-8")
    assert [r["ats"] for r in files.overrides(spark, str(tmp_path / "over.csv")).collect()] == ["ashby"]
    cells = lambda **k: ";".join(str(k.get(f"c{i}", "")) for i in range(16))
    (tmp_path / "it.csv").write_text("\n".join(["head;" * 15, cells(c0="03", c4="015146", c6="Milano", c9="Nord", c10="Lombardia", c11="Milano", c13="1", c14="MI"), "short;row"]), encoding="utf-8")
    (tmp_path / "pop.json").write_text(json.dumps([{"codice": "015146", "popolazione": 1300000}]), encoding="utf-8")
    place = files.italian_municipalities(spark, str(tmp_path / "it.csv"), str(tmp_path / "pop.json")).collect()
    assert [(r["location_id"], r["city_size_band"], r["is_capoluogo"]) for r in place] == [("IT-015146", "metro", 1)]
    units = spark.createDataFrame([("DE", "DE111", "08111", "Stuttgart, Landeshauptstadt", None, 630000), ("DE", None, "1", "x", "x", 1)], "country_code string, nuts3 string, lau_code string, name_latin string, name string, population long")
    regions = spark.createDataFrame([("DE1", None, "Baden-Württemberg", None, None)], "code string, n1 string, n2 string, n3 string, n4 string")
    city = files.european_municipalities(units, regions).collect()
    assert [(r["location_id"], r["city"], r["region"], r["region_code"]) for r in city] == [("DE-08111", "Stuttgart", "Baden-Württemberg", "DE1")]
    (tmp_path / "sample.csv").write_bytes("﻿url;giudizio;salary_min\n".encode() + b"u1;s\xec;1\r\nu2;;2\n")
    sample = files.labelled_sample(spark, str(tmp_path / "sample.csv"))
    assert {tuple(r) for r in sample.select("url", "verdict", "salary_min").collect()} == {("u1", "sì", "1"), ("u2", None, "2")}
    jobs = spark.createDataFrame([("u1", "k", 9.0), ("u2", "k", 8.0)], "url string, job_key string, salary_min double")
    assert {tuple(r) for r in files.refresh(sample, jobs, ["salary_min"]).select("url", "salary_min").collect()} == {("u1", "1"), ("u2", "8.0")}


def test_crawl(spark):
    gazetteer = spark.createDataFrame([("IT-1", "Milano", "Lombardia", "03", "IT", 1300000), ("IT-2", "Roma", "Lazio", "12", "IT", 2700000)], PLACES)
    ad = lambda i, title, **k: ("lever", "b", i, title, k.get("location"), k.get("all"), k.get("country"), None, None, k.get("workplace"), k.get("posted"), "u", k.get("text"), None)
    raw = spark.createDataFrame([
        ad("1", "Senior Data Analyst", location="Milan", all=["Rome, Italy", "Milan"], posted="2026-07-01", text="Si offre RAL 35.000 - 40.000 €. Scrivi a x@y.it"), ad("2", "Candidatura spontanea", location="Milano"),
        ad("3", "Cook", location="London"), ad("4", "Intern", country="IT", text="rimborso 1.000 € al mese"), ad("", "No id", location="Milano"),
    ], RAW)
    boards = spark.createDataFrame([("b", "acme")], "board string, company_id string")
    known = spark.createDataFrame([("lever|b|1", "2026-06-30")], "job_key string, first_seen string")
    jobs, children = crawl.build(raw, boards, gazetteer, known, "2026-10-01")
    assert [f.name for f in jobs.schema] == [f.name for f in fields(JOBS)] and len(jobs.columns) == 45
    one = {r["job_id"]: r for r in jobs.collect()}
    assert set(one) == {"1", "4"}
    a, b = one["1"], one["4"]
    assert (a["location_id"], a["n_locations"], a["seniority"], a["job_function"], a["posting_period"], a["ral_min_annual"], a["first_seen"]) == ("IT-1", 3, "senior", "data", "post_law", 35000, "2026-06-30")
    assert "[email]" in a["description"] and a["salary_transparency"] == "figure"
    assert (b["location_id"], b["seniority"], b["ral_min_annual"], b["first_seen"]) == ("IT", "intern", 12000, "2026-10-01")
    assert {(r["job_key"], r["location_raw"], r["location_id"]) for r in children.collect()} == {("lever|b|1", "Milan", "IT-1"), ("lever|b|1", "Rome, Italy", "IT-2")}
    again = {r["job_id"]: r for r in crawl.reprocess(jobs).collect()}
    assert again["1"]["ral_min_annual"] == 35000 and again["4"]["seniority"] == "intern"
    kept, places = crawl.save(jobs, children, jobs.limit(0), children.limit(0))
    assert kept.count() == 2 and places.count() == 2


def test_sinks(spark, tmp_path):
    cells = spark.createDataFrame([("all", 5, None)], "period string, n_jobs int, ral_min_median double")
    publish.aggregates(cells, str(tmp_path))
    whole = "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(str(tmp_path / "aggregates.json" / "part-*"))))
    assert json.loads(whole) == [{"period": "all", "n_jobs": 5, "ral_min_median": None}]
    publish.publish(cells.unionByName(cells), {"a": 1}, str(tmp_path / "site"))
    back, header, shown = publish.read_published(spark, str(tmp_path / "site"))
    assert back.count() == 2 and header == {"a": 1} and shown["region"]["Remote"] == "Remote" and "sector" not in shown
    assert spark.read.csv(str(tmp_path / "aggregates.csv"), header=True).count() == 1
    publish.load_files({"jobs": spark.createDataFrame([("k", "text")], "job_key string, description string")}, str(tmp_path / "load"))
    assert spark.read.json(str(tmp_path / "load" / "jobs")).columns == ["job_key"]
    counts = spark.createDataFrame([("2026-01-01T00", "2026-02-01T00", 3, 2)], "observed_from string, last_update string, n_jobs_active long, n_companies_active long")
    head = publish.meta(counts, 9)
    publish.write_text(spark, str(tmp_path / "meta"), head)
    assert json.loads(spark.read.text(str(tmp_path / "meta")).first()["value"]) == head and head["last_update"] == "2026-02-01"
    publish.sample_csv(cells, str(tmp_path / "s"))
    assert open(glob.glob(str(tmp_path / "s" / "part-*"))[0], "rb").read().startswith(b"\xef\xbb\xbf")
    try:
        publish.sample_csv(cells, str(tmp_path / "s"))
        raise AssertionError("a sample was overwritten")
    except Exception as e:
        assert "already exists" in str(e).lower() or "PATH_ALREADY_EXISTS" in str(e)
    publish.registry_csv(spark.createDataFrame([("a", 0), ("b", 1)], "company string, is_tech int"), str(tmp_path / "r"))
    publish.copy_tables({"t": cells}, str(tmp_path / "copy"))
    assert spark.read.parquet(str(tmp_path / "copy" / "t")).count() == 1
    assert publish.labels()["workplace_type"]["onsite"] == "On site"


def test_schema(spark):
    row = conform(spark.createDataFrame([("k", 1)], "job_key string, extra int"), "job_locations")
    assert row.columns == ["job_key", "location_id", "location_raw"]
    shown = labelled(spark.createDataFrame([("onsite",), (None,), ("odd",)], "workplace_type string"), "workplace_type")
    assert [r["label"] for r in shown.collect()] == ["On site", "not_stated", "odd"]
    assert shown.where(F.col("label").isNull()).count() == 0


def test_a_text_is_normalised_once_for_all_rules(spark):
    """However many rules look at a text, and whichever of them comes first."""
    rows = spark.createDataFrame([("Senior Data Engineer", "tempo indeterminato. smart working", "remote", "Milano")], "t string, d string, w string, l string")
    t, d = F.col("t"), F.col("d")
    found = {"contract": rules.contract_type(F.lit(None).cast("string"), t, d), "schedule": rules.work_schedule(F.lit(None).cast("string"), t, d), "function": rules.job_function(t), "place": rules.workplace_with_source(F.col("w"), F.col("l"), d, t)}
    times = {k: rows.select(v.alias("x"))._jdf.queryExecution().optimizedPlan().toString().count("[^a-z0-9]+") for k, v in found.items()}
    assert all(n <= 3 for n in times.values()), times
    got = rows.select(*(v.alias(k) for k, v in found.items())).first()
    assert (got["contract"], got["schedule"], got["function"], tuple(got["place"])) == ("permanent", None, "data", ("remote", "ats"))
