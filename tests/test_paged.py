"""Lists in pages, read by the data source."""

import contextlib
import io
import json
import time

import pyarrow as pa
import pyarrow.parquet as pq

from wagewright.sources import ads, paged


def stored(spark, tmp_path, pages):
    path = str(tmp_path / "lists")
    paged.store_lists(spark.createDataFrame(pages, "board string, facet string, offset long, body string"), path)
    return path


def listing(names, total=None, place="Milano"):
    return json.dumps({"total": len(names) if total is None else total, "jobPostings": [{"externalPath": f"/job/{n}", "title": n, "locationsText": place} for n in names]})


def test_pages_are_followed_to_the_end_or_the_cap(spark, tmp_path):
    names = [f"j{i}" for i in range(50)]
    pages = [("https://a/b", "IT", k, listing(names[k : k + 20], 50)) for k in (0, 20, 40)]
    pages += [("c", "DE", 0, listing(names[:20], 60)), ("c", "DE", 40, listing(["lost"], 60))]  # a page is missing: the list ends there
    pages += [("c", None, 0, listing(["x"], 21, "Zurich")), ("c", None, 20, listing(["y", "z"], 22, "3 Locations")), ("d", "IT", 0, listing([])), ("e", "IT", 0, None)]
    path = stored(spark, tmp_path, pages)
    all_of = paged.board_lists(spark, path, "workday")
    got = {(r["board"], r["facet"], json.loads(r["posting"])["title"]) for r in all_of.collect()}
    assert got == {("https://a/b", "IT", n) for n in names} | {("c", "DE", n) for n in names[:20]} | {("c", None, "y"), ("c", None, "z")}
    capped = paged.board_lists(spark, path, "workday", cap=1)
    assert {(r["board"], r["facet"], r["ordinal"]) for r in capped.collect()} == {("https://a/b", "IT", 0), ("c", "DE", 0), ("c", None, 20)}


def test_conditions_reach_the_plan_of_the_partitions(spark, tmp_path):
    path = stored(spark, tmp_path, [(b, f, 0, listing(["x"])) for b in "abc" for f in ("IT", "DE", None)])
    some = paged.board_lists(spark, path, "workday").where("facet = 'IT' and board in ('a', 'b') and ordinal < 5")
    assert some.rdd.getNumPartitions() == 2 and some.count() == 2
    told = io.StringIO()
    with contextlib.redirect_stdout(told):
        some.explain()
    assert "Filter" in told.getvalue() and "facet = IT" not in told.getvalue().split("Scan")[0].replace("#", "")
    reader = paged.ListReader({"path": path})
    assert [str(f) for f in reader.pushFilters([paged.EqualTo(("facet",), "IT"), paged.EqualTo(("ordinal",), 1), paged.In(("facet",), ("IT", "DE"))])] == [str(paged.EqualTo(("ordinal",), 1))]
    assert {(p.board, p.facet) for p in reader.partitions()} == {(b, "IT") for b in "abc"}


def test_an_ad_in_two_countries_counts_once(spark, tmp_path):
    path = stored(spark, tmp_path, [("b", "IT", 0, listing(["x", "y"])), ("b", "DE", 0, listing(["x"])), ("b", "FR", 0, listing(["no details"]))])
    info = lambda n: json.dumps({"jobPostingInfo": {"jobReqId": n.upper(), "location": "Roma", "additionalLocations": ["Bonn"]}})
    details = spark.createDataFrame([("b", f"/job/{n}", info(n)) for n in "xy"], "board string, path string, body string")
    got = ads.workday_postings(paged.board_lists(spark, path, "workday"), details)
    assert {(r["job_id"], r["title"], r["location"], tuple(r["locations_all"])) for r in got.collect()} == {(n.upper(), n, "Roma", ("Roma", "Bonn")) for n in "xy"}


def test_oracle(spark, tmp_path):
    page = lambda ids, total: json.dumps({"items": [{"TotalJobsCount": total, "requisitionList": [{"Id": i, "Title": f"t{i}", "PrimaryLocationCountry": "IT" if i % 2 else "US"} for i in ids]}]})
    path = stored(spark, tmp_path, [("h", None, k, page(range(k, k + 25), 60)) for k in (0, 25)] + [("h", None, 50, page(range(50, 60), 60))])
    details = spark.createDataFrame([("h", "1", json.dumps({"items": [{"ExternalDescriptionStr": "<p>one</p>"}]}))], "board string, job_id string, body string")
    got = {r["job_id"]: r["description"] for r in ads.oracle_postings(paged.board_lists(spark, path, "oracle"), details).collect()}
    assert got == {str(i): "one" if i == 1 else "" for i in range(1, 60, 2)}


def test_pages_out_of_order_and_in_several_files(spark, tmp_path):
    pages = [("a", "IT", k, listing([f"{k + i}" for i in range(20)], 200)) for k in range(0, 200, 20)]
    path = str(tmp_path / "lists")
    for some in (pages[5:] + pages[:2], pages[1:5]):  # a page comes twice
        spark.createDataFrame(some, "board string, facet string, offset long, body string").coalesce(1).write.mode("append").partitionBy("board", "facet").parquet(path)
    got = [json.loads(r["posting"])["title"] for r in paged.board_lists(spark, path, "workday").orderBy("ordinal").collect()]
    assert got == [str(i) for i in range(200)]


def test_a_list_is_read_once(tmp_path):
    """A long list takes as many reads of its file as it has batches, not one for each page."""
    (tmp_path / "board=a" / "facet=IT").mkdir(parents=True)
    n = 4000
    pages = pa.table({"offset": range(0, 20 * n, 20), "body": [listing([f"{k}"], 20 * n) for k in range(n)]})
    pq.write_table(pages, tmp_path / "board=a" / "facet=IT" / "p.parquet")
    reader = paged.ListReader({"path": str(tmp_path)})
    began = time.process_time()
    assert len(list(reader.read(reader.partitions()[0]))) == n
    assert time.process_time() - began < 4
