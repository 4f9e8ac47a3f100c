"""Medians by selection against sorted lists."""

import random
import statistics

import pytest

from wagewright.operators import cube, search, selection


@pytest.mark.parametrize(("rounds", "ranges"), [(0, 1), (1, 3), (2, 1024), (3, 2)])
def test_medians(spark, rounds, ranges):
    rng = random.Random(5)
    groups = {"one": [7.0], "two": [1.0, 4.0], "ties": [5.0] * 40 + [9.0] * 40, "far": [1e15, *(rng.random() for _ in range(101))], "none": [None, None], "below": [-3.5, None, 2.0, -1e9], None: [rng.choice([1.0, 2.0, 3.0]) for _ in range(30)]}
    rows = [(k, v, None if v is None or v > 3 else v * 2, "x") for k, own in groups.items() for v in own]
    frame = spark.createDataFrame(rows, "g string, a double, b double, v string")
    got = {r["g"]: (r["a"], r["b"]) for r in selection.medians(frame, ["g"], ["a", "b"], rounds, ranges).collect()}
    of = lambda own: statistics.median(own) if own else None
    want = {k: (of([r[1] for r in rows if r[0] == k and r[1] is not None]), of([r[2] for r in rows if r[0] == k and r[2] is not None])) for k in groups}
    assert got == {k: v for k, v in want.items() if v != (None, None)}


def test_summaries_of_nothing_and_without_pay(spark):
    frame = spark.createDataFrame([("a", "none", None, None)], "company string, salary_transparency string, ral_min_annual double, ral_max_annual double")
    (row,) = search.summary(frame.limit(0)).collect()
    assert (row["n_jobs"], row["n_companies"], row["ral_min_median"]) == (0, 0, None)
    assert [(r["company"], r["n_jobs"], r["ral_min_median"]) for r in search.by_company(frame).collect()] == [("a", 1, None)]
    for made in (search.summary(frame), search.by_company(frame)):
        assert "percentile" not in made._jdf.queryExecution().toString()


def test_large_companies_and_ranges_are_dealt_out(spark, monkeypatch):
    """A company, or a range of pay, with more rows than a task takes gives the same cells."""
    rng = random.Random(6)
    pick = lambda *own: rng.choice(own)
    rows = [(pick("big", "big", "a", "b"), pick("IT", "DE"), pick("x", "y"), pick("post_law", "old"), "r", pick("f", "g"), None, "c", pick("onsite", "odd"), pick("figure", "none"), pick(None, 30000.0, 30100.0, float(rng.randint(20, 60) * 1000)), None) for _ in range(300)]
    ads = spark.createDataFrame(rows, "company_id string, country string, macro_sector string, posting_period string, region string, job_function string, seniority string, contract_type string, workplace_type string, salary_transparency string, ral_min_annual double, ral_max_annual double")
    cells = lambda: {tuple(r) for r in cube.cells(ads, ["total", "country"]).collect()}
    want = cells()
    monkeypatch.setattr(cube, "HOT_ROWS", 2)
    assert cells() == want and len(want) > 100
    own = cube.Cube(ads, ["total"])
    own.by_company()
    assert "big" in own.large and own.columns == list(cube.AXES.values())
