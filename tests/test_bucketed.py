"""Bucketed tables: the same rows as without buckets, and no shuffle by the joins' keys."""

import collections

import pytest
from pyspark.sql import functions as F

from wagewright.bucketed import PART, copied, dealt, store
from wagewright.operators import views
from wagewright.plans import bucket_queries


@pytest.fixture
def shuffling(spark):
    """Joins that would shuffle if their sides' places didn't tell otherwise."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def counted(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_public_view_without_shuffle(spark, shuffling):
    # Company 1 has most ads; ads without a company, of an unknown one, and twice the same.
    jobs = spark.range(400).select(F.concat(F.lit("j"), F.col("id")).alias("job_key"), F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(1).cast("int").alias("company_id"), F.lit("L").alias("location_id"), F.when(F.col("id") % 2 == 0, "post_law").alias("posting_period"))
    jobs = jobs.unionByName(jobs.where("job_key in ('j4', 'j9')"))
    companies = spark.createDataFrame([(1, "one", "it"), (2, None, None), (5, "five", "x")], "company_id int, name string, sector string")
    locations = F.broadcast(spark.createDataFrame([("L", "north")], "location_id string, region string"))
    keys = ["company_id", PART]
    own = store(dealt(jobs, "job_key", 4), "jobs", keys, 6), store(copied(companies, 4), "companies", keys, 6)
    got, want = views.jobs_public(*own, locations, by=keys), views.jobs_public(jobs, companies, locations)
    assert got.columns == want.columns and counted(got) == counted(want) and got.count() == 402
    assert "hashpartitioning" in plan(want) and "hashpartitioning" not in plan(got) and "SortMergeJoin" in plan(got)
    hot = own[0].where("company_id = 1").groupBy(F.col(PART)).count().collect()
    assert len(hot) == 4 and max(r["count"] for r in hot) < 120


def test_sums_stay_in_buckets(spark, shuffling, tmp_path):
    orders = [(i, i % 30, i % 9) for i in range(200)]
    lines = [(i % 150, i % 60) for i in range(900)]
    names = {"o_orderkey": "long", "o_custkey": "long", "o_n": "long"}
    full = spark.createDataFrame(orders, ", ".join(f"{n} {t}" for n, t in names.items())).drop("o_n")
    extra = {c: F.lit("x") for c in ("o_orderpriority", "o_orderstatus")} | {"o_totalprice": F.lit(1.0), "o_orderdate": F.lit("1995-01-01").cast("timestamp")}
    full.withColumns(extra).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    out = bucket_queries.places_bucketed(spark, str(tmp_path))
    places = collections.defaultdict(set)
    for o, s in lines:
        places[o].add(f"L-{s % 25}")
    got = {int(r["job_key"].split("|")[1]): (r["n_locations"], r["first_location"]) for r in out.collect()}
    assert got == {o: (len(places[o]), min(places[o], default=None)) for o, _, _ in orders}
    assert "hashpartitioning" not in plan(out)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "job_key string, company_id int")
    out = store(dealt(empty, "job_key", 3), "none", ["company_id", PART], 4)
    assert out.count() == 0 and out.columns == ["job_key", "company_id", PART]
