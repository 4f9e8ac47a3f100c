"""The test tables seen as the engine's own tables.

Each view is one SELECT in SQL that Spark and DuckDB both read, so a query's oracle starts from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

VIEWS = {
    "ads": """
        SELECT concat(l_orderkey, '|', l_partkey, '|', l_linenumber) AS job_key, l_suppkey AS company_id, r_name AS country, c_mktsegment AS macro_sector,
          CASE WHEN l_shipdate >= TIMESTAMP '1998-06-07 00:00:00' THEN 'post_law' WHEN l_orderkey % 7 = 0 THEN NULL
            WHEN l_shipdate >= TIMESTAMP '1997-06-07 00:00:00' THEN 'pre_law' ELSE 'old' END AS posting_period,
          n_name AS region, p_type AS job_function, CASE WHEN l_linenumber = 7 THEN NULL ELSE o_orderpriority END AS seniority, l_linestatus AS contract_type,
          CASE l_returnflag WHEN 'A' THEN 'onsite' WHEN 'N' THEN 'hybrid' ELSE 'field' END AS workplace_type,
          CASE l_linenumber % 3 WHEN 0 THEN 'figure' WHEN 1 THEN 'vague' ELSE 'none' END AS salary_transparency,
          CASE WHEN l_orderkey % 3 <> 0 THEN l_extendedprice * (1 - l_discount) END AS ral_min_annual,
          CASE WHEN l_orderkey % 3 <> 0 AND l_orderkey % 5 <> 0 THEN l_extendedprice END AS ral_max_annual
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
          JOIN region ON r_regionkey = n_regionkey JOIN part ON p_partkey = l_partkey""",
    "companies": """
        SELECT s_suppkey AS company_id, s_name AS name, CASE s_suppkey % 7 WHEN 0 THEN 'banks' WHEN 1 THEN 'it_consulting' WHEN 2 THEN 'telco' WHEN 3 THEN 'automotive' WHEN 4 THEN 'retail' WHEN 5 THEN n_name END AS sector, CASE s_suppkey % 3 WHEN 0 THEN NULL ELSE s_suppkey % 2 END AS is_tech, s_acctbal AS size
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "locations": """
        SELECT concat('L-', n_nationkey) AS location_id, n_name AS city, r_name AS region, concat('P', n_nationkey % 5) AS province,
          CASE WHEN n_nationkey % 2 = 0 THEN 'north' ELSE 'south' END AS macro_area, n_nationkey * 12345 AS population
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "jobs": """
        SELECT concat('board', o_custkey % 10, '|', o_orderkey) AS job_key, o_custkey % 50 AS company_id, concat('L-', o_custkey % 25) AS location_id,
          concat(o_orderpriority, ' role ', o_orderstatus) AS title, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE concat('text ', o_custkey) END AS description,
          CASE WHEN o_orderkey % 4 <> 0 THEN 1 ELSE 0 END AS is_active, CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS is_remote,
          CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'post_law' WHEN 2 THEN 'pre_law' ELSE 'old' END AS posting_period,
          CASE o_orderkey % 3 WHEN 0 THEN 'figure' WHEN 1 THEN 'vague' ELSE 'none' END AS salary_transparency,
          CASE o_orderkey % 3 WHEN 0 THEN o_totalprice END AS ral_min_annual, CASE WHEN o_orderkey % 6 = 0 THEN o_totalprice + 5000 END AS ral_max_annual,
          CASE WHEN o_orderkey % 8 = 0 THEN NULL WHEN o_custkey % 3 = 0 THEN 'Germany' WHEN o_custkey % 3 = 1 THEN 'France' ELSE 'Italy' END AS country, o_orderdate AS first_seen, o_orderdate AS last_seen,
          CASE o_custkey % 4 WHEN 0 THEN 'data' WHEN 1 THEN 'hr' ELSE 'sales' END AS job_function, lower(o_orderpriority) AS seniority, CASE o_custkey % 5 WHEN 0 THEN 'not_stated' WHEN 1 THEN NULL ELSE 'title' END AS seniority_source,
          CASE WHEN o_orderkey % 7 < 3 THEN 'permanent' END AS contract_type, CASE o_custkey % 3 WHEN 0 THEN 'onsite' WHEN 1 THEN 'hybrid' ELSE 'other' END AS workplace_type,
          concat('raw ', o_custkey) AS location_raw, concat('pay phrase ', o_orderkey) AS salary_text_matches, concat('hash ', o_orderkey) AS content_hash
        FROM orders""",
    "job_locations": """
        SELECT DISTINCT concat('board', o_custkey % 10, '|', o_orderkey) AS job_key, concat('L-', l_suppkey % 25) AS location_id
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
    "ats_registry": """
        SELECT s_suppkey AS company_id, s_name AS company, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_nationkey % 2 END AS is_tech,
          CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE CASE s_suppkey % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'alpha' WHEN 2 THEN 'beta' ELSE 'gamma' END END AS ats,
          CASE WHEN s_suppkey % 4 IN (1, 2) THEN 1 ELSE 0 END AS supported,
          CASE s_suppkey % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS confidence,
          CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE concat(CASE WHEN s_suppkey % 2 = 0 THEN ' Slug' ELSE 'slug' END, s_suppkey % 40) END AS slug
        FROM supplier""",
    "searches": """
        SELECT event_id AS search_id, event_type AS search_term, CASE WHEN user_id % 2 = 0 THEN NULL ELSE concat('u', user_id % 10) END AS location, ts AS run_at,
          CAST(floor(value) AS BIGINT) AS n_jobs, user_id AS n_companies, CAST(floor(value / 2) AS BIGINT) AS n_jobs_with_salary,
          CAST(floor(value / 4) AS BIGINT) AS n_jobs_vague, value * 100 AS ral_min_median, value * 120 AS ral_max_median
        FROM events""",
    "snapshots": """
        SELECT event_type AS board, concat(event_type, '|', user_id) AS job_key, CAST(CAST(ts AS DATE) AS STRING) AS day, min(event_id) AS ordinal, max(value) AS pay
        FROM events GROUP BY event_type, user_id, CAST(CAST(ts AS DATE) AS STRING)""",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, or one of the views over them."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = VIEWS[name]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f" {t} " in f"{sql} ".replace("\n", " ")}
    for table in tables:
        sql = sql.replace(f"FROM {table}", f"FROM {{{table}}}").replace(f"JOIN {table} ", f"JOIN {{{table}}} ")
    return spark.sql(sql, **tables)


def with_views(*names: str) -> str:
    """The views as the beginning of a WITH clause, for oracles."""
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)
