"""Queries over boards' answers: the test tables are rendered as each system would give them, and read again.

An answer of a board holds the orders of one customer. What the parsers should find is said by the same columns of
orders in SQL, so the SQL knows nothing of the formats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.adapters import load
from wagewright.plans import crawl
from wagewright.plans.queries import query
from wagewright.sources import ads, paged
from wagewright.stores import step_path, written

#: What an ad says, by columns of orders; read by Spark and DuckDB alike.
ORDERS = """SELECT concat('c', o_custkey) AS board, o_custkey AS c, o_orderkey AS k, concat(o_orderpriority, ' role') AS title, CASE o_orderkey % 4 WHEN 0 THEN 'Milano' WHEN 1 THEN 'Roma' WHEN 2 THEN 'Bonn' ELSE 'Paris' END AS city,
  CASE o_orderkey % 4 WHEN 2 THEN 'DE' WHEN 3 THEN 'FR' ELSE 'IT' END AS cc, CASE WHEN o_orderkey % 3 <> 0 THEN concat('Team ', o_custkey % 9) END AS team, CAST(o_custkey % 900 * 100 + 20000 AS BIGINT) AS pay,
  substr(CAST(o_orderdate AS STRING), 1, 10) AS day, concat('https://x.org/jobs/', o_orderkey) AS url, concat('Text of ', o_orderkey, ' & more') AS said, CASE o_orderkey % 5 WHEN 0 THEN 'remote' WHEN 1 THEN 'hybrid' WHEN 2 THEN 'onsite' END AS place_mode FROM orders"""
FIELDS = ("board", "job_id", "title", "location", "places", "country", "department", "employment_type", "workplace_type", "posted_at", "url", "description", "salary_structured")


def expected(**fields: str) -> str:
    """The SQL of an oracle: each field by columns of ORDERS, NULL where a system doesn't say."""
    own = {"board": "board", "job_id": "CAST(k AS VARCHAR)", "title": "title"} | fields
    return f"WITH o AS ({ORDERS}) SELECT " + ", ".join(f"CAST({own.get(c, 'NULL')} AS VARCHAR) AS {c}" for c in FIELDS) + " FROM o"


def told(raw: DataFrame) -> DataFrame:
    return raw.withColumn("places", F.array_join("locations_all", "|")).select(*FIELDS)


def rendered(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """sql over o, the columns of ORDERS."""
    orders = spark.sql(ORDERS.replace("FROM orders", "FROM {orders}"), orders=load(spark, sf_dir, "orders"))
    return spark.sql(sql, o=orders)


def system(name: str, about: str, body: str, **fields: str) -> None:
    """A query of a system's parser over answers (``body``: an aggregate over a board's orders)."""

    @query(f"board_{name}", expected(**fields))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return told(ads.parse(rendered(spark, sf_dir, f"SELECT board, {body} AS body FROM {{o}} GROUP BY board"), name))

    run.__doc__ = about


def listed(*fields: str) -> str:
    return f"collect_list(named_struct({', '.join(fields)}))"


system("greenhouse", "S9.", "to_json(struct(" + listed(
    "'id', k", "'title', title", "'location', named_struct('name', city)", "'offices', array(named_struct('name', 'HQ', 'location', CASE WHEN k % 2 = 0 THEN city END))", "'departments', CASE WHEN team IS NOT NULL THEN array(named_struct('name', team), named_struct('name', 'All')) END",
    "'first_published', CASE WHEN k % 3 <> 0 THEN concat(day, 'T00:00:00Z') END", "'updated_at', 'updated'", "'absolute_url', url", "'content', concat('&lt;p&gt;', replace(said, '&', '&amp;amp;'), '&lt;/p&gt;')",
) + " AS jobs))", location="city", places="CASE WHEN k % 2 = 0 THEN city ELSE 'HQ' END", department="team || ', All'", posted_at="CASE WHEN k % 3 <> 0 THEN day || 'T00:00:00Z' ELSE 'updated' END", url="url", description="replace(said, '&', '&amp;')")

system("lever", "S10.", "to_json(" + listed(
    "'id', CAST(k AS STRING)", "'text', title", "'categories', named_struct('location', city, 'allLocations', array(city, 'Torino'), 'department', team, 'team', 'T', 'commitment', 'Full time')", "'country', cc", "'workplaceType', place_mode",
    "'createdAt', unix_millis(CAST(day AS TIMESTAMP))", "'hostedUrl', url", "'descriptionPlain', concat(said, '\\n\\n ')", "'lists', array(named_struct('text', 'You', 'content', '<li>a</li>'))", "'additionalPlain', 'end'", "'salaryRange', named_struct('min', pay, 'max', pay + 5000, 'currency', 'EUR', 'interval', 'per-year-salary')",
) + ")", location="city", places="city || '|Torino'", country="cc", department="coalesce(team, 'T')", employment_type="'Full time'", workplace_type="place_mode", posted_at="day || 'T00:00:00Z'", url="url", description="said || ' You a end'",
    salary_structured="""'{"min":' || pay || ',"max":' || (pay + 5000) || ',"currency":"EUR","interval":"per-year-salary"}'""")

system("ashby", "S11.", "to_json(struct(" + listed(
    "'id', CAST(k AS STRING)", "'title', title", "'location', city", "'secondaryLocations', array(named_struct('location', 'Torino'), named_struct('location', city))", "'address', named_struct('postalAddress', named_struct('addressCountry', cc))", "'department', team", "'employmentType', 'FullTime'",
    "'workplaceType', CASE WHEN k % 5 <> 0 THEN place_mode END", "'isRemote', k % 5 = 0", "'publishedAt', day", "'jobUrl', url", "'descriptionPlain', said", "'compensation', CASE WHEN k % 2 = 0 THEN named_struct('scrapeableCompensationSalarySummary', concat('€', pay)) END",
) + " AS jobs))", location="city", places="'Torino|' || city", country="cc", department="team", employment_type="'FullTime'", workplace_type="CASE WHEN k % 5 = 0 THEN 'Remote' ELSE place_mode END", posted_at="day", url="url", description="said", salary_structured="CASE WHEN k % 2 = 0 THEN '\"€' || pay || '\"' END")

system("workable", "S13.", "to_json(struct(" + listed(
    "'shortcode', CAST(k AS STRING)", "'title', title", "'city', city", "'state', CASE WHEN k % 3 = 0 THEN 'S' END", "'country', cc", "'locations', array(named_struct('city', city, 'region', 'R', 'country', cc))", "'department', team", "'employment_type', 'Full'", "'telecommuting', k % 5 = 0",
    "'published_on', day", "'url', url", "'description', concat('<p>', said, '</p>')",
) + " AS jobs))", location="city || CASE WHEN k % 3 = 0 THEN ', S' ELSE '' END || ', ' || cc", places="city || ', R, ' || cc", country="cc", department="team", employment_type="'Full'", workplace_type="CASE WHEN k % 5 = 0 THEN 'remote' END", posted_at="day", url="url", description="said")

system("recruitee", "S15.", "to_json(struct(" + listed(
    "'id', k", "'title', title", "'location', city", "'locations', array(named_struct('name', CASE WHEN k % 2 = 0 THEN 'N' END, 'city', city, 'country', cc))", "'country_code', cc", "'department', team", "'employment_type_code', 'fulltime'", "'remote', k % 5 = 0", "'hybrid', k % 5 <= 1", "'on_site', k % 5 <= 2",
    "'published_at', day", "'careers_url', url", "'description', concat('<p>', said, '</p>')", "'requirements', '<b>Req</b>'", "'salary', CASE WHEN k % 2 = 0 THEN named_struct('min', CAST(pay AS STRING), 'currency', 'EUR', 'period', 'year') END",
) + " AS offers))", location="city", places="CASE WHEN k % 2 = 0 THEN 'N' ELSE city || ', ' || cc END", country="cc", department="team", employment_type="'fulltime'", workplace_type="place_mode", posted_at="day", url="url", description="said || ' Req'",
    salary_structured="""CASE WHEN k % 2 = 0 THEN '{"min":' || pay || '.0,"currency":"EUR","period":"year"}' END""")

system("personio", "S14.", "concat('<workzag-jobs>', array_join(collect_list(concat('<position><id>', k, '</id><name>', title, '</name><office>', city, '</office><additionalOffices><office>Torino</office><office>Lyon</office></additionalOffices>', CASE WHEN team IS NOT NULL THEN concat('<department>', team, '</department>') ELSE '' END, "
    "'<employmentType>permanent</employmentType><schedule>full-time</schedule><createdAt>', day, '</createdAt><jobDescriptions><jobDescription><name>Role</name><value><![CDATA[<p>', said, '</p>]]></value></jobDescription></jobDescriptions></position>')), ''), '</workzag-jobs>')",
    location="city", places="'Torino|Lyon'", department="team", employment_type="'permanent full-time'", posted_at="day", description="'Role ' || said")

system("teamtailor", "S17.", "concat('<rss xmlns:tt=\"https://t\"><channel>', array_join(collect_list(concat('<item><title>', title, '</title><link>', url, '-x</link><guid>g', k, '</guid><pubDate>', date_format(CAST(day AS DATE), 'EEE, dd MMM yyyy'), ' 08:00:00 +0000</pubDate><description>&lt;p&gt;', replace(said, '&', '&amp;amp;'), '&lt;/p&gt;</description>"
    "<remoteStatus>', coalesce(place_mode, 'none'), '</remoteStatus>', CASE WHEN team IS NOT NULL THEN concat('<tt:department>', team, '</tt:department>') ELSE '' END, '<tt:locations><tt:location><tt:name>N</tt:name><tt:city>', city, '</tt:city><tt:country>', cc, '</tt:country></tt:location></tt:locations></item>')), ''), '</channel></rss>')",
    location="city || ', ' || cc", places="city || ', ' || cc", department="team", workplace_type="coalesce(place_mode, 'none')", posted_at="day", url="url || '-x'", description="said")


@query("board_successfactors", expected(board="'https://career.x.org'", location="city || ', ' || cc", country="cc", employment_type="'Full'", posted_at="day", url="'https://career.x.org/job/' || city || '/' || k || '/'", description="said || ' nested end'"))
def board_successfactors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of ads with nested elements in the text."""
    body = """SELECT 'https://career.x.org' AS board, concat('https://career.x.org/job/', city, '/', k, '/') AS url, concat('<meta itemprop="addressLocality" content="', city, '"><meta itemprop="addressCountry" content="', cc, '"><meta itemprop="employmentType" content="Full"><meta itemprop="datePosted" content="',
      date_format(CAST(day AS DATE), 'EEE MMM dd'), ' 00:00:00 UTC ', substr(day, 1, 4), '"><span itemprop="title">', title, '</span><span class="jobdescription" itemprop="description"><p>', replace(said, '&', '&amp;'), '</p><span>nested</span><br> end</span><span>after</span>') AS body FROM {o}"""
    return told(ads.parse(rendered(spark, sf_dir, body), "successfactors"))


@query("board_sitemaps", f"WITH o AS ({ORDERS}) SELECT 'https://s' || c || '.example.org' AS board, 'https://s' || c || '.example.org/job/' || city || '/' || k || '/?a=1&b=2' AS url FROM o WHERE k % 6 <> 0")
def board_sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first map, two nested ones, one on another host, and open applications."""
    home = "concat('https://s', c, '.example.org')"
    loc = f"concat('<url><loc>', {home}, '/job/', CASE WHEN k % 6 = 0 THEN 'Spontaneous-application' ELSE city END, '/', k, '/?a=1&amp;b=2</loc></url>')"
    docs = f"""SELECT {home} AS board, concat({home}, '/sitemap.xml') AS url, concat('<sitemapindex><sitemap><loc>', {home}, '/m0.xml</loc></sitemap><sitemap><loc>https://else.org/m2.xml</loc></sitemap></sitemapindex>') AS body FROM {{o}} GROUP BY c
      UNION ALL SELECT {home}, concat({home}, '/m0.xml'), concat('<sitemap><loc>', {home}, '/m1.xml</loc></sitemap><sitemap><loc>', {home}, '/m0.xml</loc></sitemap>', array_join(collect_list({loc}), '')) FROM {{o}} WHERE k % 2 = 0 GROUP BY c
      UNION ALL SELECT {home}, concat({home}, '/m1.xml'), array_join(collect_list({loc}), '') FROM {{o}} WHERE k % 2 = 1 GROUP BY c
      UNION ALL SELECT {home}, 'https://else.org/m2.xml', '<loc>https://else.org/job/x/1/</loc>' FROM {{o}} GROUP BY c"""
    # Every board needs its even map for the odd one to be reached: boards without even orders get an empty one.
    lone = f"SELECT {home} AS board, concat({home}, '/m0.xml') AS url, concat('<sitemap><loc>', {home}, '/m1.xml</loc></sitemap>') AS body FROM {{o}} GROUP BY c HAVING count_if(k % 2 = 0) = 0"
    both = rendered(spark, sf_dir, docs).unionByName(rendered(spark, sf_dir, lone))
    return ads.sitemap_urls(written(both, "answers"))


PAGES = """SELECT b AS board, facet, (n - 1) DIV {size} * {size} AS offset, total, collect_list(a) AS page FROM
  (SELECT b, facet, struct(n, a.*) AS a, n, count(*) OVER (PARTITION BY b, facet) AS total FROM (SELECT b, facet, {posting} AS a, row_number() OVER (PARTITION BY b, facet ORDER BY k) AS n FROM {{o}})) GROUP BY b, facet, (n - 1) DIV {size}, total"""


def board_pages(spark: SparkSession, sf_dir: str, which: str, posting: str, body: str) -> tuple[str, DataFrame]:
    """(where the pages of a system's lists are stored, the rows they list)."""
    orders = spark.sql(ORDERS.replace("FROM orders", "FROM {orders}"), orders=load(spark, sf_dir, "orders"))
    rows = orders.withColumn("b", F.concat(F.lit("b"), F.col("c") % 7)).withColumn("facet", F.when(F.col("c") % 7 < 5, F.col("cc")) if which == "workday" else F.lit(None).cast("string"))
    pages = spark.sql(PAGES.format(size=paged.PAGE[which], posting=posting), o=rows)
    pages = pages.withColumn("page", F.array_sort("page")).select("board", "facet", "offset", F.expr(body).alias("body"))
    path = step_path(spark, "lists")
    paged.store_lists(pages, path)
    return path, rows


CAP = 50


@query("paged_workday", f"""WITH o AS ({ORDERS}), p AS (SELECT *, 'b' || c % 7 AS b, CASE WHEN c % 7 < 5 THEN cc END AS facet FROM o WHERE c % 7 < 5 OR city <> 'Bonn'),
  n AS (SELECT *, row_number() OVER (PARTITION BY b, facet ORDER BY k) AS n FROM p)
  SELECT b AS board, 'R' || k AS job_id, title, city AS location, CASE WHEN k % 3 = 0 THEN city || '|Torino' END AS places, cc AS country, 'Full time' AS employment_type, place_mode AS workplace_type, day AS posted_at, said AS description FROM n WHERE n <= {CAP}""")
def paged_workday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists in pages of 20 by country, at most 50 ads of each, joined with their details.

    Boards without lists by country name a place that isn't observed for one city, and several places for another.
    """
    place = "CASE WHEN c % 7 < 5 THEN city WHEN city = 'Bonn' THEN 'Zurich' WHEN city = 'Roma' THEN '3 Locations' ELSE city END"
    path, rows = board_pages(spark, sf_dir, "workday", f"named_struct('externalPath', concat('/job/', k), 'title', title, 'locationsText', {place})", "to_json(named_struct('total', total, 'jobPostings', page))")
    info = """SELECT b AS board, concat('/job/', k) AS path, to_json(named_struct('jobPostingInfo', named_struct('jobReqId', concat('R', k), 'location', city, 'additionalLocations', CASE WHEN k % 3 = 0 THEN array('Torino') END, 'country', named_struct('descriptor', cc), 'timeType', 'Full time',
      'remoteType', place_mode, 'startDate', day, 'jobDescription', concat('<p>', said, '</p>')))) AS body FROM {o}"""
    found = ads.workday_postings(paged.board_lists(spark, path, "workday", CAP), spark.sql(info, o=rows))
    return told(found).drop("department", "url", "salary_structured")


@query("paged_country", f"""WITH o AS ({ORDERS}), n AS (SELECT 'b' || c % 7 AS board, row_number() OVER (PARTITION BY c % 7 ORDER BY k) AS n FROM o WHERE cc = 'IT' AND c % 7 < 5)
  SELECT board, 'IT' AS facet, count(*) AS n FROM n WHERE n <= {CAP} GROUP BY board""")
def paged_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ads of one country by board; the lists of other countries aren't planned, let alone read."""
    path, _ = board_pages(spark, sf_dir, "workday", "named_struct('externalPath', concat('/job/', k), 'title', title, 'locationsText', city)", "to_json(named_struct('total', total, 'jobPostings', page))")
    return paged.board_lists(spark, path, "workday", CAP).where("facet = 'IT'").groupBy("board", "facet").agg(F.count("*").alias("n"))


@query("paged_oracle", f"""WITH o AS ({ORDERS}) SELECT 'b' || c % 7 AS board, CAST(k AS VARCHAR) AS job_id, title, city AS location, CASE WHEN k % 5 = 0 THEN city || '|Torino' END AS places, CASE WHEN k % 2 = 0 THEN 'US' ELSE cc END AS country, coalesce(team, 'F') AS department,
  'Permanent Full' AS employment_type, CASE WHEN k % 3 = 0 THEN 'ORA_REMOTE' END AS workplace_type, day AS posted_at, CASE WHEN k % 7 = 0 THEN '' ELSE said || ' resp qual' END AS description FROM o WHERE k % 2 = 1 OR city <> 'Bonn' OR k % 5 = 0""")
def paged_oracle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requisitions in pages of 25; those in no observed country go, by primary and secondary places; some lack details."""
    posting = """named_struct('Id', CAST(k AS STRING), 'Title', title, 'PrimaryLocation', CASE WHEN k % 2 = 0 AND city = 'Bonn' THEN 'Denver' ELSE city END, 'PrimaryLocationCountry', CASE WHEN k % 2 = 0 THEN 'US' ELSE cc END,
      'secondaryLocations', CASE WHEN k % 5 = 0 THEN array(named_struct('Name', 'Torino', 'CountryCode', 'IT')) END, 'JobFamily', team, 'JobFunction', 'F', 'ContractType', 'Permanent', 'JobSchedule', 'Full', 'WorkplaceTypeCode', CASE WHEN k % 3 = 0 THEN 'ORA_REMOTE' END, 'PostedDate', day)"""
    path, rows = board_pages(spark, sf_dir, "oracle", posting, "to_json(named_struct('items', array(named_struct('TotalJobsCount', total, 'requisitionList', page))))")
    info = "SELECT b AS board, CAST(k AS STRING) AS job_id, to_json(named_struct('items', array(named_struct('ExternalDescriptionStr', concat('<p>', said, '</p>'), 'ExternalResponsibilitiesStr', 'resp', 'ExternalQualificationsStr', 'qual')))) AS body FROM {o} WHERE k % 7 <> 0"
    found = told(ads.oracle_postings(paged.board_lists(spark, path, "oracle"), spark.sql(info, o=rows)))
    # Denver isn't in the expected rows but as Bonn: a primary place abroad whose secondary place is observed.
    return found.withColumns({"location": F.replace("location", F.lit("Denver"), F.lit("Bonn")), "places": F.replace("places", F.lit("Denver"), F.lit("Bonn"))}).drop("url", "salary_structured")


@query("facet_counts", f"WITH o AS ({ORDERS}) SELECT board, count(*) FILTER (cc = 'IT') AS n_jobs_italy, count(*) AS n_jobs_scope FROM o GROUP BY board HAVING count(*) FILTER (cc = 'IT') > 0")
def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ads by country in nested facets; a smaller count of the same country elsewhere doesn't add."""
    groups = "to_json(named_struct('facetParameter', 'a', 'values', collect_list(named_struct('descriptor', 'Group', 'values', array(named_struct('descriptor', country, 'count', n))))))"
    flat = "to_json(named_struct('facetParameter', 'b', 'values', array(named_struct('descriptor', 'Italy', 'count', 0), named_struct('descriptor', 'Mars', 'count', 99))))"
    docs = f"""SELECT board, concat('{{{{"facets":[', {groups}, ',', {flat}, ']}}}}') AS body
      FROM (SELECT board, CASE cc WHEN 'IT' THEN 'Italy' WHEN 'DE' THEN 'Germany' ELSE 'France' END AS country, count(*) AS n FROM {{o}} GROUP BY ALL) GROUP BY board"""
    return ads.facet_totals(written(rendered(spark, sf_dir, docs), "answers")).where("n_jobs_italy > 0")


# One crawl, from answers to stored ads. Titles and texts are written so that what the rules say of them is known.
CRAWLED = """SELECT *, CASE k % 6 WHEN 0 THEN 'Senior Data Engineer' WHEN 1 THEN 'Software Developer' WHEN 2 THEN 'Tirocinio HR' WHEN 3 THEN 'Buchhalter' WHEN 4 THEN 'Candidatura spontanea' ELSE 'Store Manager' END AS role,
  CASE k % 6 WHEN 0 THEN 'senior' WHEN 2 THEN 'intern' WHEN 5 THEN 'manager' ELSE CASE k % 4 WHEN 1 THEN 'senior' ELSE 'mid' END END AS level,
  CASE k % 6 WHEN 0 THEN 'data' WHEN 1 THEN 'engineering' WHEN 2 THEN 'hr' WHEN 3 THEN 'finance' ELSE 'retail' END AS func,
  CASE WHEN k % 4 = 1 THEN 'contratto a tempo indeterminato. esperienza di almeno 6 anni. ' WHEN k % 4 = 2 THEN 'smart working. ' ELSE '' END AS terms,
  CASE k % 3 WHEN 0 THEN concat('RAL ', pay, ' EUR. ') WHEN 1 THEN 'Competitive salary. ' ELSE '' END AS money FROM {o}"""
BUILT = f"""WITH o AS ({ORDERS}), r AS ({CRAWLED.replace('{o}', 'o')})
  SELECT 'lever|' || board || '|' || k AS job_key, CASE WHEN c % 3 <> 0 THEN 'company' || c % 50 END AS company_id, role AS title, cc || '-' || city AS location_id, city, CASE cc WHEN 'IT' THEN 'Italy' WHEN 'DE' THEN 'Germany' ELSE 'France' END AS country,
    level AS seniority, CASE WHEN k % 6 IN (0, 2, 5) THEN 'title' WHEN k % 4 = 1 THEN 'experience' ELSE 'not_stated' END AS seniority_source, CASE WHEN k % 4 = 1 THEN 6 END AS experience_years, func AS job_function,
    CASE WHEN k % 6 = 2 THEN 'internship' WHEN k % 4 = 1 THEN 'permanent' END AS contract_type, coalesce(place_mode, CASE WHEN k % 4 = 2 THEN 'hybrid' END, CASE WHEN k % 6 = 5 THEN 'onsite' END) AS workplace_type,
    CASE WHEN place_mode IS NOT NULL THEN 'ats' WHEN k % 4 = 2 THEN 'text' WHEN k % 6 = 5 THEN 'role' END AS workplace_source, 3 AS n_locations,
    CASE WHEN c % 2 = 0 THEN 'structured' WHEN k % 3 = 0 THEN 'text' ELSE 'none' END AS salary_source, CAST(CASE WHEN c % 2 = 0 THEN pay + 1000 WHEN k % 3 = 0 THEN pay END AS DOUBLE) AS ral_min_annual,
    CASE WHEN c % 2 = 0 OR k % 3 = 0 THEN 'figure' WHEN k % 3 = 1 THEN 'vague' ELSE 'none' END AS salary_transparency, CASE WHEN k % 5 = 0 THEN '2026-01-01' ELSE '2026-10-01' END AS first_seen, CAST(day AS DATE) AS posted_date FROM r WHERE k % 6 <> 4"""
STORED_FIELDS = ["job_key", "company_id", "title", "location_id", "city", "country", "seniority", "seniority_source", "experience_years", "job_function", "contract_type", "workplace_type", "workplace_source", "n_locations", "salary_source", "ral_min_annual", "salary_transparency", "first_seen", "posted_date"]


def crawled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(stored ads, their places) of one crawl of lever's boards."""
    orders = spark.sql(ORDERS.replace("FROM orders", "FROM {orders}"), orders=load(spark, sf_dir, "orders"))
    rows = spark.sql(CRAWLED, o=orders)
    posting = listed("'id', CAST(k AS STRING)", "'text', role", "'categories', named_struct('location', city, 'allLocations', array(city, 'Elsewhere'))", "'country', cc", "'workplaceType', place_mode", "'createdAt', unix_millis(CAST(day AS TIMESTAMP))", "'hostedUrl', url", "'descriptionPlain', concat(terms, money, said)",
                     "'salaryRange', CASE WHEN c % 2 = 0 THEN named_struct('min', pay + 1000, 'max', pay + 2000, 'currency', 'EUR', 'interval', 'year') END")
    answers = spark.sql(f"SELECT board, to_json({posting}) AS body FROM {{r}} GROUP BY board", r=rows)
    raw = written(ads.parse(answers, "lever"), "raw")
    cities = rows.select("city", "cc").distinct()
    region = F.concat(F.lit("Region of "), "city")
    gazetteer = cities.select(F.concat("cc", F.lit("-"), "city").alias("location_id"), "city", region.alias("region"), F.lit("01").alias("region_code"), F.col("cc").alias("country_code"), F.lit(500_000).cast("long").alias("population"))
    boards = rows.where("c % 3 <> 0").select("board", F.concat(F.lit("company"), F.col("c") % 50).alias("company_id")).distinct()
    known = rows.where("k % 5 = 0").select(F.concat(F.lit("lever|"), "board", F.lit("|"), "k").alias("job_key"), F.lit("2026-01-01").alias("first_seen"))
    return crawl.build(raw, boards, gazetteer, known, "2026-10-01")


@query("crawl_build", BUILT)
def crawl_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a board's answers to stored ads."""
    return crawled(spark, sf_dir)[0].select(*STORED_FIELDS)


@query("crawl_places", f"WITH o AS ({ORDERS}) SELECT 'lever|' || board || '|' || k AS job_key, city AS location_raw, cc || '-' || city AS location_id FROM o WHERE k % 6 <> 4")
def crawl_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of those ads that the gazetteer knows."""
    return crawled(spark, sf_dir)[1].where("location_raw <> 'Elsewhere'")


@query("crawl_reprocess", BUILT)
def crawl_reprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: stored ads with all that rules derive computed anew; nothing changes."""
    return crawl.reprocess(written(crawled(spark, sf_dir)[0], "stored")).select(*STORED_FIELDS)
