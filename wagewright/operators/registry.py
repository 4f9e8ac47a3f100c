"""The registry of boards: fingerprints in pages, their ranking, and when to look again."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagewright.functions.ids import company_id, core_tokens, workday_parts, workday_url
from wagewright.functions.places import scope_country

# System and a pattern whose first group is a board's slug; a pattern without a group only tells the system.
FINGERPRINTS = [
    ("greenhouse", r"(?:job-)?boards(?:-api)?(?:\.eu)?\.greenhouse\.io/(?:v1/boards/|embed/job_(?:board|app)(?:/js)?\?(?:[^\"'\s<>]*?&(?:amp;)?)?for=)?([\w-]+)"),
    ("lever", r"(?:jobs|api)(?:\.eu)?\.lever\.co/(?:v0/postings/)?([\w.-]+)"),
    ("ashby", r"(?:jobs|api)\.ashbyhq\.com/(?:posting-api/job-board/)?([\w.%-]+)"),
    ("smartrecruiters", r"(?:careers|jobs)\.smartrecruiters\.com/([\w-]+)"),
    ("smartrecruiters", r"api\.smartrecruiters\.com/v1/companies/([\w-]+)"),
    ("workable", r"apply\.workable\.com/([\w-]+)"),
    ("workable", r"([\w-]+)\.workable\.com"),
    ("recruitee", r"([\w-]+)\.recruitee\.com"),
    ("teamtailor", r"([\w-]+)\.teamtailor\.com"),
    ("teamtailor", r"teamtailor(?:-cdn)?\.com"),
    ("personio", r"([\w-]+)\.jobs\.personio\.(?:de|com)"),
    ("successfactors", r"successfactors\.(?:com|eu)/[^\"'\s<>]*?company=([\w-]+)"),
    ("successfactors", r"[\w-]+\.jobs2web\.com"),
    ("successfactors", r"rmkcdn\.successfactors\.com"),
    ("oracle", r"([\w-]+\.fa\.[\w-]+\.oraclecloud\.com/hcmUI/CandidateExperience(?:/[a-z]{2}(?:-[A-Z]{2})?)?(?:/sites/[\w-]+)?)"),
    ("taleo", r"([\w-]+)\.taleo\.net"),
    ("icims", r"([\w-]+)\.icims\.com"),
    ("avature", r"([\w-]+)\.avature\.net"),
    ("avature", r"//([\w.-]+\.[a-z]{2,})/[a-z]{2}_[A-Z]{2}/careers/(?:JobOpenings|SearchJobs|JobDetail|Home)"),
    ("inrecruiting", r"([\w-]+)\.(?:intervieweb\.it|inrecruiting\.com)"),
    ("inrecruiting", r"(?:intervieweb\.it|inrecruiting\.com)"),
    ("altamira", r"([\w-]+)\.altamirahrm\.com"),
    ("altamira", r"altamirahrm\.com"),
    ("jobvite", r"jobs\.jobvite\.com/([\w-]+)"),
    ("eightfold", r"([\w-]+)\.eightfold\.ai"),
    ("phenom", r"phenompeople\.com"),
    ("cornerstone", r"([\w-]+)\.csod\.com"),
    ("factorial", r"([\w-]+)\.factorialhr\.(?:com|it|es)"),
]
WORKDAY = r"(?:[\w-]+\.wd\d+\.myworkdayjobs\.com|wd\d+\.myworkdaysite\.com)(?:/[^\s\"'<>?#\\]*)?"
#: Systems whose boards can be read; of the last some boards can't.
SUPPORTED = ["greenhouse", "lever", "ashby", "workday", "workable", "personio", "recruitee", "oracle", "teamtailor", "successfactors"]
PARTIAL = ["successfactors"]
#: Words that stand where a slug would, but aren't one.
NOT_SLUGS = (
    "www app api apply assets cdn static careers career jobs job help support status embed v0 v1 js css img images favicon boards job-boards login signin widget widgets media files eu us en it de fr privacy terms developers docs "
    "posting-api job-board scripts fonts cookies blog j analytics tracking metrics cdn-assets inrecruiting tt zinrec"
).split()
#: Of each system what any address of it holds, whatever else is in it: only where a page has it are its patterns tried.
LITERALS = {
    "greenhouse": ["greenhouse.io/"], "lever": ["lever.co/"], "ashby": ["ashbyhq.com/"], "smartrecruiters": ["smartrecruiters.com/"], "workable": ["workable.com"], "recruitee": ["recruitee.com"], "teamtailor": ["teamtailor"], "personio": ["jobs.personio."],
    "successfactors": ["successfactors.", "jobs2web.com"], "oracle": ["oraclecloud.com/"], "taleo": ["taleo.net"], "icims": ["icims.com"], "avature": ["avature.net", "/careers/"], "inrecruiting": ["intervieweb.it", "inrecruiting.com"], "altamira": ["altamirahrm.com"],
    "jobvite": ["jobs.jobvite.com/"], "eightfold": ["eightfold.ai"], "phenom": ["phenompeople.com"], "cornerstone": ["csod.com"], "factorial": ["factorialhr."], "workday": ["myworkdayjobs.com", "myworkdaysite.com"],
}
#: Bytes written as %xx, as many as stand together.
ESCAPED = "(?:%[0-9A-Fa-f]{2})+"


def unquoted(text: Column) -> Column:
    """All bytes written as %xx made plain, once; what isn't UTF-8 becomes a replacement sign."""
    plain = F.transform(F.regexp_extract_all(text, F.lit(ESCAPED), 0), lambda r: F.make_valid_utf8(F.unhex(F.replace(r, F.lit("%"), F.lit(""))).cast("string")))
    joined = F.array_join(F.zip_with(F.split(text, ESCAPED, -1), plain, lambda before, r: F.concat(before, F.coalesce(r, F.lit("")))), "")
    return F.when(F.contains(text, F.lit("%")), joined).otherwise(text)


def unescaped(text: Column) -> Column:
    """Addresses within scripts, within other addresses and in entities made plain."""
    slashes = F.replace(F.replace(F.replace(text, F.lit("\\u002F"), F.lit("/")), F.lit("\\u002f"), F.lit("/")), F.lit("\\/"), F.lit("/"))
    return F.replace(unquoted(slashes), F.lit("&#x2F;"), F.lit("/"))


def fingerprints(pages: DataFrame, key: str = "page_id", text: str = "html") -> DataFrame:
    """key, ats, slug, instance, supported, n (how often), evidence (the first match): boards that a page points to.

    A match whose slug is a word of shared addresses doesn't count. instance is us or eu for the two systems that have
    two, by the match itself. A workday board's slug is its address. The evidence is that of the first pattern that tells
    of the board, and of its matches the first.

    Literals are looked for first, all of them in one pass over a page; most pages have none, and others few.
    """
    # Each step is a column that the next one reads often, so that it isn't computed anew there; no condition on held, as
    # that would be moved below the steps. A page without any literal has no matches and so no rows.
    held = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(x)), F.lit(x)) for own in LITERALS.values() for x in own)))
    plain = pages.select(key, unescaped(F.col(text)).alias("t")).withColumn("low", F.lower("t")).withColumn("held", held).drop("low")
    kind = "array<struct<ats:string,seen:string,slug:string,at:bigint>>"

    def of(ats: str, pattern: str, i: int) -> Column:
        own = F.regexp_extract_all("t", F.lit(f"(?i){pattern}"), 0)
        slug = (lambda m: F.regexp_extract(m, f"(?i){pattern}", 1)) if has_group(pattern) else (lambda m: F.lit(""))
        rows = F.transform(own, lambda m, k: F.struct(F.lit(ats).alias("ats"), m.alias("seen"), slug(m).alias("slug"), (F.lit(i).cast("long") * 1_000_000_000 + k).alias("at"))).cast(kind)
        return F.when(F.arrays_overlap("held", F.array(*map(F.lit, LITERALS[ats]))), rows).otherwise(F.array().cast(kind))

    found = F.flatten(F.array(*(of(ats, p, i) for i, (ats, p) in enumerate([*FINGERPRINTS, ("workday", WORKDAY)]))))
    rows = plain.select(key, F.explode(found).alias("e")).select(key, "e.*")
    board = workday_parts(F.col("seen"))
    address = F.when(board["tenant"].isNotNull(), F.coalesce(workday_url(board), F.concat(F.lit("https://"), board["host"])))
    rows = rows.withColumn("slug", F.when(F.col("ats") == "workday", address).otherwise(F.regexp_replace(unquoted(F.col("slug")), r"^[.-]+|[.-]+$", "")))
    rows = rows.where(F.when(F.col("ats") == "workday", F.col("slug").isNotNull()).otherwise(~F.lower("slug").isin(NOT_SLUGS)))
    instance = F.when(F.col("ats").isin("greenhouse", "lever"), F.when(F.col("seen").rlike(r"(?i)\.eu\.(?:greenhouse|lever)\."), "eu").otherwise("us"))
    named = rows.withColumns({"instance": instance, "slug": F.nullif("slug", F.lit("")), "supported": F.col("ats").isin(SUPPORTED)})
    return named.groupBy(key, "ats", "slug", "instance", "supported").agg(F.count("*").alias("n"), F.substring(F.min_by("seen", "at"), 1, 150).alias("evidence"))


def has_group(pattern: str) -> bool:
    return re.compile(pattern).groups > 0


def merged(found: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per ats, slug and instance over all pages, with the evidence of the first page (by key) that has one."""
    return found.groupBy("ats", "slug", "instance", "supported").agg(F.sum("n").alias("n"), F.min_by("evidence", key).alias("evidence"))


def ranked(found: DataFrame, key: str) -> DataFrame:
    """Per key the rank of each fingerprint: supported systems, then those with a slug (for workday: with a site), then
    the commonest."""
    telling = F.col("slug").isNotNull() & (F.regexp_count("slug", F.lit("/")) != 2)
    order = [F.desc(F.col("ats").isin(SUPPORTED)), F.desc(F.coalesce(telling, F.lit(False))), F.desc("n"), F.asc("ats"), F.asc("slug")]
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))


def confidence(method: Column, ok: Column, error: Column, jobs: Column, match: Column) -> Column:
    """high: ready to crawl; medium: likely; low: to be looked at.

    A fingerprint on the company's own site is strong evidence: it stays medium without ads, without the name in them,
    or where the service only asked for a pause.
    """
    seen, own = ok & (jobs > 0), method == "fingerprint"
    return F.when(own & ~ok & (error == "HostBlocked"), "medium").when(own & ok & (jobs == 0), "medium").when(~F.coalesce(seen, F.lit(False)), "low").when(match == "strong", "high").when(own, "medium").otherwise("low")


def out_of_scope(jobs_scope: Column, jobs_italy: Column) -> Column:
    """The board's ads are counted and none is in an observed country."""
    return F.coalesce(F.coalesce(jobs_scope, jobs_italy) == 0, F.lit(False))


def own_slug_first(found: DataFrame, companies: DataFrame, key: str = "company_id") -> DataFrame:
    """Per company the fingerprints in order: within the first one's system those first whose slug holds the company's name.

    found: key, ats, slug, rank; companies: key, name.
    """
    names = F.filter(F.concat(F.array(F.replace(company_id(F.col("name")), F.lit("-"), F.lit(""))), core_tokens(F.col("name"))), lambda n: F.length(n) >= 4)
    rows = found.join(companies.select(key, names.alias("_names")), key)
    top = F.first("ats").over(Window.partitionBy(key).orderBy("rank"))
    own = F.exists("_names", lambda n: F.contains(F.lower(F.coalesce("slug", F.lit(""))), n))
    marked = rows.withColumn("_top", top).withColumn("_own", own)
    order = [F.desc(F.col("ats") == F.col("_top")), F.desc((F.col("ats") == F.col("_top")) & F.col("_own")), F.asc("rank")]
    return marked.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).drop("_names", "_top", "_own")


def discovery(rows: DataFrame) -> DataFrame:
    """The registry's verdict of each company from columns computed before: the first that applies.

    rows: fp_ats (NULL: no fingerprint), fp_slug, fp_supported, fp_partial, fp_ok, fp_error, fp_jobs, fp_match, careers_url,
    probe_ats (NULL: no probe succeeded), probe_slug, probe_confidence. Adds ats, slug_or_url, supported,
    detection_method, confidence.
    """
    has, good = F.col("fp_ats").isNotNull(), F.coalesce("fp_ok", F.lit(False))
    blocked = F.coalesce(F.col("fp_error") == "HostBlocked", F.lit(False))
    sure = confidence(F.lit("fingerprint"), good, F.coalesce("fp_error", F.lit("")), F.coalesce("fp_jobs", F.lit(0)), F.coalesce("fp_match", F.lit("")))
    supported = F.coalesce(F.col("fp_supported"), F.lit(False))
    place = F.coalesce("fp_slug", "careers_url")

    def verdict(ats: Column, slug: Column, ready: int, method: Column, how_sure: Column) -> Column:
        return F.struct(ats.alias("ats"), slug.alias("slug_or_url"), F.lit(ready).alias("supported"), method.alias("detection_method"), how_sure.alias("confidence"))

    own, medium = F.lit("fingerprint"), F.lit("medium")
    out = (
        F.when(has & supported & F.coalesce("fp_partial", F.lit(False)) & ~good & ~blocked, verdict(F.col("fp_ats"), place, 0, own, medium))
        .when(has & supported & (sure != "low"), verdict(F.col("fp_ats"), F.col("fp_slug"), 1, own, sure))
        .when(has & ~supported, verdict(F.col("fp_ats"), place, 0, own, medium))
        .when(F.col("probe_ats").isNotNull(), verdict(F.col("probe_ats"), F.col("probe_slug"), 1, F.lit("probe"), F.col("probe_confidence")))
        .when(has, verdict(F.col("fp_ats"), F.col("fp_slug"), 1, own, F.lit("low")))
        .otherwise(verdict(F.lit("none"), F.lit(None).cast("string"), 0, F.lit(None).cast("string"), F.lit("low")))
    )
    return rows.withColumn("_v", out).select(*rows.columns, "_v.*")


def best_site(sites: DataFrame, key: str = "host") -> DataFrame:
    """Per host the site with most ads in scope, then most ads, then the first: sites has site, ordinal, scope, total."""
    return sites.groupBy(key).agg(F.max_by("site", F.struct("scope", "total", -F.col("ordinal"))).alias("site"))


def best_facet(facets: DataFrame, key: str = "board") -> DataFrame:
    """Per board the filter that covers most ads, with its values: facets has param, id, n."""
    summed = facets.groupBy(key, "param").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list("id")).alias("ids"))
    return summed.groupBy(key).agg(F.max_by(F.struct("param", "ids"), F.struct("n", "param")).alias("f")).select(key, "f.*")


def scope_counts(ads: DataFrame) -> DataFrame:
    """Per board all ads, those with a place in Italy and those in any observed country."""
    each = F.concat(F.array("location"), F.coalesce("locations_all", F.array().cast("array<string>")))
    rows = ads.select("board", "job_id", "country", F.explode(each).alias("place"))
    cc = scope_country(F.col("place"), F.col("country"))
    by_ad = rows.withColumn("cc", cc).groupBy("board", "job_id").agg(F.max((F.col("cc") == "IT").cast("int")).alias("it"), F.max(F.col("cc").isNotNull().cast("int")).alias("any"))
    return by_ad.groupBy("board").agg(F.count("*").alias("n_jobs_total"), F.coalesce(F.sum("it"), F.lit(0)).alias("n_jobs_italy"), F.coalesce(F.sum("any"), F.lit(0)).alias("n_jobs_scope"))


def needs_check(last_checked: Column, today: Column, days: int, force: bool = False, changed: Column | None = None, newly: Column | None = None, uncounted: Column | None = None) -> Column:
    """Never looked at, long ago, changed by hand, of a system that can be read now, without a count of ads, or forced."""
    reasons = [F.coalesce(c, F.lit(False)) for c in (changed, newly, uncounted) if c is not None]
    return reduce(lambda a, b: a | b, reasons, F.lit(force) | last_checked.isNull() | (F.datediff(today, last_checked) >= days))


def newly_supported(ats: Column, supported: Column, notes: Column) -> Column:
    """Found when the system couldn't be read yet; not a board of which it is known that it can't."""
    known = ats.isin(PARTIAL) & F.contains(F.coalesce(notes, F.lit("")), F.lit("no public job list"))
    return ats.isin(SUPPORTED) & (supported == 0) & ~known


def uncounted(supported: Column, jobs_total: Column, jobs_italy: Column) -> Column:
    """Readable and with ads, of which Italy's weren't counted."""
    return (supported == 1) & (jobs_total > 0) & jobs_italy.isNull()


def with_overrides(found: DataFrame, overrides: DataFrame, key: str = "company_id") -> DataFrame:
    """found with rows set by hand in place of discovered ones."""
    columns = [c for c in found.columns if c != key and c in overrides.columns]
    joined = found.alias("f").join(overrides.withColumn("_by_hand", F.lit(True)).alias("o"), key, "left")
    return joined.select(key, *(F.when(F.col("o._by_hand"), F.col(f"o.{c}")).otherwise(F.col(f"f.{c}")).alias(c) if c in columns else F.col(f"f.{c}") for c in found.columns if c != key))


def board_target(ats: Column, slug: Column, url: Column) -> Column:
    return F.when((ats == "successfactors") | ((ats == "teamtailor") & (F.coalesce(slug, F.lit("")) == "")), url).otherwise(slug)


def probe_plan(tenants: DataFrame, servers: DataFrame) -> DataFrame:
    """tenants: company_id, tenant, t; servers: server, s (both bounded lists, numbered from 1). The first two tenants
    are tried on eleven servers, the next two on four."""
    return tenants.join(servers, ((F.col("t") <= 2) & (F.col("s") <= 11)) | ((F.col("t") <= 4) & (F.col("s") <= 4)))
