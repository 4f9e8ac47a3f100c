"""Company names and web addresses: identifiers, slugs, matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagewright.functions.text import normalize_text

# Words that don't tell companies apart.
LEGAL = "spa srl sb sa ag se nv inc ltd co group gruppo italia italy holding the company".split()
GENERIC = LEGAL + (
    "banca bank banco assicurazioni insurance energia energy international servizi services italiana italiano di del della dei and e per popolare credito "
    "consulting partners digital media tech technologies solutions systems global world fashion milano roma torino"
).split()


def name_tokens(name: Column) -> Column:
    joined = F.regexp_replace(F.regexp_replace(normalize_text(name), r"\bs p a\b", "spa"), r"\bs r l\b", "srl")
    return F.filter(F.split(joined, " "), lambda w: w != "")


def company_id(name: Column) -> Column:
    return F.array_join(name_tokens(name), "-")


def core_tokens(name: Column) -> Column:
    """Without legal forms, unless nothing else is left."""
    words = name_tokens(name)
    core = F.filter(words, lambda w: ~w.isin(LEGAL))
    return F.when(F.size(core) > 0, core).otherwise(words)


def domain_root(website: Column) -> Column:
    """Second-level label of the host without dashes; NULL if there is none."""
    full = F.when(website.startswith("http"), website).otherwise(F.concat(F.lit("https://"), website))
    host = F.lower(F.regexp_extract(full, r"^https?://([^/?#]*)", 1))
    labels = F.filter(F.split(host, r"\."), lambda x: (x != "") & (x != "www"))
    return F.when((website != "") & (F.size(labels) >= 2), F.replace(F.element_at(labels, F.greatest(F.size(labels) - 1, F.lit(1))), F.lit("-"), F.lit("")))


def _usable(candidates: Column, n: int) -> Column:
    return F.slice(F.array_distinct(F.filter(candidates, lambda c: c.isNotNull() & (F.length(c) >= 2))), 1, n)


def candidate_slugs(name: Column, website: Column, n: int = 8) -> Column:
    core, words = core_tokens(name), name_tokens(name)
    joined, dashed = F.array_join(core, ""), F.array_join(core, "-")
    more = [x for s in ("italia", "spa", "srl", "group") for x in (F.concat(joined, F.lit(s)), F.concat(dashed, F.lit(f"-{s}")))]
    return _usable(F.array(joined, dashed, domain_root(website), F.array_join(words, ""), F.array_join(words, "-"), *more), n)


def workday_tenants(name: Column, website: Column, n: int = 6) -> Column:
    core = core_tokens(name)
    joined, root, first = F.array_join(core, ""), domain_root(website), F.try_element_at(core, F.lit(1))
    telling = F.when((F.length(first) >= 4) & ~first.isin(GENERIC), first)
    ends = lambda base, s: F.concat(base, F.lit(s))
    return _usable(F.array(joined, root, ends(joined, "group"), ends(F.coalesce(root, joined), "group"), ends(joined, "company"), telling, ends(joined, "spa"), ends(joined, "italia")), n)


def name_match(name: Column, website: Column, texts: Column) -> Column:
    """strong: full name or domain stands in the texts; weak: one telling word of it; else NULL."""
    core, root = core_tokens(name), domain_root(website)
    full = F.array_join(core, " ")
    squeezed = F.array_join(core, "")
    long = F.length(squeezed) >= 6
    blob = normalize_text(F.array_join(F.filter(texts, lambda t: t.isNotNull() & (t != "")), " "))
    padded, packed = F.concat(F.lit(" "), blob, F.lit(" ")), F.replace(blob, F.lit(" "), F.lit(""))
    both = F.struct(padded.alias("padded"), packed.alias("packed"))
    named = lambda v, b: F.contains(b["padded"], F.concat(F.lit(" "), v, F.lit(" ")))
    strong = F.filter(F.array(F.when(long, full), F.when(long, squeezed), F.when(F.length(root) >= 6, root)), lambda v: v.isNotNull())
    weak = F.concat(F.filter(core, lambda w: (F.length(w) >= 3) & ~w.isin(GENERIC)), F.when(~long, F.array(full)).otherwise(F.array().cast("array<string>")))
    # The texts go in beside each variant: a lambda can't hold a Python function itself.
    any_of = lambda variants, test: F.exists(F.zip_with(variants, F.array_repeat(both, F.size(variants)), test), lambda x: x)
    is_strong = any_of(strong, lambda v, b: named(v, b) | ((F.length(v) >= 8) & ~v.contains(" ") & F.contains(b["packed"], v)))
    return F.when(is_strong, "strong").when(any_of(weak, named), "weak")


# What points to career pages, and addresses that never do.
CAREER_WORDS = r"(?i)career|carrier[ae]|lavora[\s_-]*con[\s_-]*noi|\bjobs?\b|work[\s_-]*with[\s_-]*us|join[\s_-]*(?:us|the[\s_-]*team|our[\s_-]*team)|unisciti|opportunit|posizioni[\s_-]*aperte|offerte[\s_-]*di[\s_-]*lavoro|talent|recruit|candidat|open[\s_-]*positions"
CAREER_HOSTS = r"^(?:careers?|jobs|carriere|lavoraconnoi)\."
SKIPPED_LINKS = r"(?i)^(?:mailto|tel|javascript):|linkedin\.com|facebook\.com|instagram\.com|twitter\.com|//x\.com|youtube\.com|glassdoor|indeed\.|tiktok\.com|\.pdf(?:$|\?)"
ANCHOR = r"(?is)<a\b[^>]*?href\s*=\s*[\"']([^\"'#][^\"']*)[\"'][^>]*>(.*?)</a>"
WORKDAY_NOT_SITES = ["wday", "job", "jobs", "details", "login", "apply"]
ENTITIES = {"&#x2F;": "/", "&#47;": "/", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def _part(url: Column, group: int) -> Column:
    """Scheme (1), host (2) or path (3) of an address; https is assumed."""
    full = F.when(url.startswith("http"), url).otherwise(F.concat(F.lit("https://"), url))
    return F.regexp_extract(full, r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)", group)


def joined_url(base: Column, href: Column) -> Column:
    """The address that a link of the page at ``base`` leads to."""
    origin = F.concat(_part(base, 1), F.lit("://"), _part(base, 2))
    folder = F.regexp_extract(_part(base, 3), r"(?s)^(.*/)", 1)
    path = F.concat(F.when(folder == "", "/").otherwise(folder), href)
    for _ in range(4):
        path = F.regexp_replace(F.regexp_replace(path, r"/\./", "/"), r"^(/[^?#]*?)?/(?!\.\./)[^/?#]+/\.\./", "$1/")
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(_part(base, 1), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?"), F.concat(origin, _part(base, 3), href))
        .otherwise(F.concat(origin, path))
    )


def career_links(pages: DataFrame, key: str, html: str, base: str, most: int = 3) -> DataFrame:
    """key, url, score: the best links of each page to career pages; of links with equal scores the first in the page.

    Two points each for a hint in the address, in the link's own text, and at the beginning of the host. Links to the
    page itself, to other networks and to documents don't count; of several links to one address the best does.
    """
    anchors = F.arrays_zip(F.regexp_extract_all(html, F.lit(ANCHOR), 1).alias("href"), F.regexp_extract_all(html, F.lit(ANCHOR), 2).alias("text"))
    rows = pages.select(key, F.col(base).alias("_base"), F.posexplode(anchors).alias("_at", "a")).select(key, "_base", "_at", F.trim("a.href").alias("href"), F.regexp_replace("a.text", "<[^>]+>", " ").alias("text"))
    href = F.col("href")
    for entity, sign in ENTITIES.items():
        href = F.replace(href, F.lit(entity), F.lit(sign))
    rows = rows.withColumn("href", href).where((F.col("href") != "") & ~F.col("href").rlike(SKIPPED_LINKS)).withColumn("url", joined_url(F.col("_base"), F.col("href")))
    rows = rows.where(F.col("url").startswith("http") & (F.rtrim("url", F.lit("/")) != F.rtrim("_base", F.lit("/"))))
    points = [F.concat(_part(F.col("url"), 2), _part(F.col("url"), 3)).rlike(CAREER_WORDS), F.col("text").rlike(CAREER_WORDS), _part(F.col("url"), 2).rlike(CAREER_HOSTS)]
    scored = rows.withColumn("score", sum((2 * p.cast("int") for p in points), F.lit(0))).where("score > 0")
    best = scored.groupBy(key, "url").agg(F.max("score").alias("score"), F.min("_at").alias("_at"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "_at"))
    return best.withColumn("_n", rank).where(F.col("_n") <= most).select(key, "url", "score")


def workday_parts(url: Column) -> Column:
    """Struct of host, tenant and site of a board's address; parts that can't be told are NULL."""
    host = _part(url, 2)
    parts = F.filter(F.split(_part(url, 3), "/"), lambda p: p != "")
    api = (F.size(parts) >= 4) & (F.try_element_at(parts, F.lit(1)) == "wday") & (F.try_element_at(parts, F.lit(2)) == "cxs")
    own = F.filter(parts, lambda p: ~p.rlike("^[a-z]{2}-[A-Z]{2}$"))
    shared, first = host.endswith("myworkdaysite.com"), F.try_element_at(own, F.lit(1))
    recruiting = shared & (F.size(own) >= 2) & (first == "recruiting")
    tenant = F.when(api, F.try_element_at(parts, F.lit(3))).when(recruiting, F.try_element_at(own, F.lit(2))).when(~shared, F.substring_index(host, ".", 1))
    site = F.when(api, F.try_element_at(parts, F.lit(4))).when(recruiting, F.try_element_at(own, F.lit(3))).when(~shared & ~first.isin(WORKDAY_NOT_SITES), first)
    return F.struct(host.alias("host"), tenant.alias("tenant"), site.alias("site"))


def workday_url(parts: Column) -> Column:
    """A board's address in its one form; NULL without a site."""
    shared = F.concat(F.lit("recruiting/"), parts["tenant"], F.lit("/"))
    return F.concat(F.lit("https://"), parts["host"], F.lit("/"), F.when(parts["host"].endswith("myworkdaysite.com"), shared).otherwise(""), parts["site"])


def oracle_parts(url: Column) -> Column:
    return F.struct(_part(url, 2).alias("host"), F.nullif(F.regexp_extract(_part(url, 3), r"/sites/([^/]+)", 1), F.lit("")).alias("site"))


def site_root(url: Column) -> Column:
    """Scheme and host of an address."""
    return F.concat(_part(url, 1), F.lit("://"), _part(url, 2))


def teamtailor_root(slug_or_url: Column) -> Column:
    """A slug's own site, or that of an address."""
    return F.when(slug_or_url.contains(".") | slug_or_url.startswith("http"), site_root(slug_or_url)).otherwise(F.concat(F.lit("https://"), slug_or_url, F.lit(".teamtailor.com")))
