"""Urls, link classes and host rules as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.sources import table

from .canon import site_of
from .entities import any_of

# Parts by which a link or a host is classed, in order.
LINK_RULES = {
    "download": (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".zip", ".rar"),
    "source_code": ("github.com", "gitlab.com", "bitbucket.org", "sourceforge.net"),
    "social": ("facebook.com", "twitter.com", "linkedin.com", "instagram.com", "youtube.com"),
}
NAVIGATION = ("home", "about", "contact", "menu", "next", "previous", "back")
HOST_RULES = {"academic": (".edu", "arxiv", "scholar", "pubmed"), "news": ("news", "times", "post", "guardian", "reuters"), "technical": ("github", "stackoverflow", "docs", "api"), "legal": ("law", "legal", "court", "gov"), "medical": ("health", "medical", "nih", "who")}
URL_DATES = (r"/(\d{4})/(\d{1,2})/(\d{1,2})/", r"/(\d{4})-(\d{1,2})-(\d{1,2})", r"/(\d{4})(\d{2})(\d{2})/")


def link_class(href: Column, text: Column) -> Column:
    h, t = F.lower(F.coalesce(href, F.lit(""))), F.lower(F.coalesce(text, F.lit("")))
    rules = F.when(h.startswith("mailto:"), "email").when(h.startswith("tel:"), "phone")
    for k, v in LINK_RULES.items():
        rules = rules.when(any_of(h, v), k)
    rules = rules.when(t.contains("documentation") | h.contains("/docs/") | t.contains("manual"), "documentation").when(any_of(t, NAVIGATION), "navigation")
    return rules.when(h.startswith("#"), "anchor").otherwise("content")


def netloc(url: Column) -> Column:
    """Authority of a url in lower case, port and user kept."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1))


def domain_type(url: Column) -> Column:
    host = netloc(url)
    return F.coalesce(*[F.when(any_of(host, v), F.lit(k)) for k, v in HOST_RULES.items()], F.lit("general"))


def url_date(url: Column) -> Column:
    """The first plausible date in a url's path."""
    at = lambda p, g: F.lpad(F.regexp_extract(url, p, g), 4 if g == 1 else 2, "0")
    return F.coalesce(*[F.try_to_date(F.when(url.rlike(p), F.concat_ws("-", at(p, 1), at(p, 2), at(p, 3))), "yyyy-MM-dd") for p in URL_DATES])


def url_verdict(url: Column) -> Column:
    """'ok' or the reason to refuse a url: its length, scheme, host, a private address or an injected statement."""
    host = F.regexp_replace(netloc(url), r":\d*$", "")
    return (
        F.when(url.isNull() | (url == ""), "empty").when(F.length(url) > 2048, "too_long").when(~F.lower(url).rlike("^https?://"), "scheme").when(host == "", "host")
        .when(host.isin("localhost", "127.0.0.1", "0.0.0.0", "metadata.google.internal", "169.254.169.254"), "blocked_host").when(host.rlike(r"^(10\.|192\.168\.|172\.(1[6-9]|2\d|3[01])\.)"), "private_address")
        .when(url.rlike(r"(?i)<script|javascript:|\bunion\b.*\bselect\b|--|;"), "injection").otherwise("ok")
    )


def links_classed(spark, d):
    """One row for each link of a record with its class."""
    t = table(spark, d, "extracted_content").select("extract_id", F.posexplode("links").alias("pos", "l"))
    return t.select("extract_id", F.col("pos").cast("long").alias("pos"), link_class(F.col("l.href"), F.col("l.text")).alias("class"))


def url_facts(spark, d):
    t = table(spark, d, "crawl_results").select("request_id", "ts", "url").distinct()
    return t.select("request_id", "ts", netloc(F.col("url")).alias("netloc"), site_of(F.col("url")).alias("site"), domain_type(F.col("url")).alias("domain_type"), url_date(F.col("url")).alias("url_date"), url_verdict(F.col("url")).alias("verdict"))


def metadata_projection(spark, d):
    """Inline metadata of a crawl joined to what was extracted from its latest delivery."""
    e = table(spark, d, "extracted_content").select("extract_id", "request_id", "title", "text")
    c = table(spark, d, "crawl_results").groupBy("request_id").agg(F.max(F.struct("ts", "status_code", "url", "final_url")).alias("c")).select("request_id", "c.*")
    n = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != ""))
    return e.join(c, "request_id").select("extract_id", "url", F.coalesce("final_url", "url").alias("canonical_url"), "title", netloc(F.col("url")).alias("domain"), F.col("status_code").cast("long").alias("http_status"), n.cast("long").alias("word_count"))


QUERIES = {f.__name__: f for f in (links_classed, url_facts, metadata_projection)}

_or = lambda c, v: "(" + " or ".join(f"contains({c}, '{x}')" for x in v) + ")"
_NET = r"lower(regexp_extract(coalesce({u}, ''), '^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)', 1))"
_SITE = r"regexp_replace(lower(regexp_extract(trim(coalesce(url, '')), '^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^(www|m)\.', '')"
ORACLE = {
    "links_classed": "select extract_id, pos, case when starts_with(h, 'mailto:') then 'email' when starts_with(h, 'tel:') then 'phone' " + " ".join(f"when {_or('h', v)} then '{k}'" for k, v in LINK_RULES.items()) + f" when contains(t, 'documentation') or contains(h, '/docs/') or contains(t, 'manual') then 'documentation' when {_or('t', NAVIGATION)} then 'navigation' when starts_with(h, '#') then 'anchor' else 'content' end as class from (select extract_id, pos, lower(coalesce(l.href, '')) as h, lower(coalesce(l.text, '')) as t from (select extract_id, unnest(range(len(links))) as pos, unnest(links) as l from extracted_content))",
    "url_facts": f"select request_id, ts, n as netloc, site, case {' '.join(f'''when {_or('n', v)} then '{k}' ''' for k, v in HOST_RULES.items())} else 'general' end as domain_type, "
    + "coalesce(" + ", ".join(f"try_cast(case when regexp_matches(url, '{p}') then lpad(regexp_extract(url, '{p}', 1), 4, '0') || '-' || lpad(regexp_extract(url, '{p}', 2), 2, '0') || '-' || lpad(regexp_extract(url, '{p}', 3), 2, '0') end as date)" for p in URL_DATES) + ") as url_date, "
    + r"""case when url is null or url = '' then 'empty' when length(url) > 2048 then 'too_long' when not regexp_matches(lower(url), '^https?://') then 'scheme' when h = '' then 'host' when h in ('localhost', '127.0.0.1', '0.0.0.0', 'metadata.google.internal', '169.254.169.254') then 'blocked_host'
 when regexp_matches(h, '^(10\.|192\.168\.|172\.(1[6-9]|2\d|3[01])\.)') then 'private_address' when regexp_matches(url, '(?i)<script|javascript:|\bunion\b.*\bselect\b|--|;') then 'injection' else 'ok' end as verdict
 from (select *, regexp_replace(n, ':\d*$', '') as h from (select distinct request_id, ts, url, """ + _NET.format(u="url") + " as n, " + _SITE + " as site from crawl_results))",
    "metadata_projection": "with c as (select * from (select request_id, status_code, url, final_url, row_number() over (partition by request_id order by ts desc, status_code desc, url desc) rn from crawl_results) where rn = 1) select extract_id, c.url, coalesce(final_url, c.url) as canonical_url, title, " + _NET.format(u="c.url") + r" as domain, cast(status_code as bigint) as http_status, cast(len(list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda w: w <> '')) as bigint) as word_count from extracted_content e join c using (request_id)",
}
