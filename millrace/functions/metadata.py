"""Metadata of pages: structured data, authors, dates, social signals, and the record that is made of them.

One parse of each page gives the maps and candidate lists; ranking, precedence and scores are native expressions on them.
"""

from __future__ import annotations

import json
import re
from datetime import datetime
from functools import reduce
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources import table

from .markup import Node, absolute, first_match, html_text, parse, per_page

# JSON-LD keys and the names they are kept by, later keys winning; named meta tags that are kept.
SCHEMA_KEYS = (("name", "schema_title"), ("headline", "schema_title"), ("title", "schema_title"), ("description", "schema_description"), ("author", "schema_author"), ("datePublished", "schema_date_published"), ("dateModified", "schema_date_modified"), ("image", "schema_image"), ("publisher", "schema_publisher"))
META_NAMES = (("description", "meta_description"), ("keywords", "meta_keywords"), ("author", "meta_author"), ("robots", "meta_robots"), ("generator", "meta_generator"), ("viewport", "meta_viewport"), ("theme-color", "meta_theme_color"), ("application-name", "meta_app_name"))
# Weight of each family of keys in the confidence, and the keys expected of each.
FAMILIES = (("og_", 0.3), ("schema_", 0.4), ("twitter_", 0.2), ("meta_", 0.1))
EXPECTED = 5
# Date keys of JSON-LD, meta tags with dates, classes of date elements, path and text patterns.
DATE_KEYS = ("datePublished", "dateCreated", "dateModified", "publishDate", "publicationDate", "created", "modified", "uploadDate")
DATE_META = ("article:published_time", "article:modified_time", "publish_date", "publication_date", "date", "DC.date", "DC.date.created", "DC.date.issued", "sailthru.date", "article.published", "published-date", "release_date", "created")
DATE_CLASSES = ("published", "date-published", "publish-date", "article-date", "post-date", "entry-date", "timestamp")
DATE_PATHS = (r"/(\d{4})/(\d{1,2})/(\d{1,2})/", r"/(\d{4})-(\d{1,2})-(\d{1,2})/", r"/(\d{4})(\d{2})(\d{2})/", r"_(\d{4})(\d{2})(\d{2})_", r"-(\d{4})-(\d{1,2})-(\d{1,2})-")
_MONTH = r"(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*"
DATE_TEXTS = (
    (r"\b(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})?)\b", "iso_datetime"), (r"\b(\d{4}-\d{2}-\d{2})\b", "iso_date"), (r"\b(\d{1,2}/\d{1,2}/\d{4})\b", "us_date"), (r"\b(\d{1,2}-\d{1,2}-\d{4})\b", "dash_date"), (r"\b(\d{1,2}\.\d{1,2}\.\d{4})\b", "dot_date"),
    (rf"\b({_MONTH}\s+\d{{1,2}},?\s+\d{{4}})\b", "month_name"), (rf"\b(\d{{1,2}}\s+{_MONTH}\s+\d{{4}})\b", "day_month_year"),
)
DATE_FORMATS = ("%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%Y/%m/%d", "%m-%d-%Y", "%d-%m-%Y", "%m.%d.%Y", "%d.%m.%Y", "%B %d, %Y", "%b %d, %Y", "%B %d %Y", "%b %d %Y", "%d %B %Y", "%d %b %Y", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M")
NEAR_DATES = ("published", "posted", "created", "updated")
# Byline patterns, class parts of author elements, what is no name.
BYLINES = (r"(?:by|author|written by|posted by)\s*:?\s*([a-zA-Z\s\-\.\']+)", r"(?:writes|reports|says)", r"@([a-zA-Z0-9_]+)", r"(?:author|writer|journalist):\s*([a-zA-Z\s\-\.\']+)")
AUTHOR_PARTS = ("author", "byline", "writer")
AUTHOR_META = ("author", "article:author", "dc.creator")
NO_NAME = r"^\d+$|^\w+@\w+\.\w+$|^https?://|^\d{1,2}[/\-]\d{1,2}|^(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)|^(monday|tuesday|wednesday|thursday|friday|saturday|sunday)"
STOCK_NAMES = ("admin", "administrator", "author", "editor", "writer", "staff", "team", "news", "press", "media", "content", "article", "post", "blog", "website", "page", "home", "about", "contact", "privacy")
NAME_PREFIXES = ("by", "author:", "written by", "posted by", "@")
NAME_SUFFIXES = ("writes:", "says:", "reports:")
TITLES_BEFORE = r"^(?:by|author|dr|mr|ms|mrs|prof|professor) "
TITLES_AFTER = r" ?(?:phd in computer science|phd in data science|phd in ai|computer scientist|data scientist|researcher|phd|ph\.d|md|m\.d|jr|sr|ii|iii|iv)$"
DATES_IN_NAMES = r"(?i)(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},?\s+\d{4}|\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}|\d{4}[/\-]\d{1,2}[/\-]\d{1,2}|\d{1,2}\s+(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\s+\d{4}|\d{1,2}:\d{2}(?::\d{2})?\s*(?:AM|PM)?"
# Counters of platforms in markup, by platform and measure, the first hit counting.
_N = r"[^>]*[\"'](\d+)[\"']"
COUNTERS = {
    "facebook": {"shares": (r"facebook[^>]*share" + _N, r"fb[_-]share" + _N, r"data-share-count[\"'](\d+)[\"']"), "likes": (r"facebook[^>]*like" + _N, r"fb[_-]like" + _N), "comments": (r"facebook[^>]*comment" + _N, r"fb[_-]comment" + _N)},
    "twitter": {"shares": (r"twitter[^>]*share" + _N, r"tweet[_-]count" + _N), "retweets": (r"retweet" + _N, r"rt[_-]count" + _N), "likes": (r"twitter[^>]*like" + _N, r"favorite" + _N)},
    "linkedin": {"shares": (r"linkedin[^>]*share" + _N, r"li[_-]share" + _N)},
    "pinterest": {"pins": (r"pinterest[^>]*pin" + _N, r"pin[_-]count" + _N)},
    "reddit": {"upvotes": (r"reddit[^>]*up" + _N, r"upvote" + _N), "downvotes": (r"reddit[^>]*down" + _N, r"downvote" + _N), "comments": (r"reddit[^>]*comment" + _N,)},
}
SHARING = r"class=[\"'][^\"']*share[^\"']*[\"']|share[_-]button|social[_-]share|facebook\.com/sharer|twitter\.com/intent/tweet"
LIKING = r"class=[\"'][^\"']*like[^\"']*[\"']|like[_-]button|favorite[_-]button|heart[_-]button"
COMMENTING = r"class=[\"'][^\"']*comment[^\"']*[\"']|comment[_-]system|disqus|livefyre|facebook\.com/plugins/comments"
WIDGETS = r"<iframe[^>]+src=[\"'][^\"']*(?:facebook|twitter|instagram|youtube)\.com|<div[^>]+class=[\"'][^\"']*(?:fb-|twitter-|instagram-)"


def json_ld(root: Node) -> list[dict]:
    """The objects of all JSON-LD scripts, lists flattened, broken ones left out."""
    out = []
    for n in root.find("script"):
        if n.attrs.get("type", "").lower() == "application/ld+json":
            try:
                data = json.loads("".join(k for k in n.kids if isinstance(k, str)))
            except ValueError:
                continue
            out += [x for x in (data if isinstance(data, list) else [data]) if isinstance(x, dict)]
    return out


def _plain(value) -> str | None:
    """A JSON-LD value as text: the name or id of an object, the first of a list."""
    if isinstance(value, list):
        value = value[0] if value else None
        return value["name"] if isinstance(value, dict) and "name" in value else None if value is None else str(value)
    if isinstance(value, dict):
        return value.get("name", value.get("@id"))
    return str(value) if value else None


def structured(root: Node, base: str) -> dict[str, str]:
    """OpenGraph, JSON-LD, card and named meta tags in one flat map; families differ by prefix."""
    out: dict[str, str] = {}
    cards: dict[str, str] = {}
    named: dict[str, str] = {}
    for n in root.find("meta"):
        key, value = n.attrs.get("property", ""), n.attrs.get("content", "")
        if key.startswith(("og:", "fb:")) and value:
            key = key.replace(":", "_")
            out[key] = absolute(base, value) if key in ("og_image", "og_url") and base else value
        name = n.attrs.get("name", "")
        if value and name.startswith("twitter:"):
            cards[name.replace(":", "_")] = value
        if value and (kept := dict(META_NAMES).get(name)) and kept not in named:
            named[kept] = value
    for item in json_ld(root):
        if item.get("@type"):
            out["schema_type"] = _plain(item["@type"]) or ""
        for key, name in SCHEMA_KEYS:
            if item.get(key) and (v := _plain(item[key])) is not None:
                out[name] = str(v)
    title = first_match(root, "title")
    if title and title.text():
        named["meta_title"] = title.text()
    for n in root.find("link"):
        if "canonical" in n.attrs.get("rel", "").split() and n.attrs.get("href"):
            named["canonical_url"] = absolute(base, n.attrs["href"])
            break
    return {k: str(v) for k, v in {**out, **cards, **named}.items()}


def microdata(root: Node) -> dict[str, dict[str, str]]:
    """Properties by item type: content of meta, datetime, src, href or the text."""
    out = {}
    for item in root.walk():
        kind = item.attrs.get("itemtype")
        if "itemscope" in item.attrs and kind:
            props = {}
            for p in item.walk():
                name = p.attrs.get("itemprop")
                if p is not item and name:
                    value = p.attrs.get("content", "") if p.tag == "meta" else p.attrs.get("src", "") if p.tag == "img" else p.attrs.get({"time": "datetime", "a": "href"}.get(p.tag, ""), p.text())
                    if value:
                        props[name] = value
            if props:
                out[kind] = props
    return out


def parse_date(text: str) -> datetime | None:
    """A date in ISO or one of DATE_FORMATS; time zones are taken off after conversion to UTC; digits only are no date."""
    t = " ".join(str(text).split())
    try:
        d = datetime.fromisoformat(t.replace("Z", "+00:00"))
        return (d - d.utcoffset()).replace(tzinfo=None) if d.tzinfo else d
    except ValueError:
        pass
    for f in DATE_FORMATS:
        try:
            return datetime.strptime(t, f)
        except ValueError:
            continue
    return None


def date_candidates(root: Node, html: str, url: str) -> list[dict]:
    """All dates with confidence and origin, in the order of the strategies; plausibility is left to the caller."""
    out = []

    def add(text, confidence, origin):
        if text and (d := parse_date(text)):
            out.append({"date": d, "confidence": confidence, "origin": origin, "source": str(text)[:200]})

    for item in json_ld(root):
        for k in DATE_KEYS:
            add(item.get(k), 0.95 if k in ("datePublished", "publishDate") else 0.85, "structured")
    for name in DATE_META:
        for n in root.find("meta"):
            if n.attrs.get("property" if name.startswith("article:") else "name") == name:
                add(n.attrs.get("content"), 0.9 if "article" in name else 0.8, "meta")
    for n in root.walk():
        if (n.tag == "time" and ("datetime" in n.attrs or "pubdate" in n.attrs)) or set(DATE_CLASSES) & set(n.classes()):
            add(next((v for a in ("datetime", "title", "data-time", "data-date") if (v := n.attrs.get(a))), None) or n.text(""), 0.85 if n.attrs.get("datetime") else 0.7, "time")
    try:
        path = urlparse(url).path
    except ValueError:
        path = ""
    for p in DATE_PATHS:
        for m in re.finditer(p, path):
            add("-".join(g.zfill(2) for g in m.groups()), 0.75, "url")
    for p, _ in DATE_TEXTS:
        for m in re.finditer(p, html, re.I):
            near = html[max(0, m.start() - 50) : m.end() + 50].lower()
            add(m.group(1), 0.7 if any(w in near for w in NEAR_DATES) else 0.6, "content")
    return out


def valid_name(name: str) -> bool:
    """Two to 100 characters with a letter, no number, address, date or stock word."""
    low = name.lower()
    return 2 <= len(name) <= 100 and not re.match(NO_NAME, low) and bool(re.search("[a-zA-Z]", name)) and low not in STOCK_NAMES


def clean_name(name: str) -> str:
    """A name without one introducing and one closing word, white space collapsed, marks at its ends taken off."""
    name = name.strip()
    low = name.lower()
    first = next((p for p in NAME_PREFIXES if low.startswith(p)), "")
    name = name[len(first) :].strip()
    last = next((s for s in NAME_SUFFIXES if low.endswith(s)), "")
    name = name[: len(name) - len(last)].strip() if last else name
    return re.sub(r"\s+", " ", name).strip(".,;:")


def name_key(name: str) -> str:
    """A name for comparison: lower case, without marks, titles and degrees, up to the first comma."""
    n = re.sub(r"[.;:'\"()]", "", re.sub(r"\s+", " ", name.lower().strip()))
    return re.sub(TITLES_AFTER, "", re.sub(TITLES_BEFORE, "", n.split(",")[0])).strip()


def author_candidates(root: Node, html: str) -> list[dict]:
    """Authors with confidence and origin from JSON-LD, meta tags, author elements and bylines."""
    out = []

    def add(name, confidence, origin, url=None):
        name = clean_name(str(name or ""))
        if name:
            out.append({"name": name, "key": name_key(name), "confidence": confidence, "origin": origin, "url": url})

    for item in json_ld(root):
        who = item.get("author")
        for a in who if isinstance(who, list) else [who]:
            add(a.get("name") if isinstance(a, dict) else a, 0.9, "json_ld")
    for n in root.find("meta"):
        if (n.attrs.get("name") or n.attrs.get("property") or "").lower() in AUTHOR_META and len(n.attrs.get("content", "").strip()) > 1:
            add(n.attrs["content"], 0.7, "meta")
    for n in root.walk():
        marks = " ".join((n.attrs.get("class", ""), n.attrs.get("id", "") if "author" in n.attrs.get("id", "") else ""))
        if any(p in marks for p in AUTHOR_PARTS) or n.attrs.get("rel") == "author":
            name = re.sub(r"\s+", " ", re.sub(DATES_IN_NAMES, "", n.text(""))).strip().strip(".,;:-")
            link = next(n.find("a"), None)
            if 1 < len(name) < 100 and not re.match(r"^\d+[\d\s\-/]+$", name):
                add(name, 0.6, "element", link.attrs.get("href") if link else None)
    for i, p in enumerate(BYLINES):
        for m in re.finditer(p, html, re.I):
            # a name before its verb is looked for backwards: no name is longer than 100 characters
            found = m if m.groups() else re.search(r"[a-zA-Z\s\-\.\']+$", html[max(0, m.start() - 120) : m.start()])
            name = found.group(1 if m.groups() else 0).strip() if found else ""
            if valid_name(name):
                add(name, max(0.2, 0.5 - 0.1 * i + (0.1 if m.start() < 0.2 * len(html) else 0.0)), "pattern")
    return out


def author_details(root: Node, html: str, name: str) -> dict:
    """Biography, links, profiles and address near a name; confidence is the share of these that were found."""
    low = name.lower()
    bio = next((t for n in root.walk() if "bio" in n.attrs.get("class", "").lower() and low in (t := n.text("")).lower() and len(t) > 20), None)
    hrefs = [n.attrs["href"] for n in root.find("a") if n.attrs.get("href") and (low in n.text("").lower() or low in n.attrs["href"].lower())]
    profiles = {k: h for h in hrefs for k in ("twitter", "linkedin", "facebook", "instagram") if f"{k}.com" in h}
    around = " ".join(html[max(0, m.start() - 500) : m.end() + 500] for m in re.finditer(re.escape(name), html, re.I))
    mail = re.search(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", around)
    found = (bio, mail, profiles, hrefs)
    return {"name": name, "bio": bio, "email": mail.group(0) if mail else None, "profiles": profiles, "links": hrefs, "confidence": sum(map(bool, found)) / len(found)}


def interactions(items: list[dict]) -> dict:
    """Like, share and comment totals of JSON-LD, and the accounts it names."""
    out, same = {"likes": 0, "shares": 0, "comments": 0}, []
    for item in items:
        stats = item.get("interactionStatistic") or []
        for s in stats if isinstance(stats, list) else [stats]:
            kind = s.get("interactionType") if isinstance(s, dict) else None
            kind = (kind.get("@type", "") if isinstance(kind, dict) else "").lower()
            for k in out:
                if k[:-1] in kind and str(s.get("userInteractionCount", 0)).isdigit():
                    out[k] += int(s.get("userInteractionCount", 0))
                    break
        refs = item.get("sameAs")
        same += [u for u in (refs if isinstance(refs, list) else []) if isinstance(u, str) and any(p in u.lower() for p in ("facebook", "twitter", "instagram", "linkedin"))]
    return out | {"accounts": same}


_DATE = "struct<date: timestamp_ntz, confidence: double, origin: string, source: string>"
_AUTHOR = "struct<name: string, key: string, confidence: double, origin: string, url: string>"
META = f"fields map<string, string>, micro map<string, map<string, string>>, n_json_ld int, dates array<{_DATE}>, authors array<{_AUTHOR}>, ld_likes long, ld_shares long, ld_comments long, accounts array<string>"


def page_metadata_parts(pages: DataFrame) -> DataFrame:
    """META of each page (request_id, ts, url, content), from one parse."""

    def work(html, url):
        root = parse(html)
        items = json_ld(root)
        i = interactions(items)
        return [{"fields": structured(root, url), "micro": microdata(root), "n_json_ld": len(items), "dates": date_candidates(root, html, url), "authors": author_candidates(root, html), "ld_likes": i["likes"], "ld_shares": i["shares"], "ld_comments": i["comments"], "accounts": i["accounts"]}]

    return per_page(pages, work, META)


def structured_confidence(fields: Column, n_json_ld: Column) -> Column:
    """Share of expected keys found by family, weighted; JSON-LD adds a tenth."""
    found = lambda p: F.least(F.size(F.filter(F.map_keys(fields), lambda k: k.startswith(p))) / EXPECTED, F.lit(1.0))
    bonus = F.when(n_json_ld > 0, 0.1).otherwise(0.0)
    return F.least((sum(found(p) * w for p, w in FAMILIES) + bonus) / (sum(w for _, w in FAMILIES) + bonus), F.lit(1.0))


def plausible(date: Column, now: Column) -> Column:
    """From 1990 to the end of the day of ``now``."""
    return (F.year(date) >= 1990) & (F.to_date(date) <= F.to_date(now))


def ranked_dates(dates: Column, now: Column) -> Column:
    """Plausible dates by confidence, those of earlier strategies first among equals."""
    numbered = F.transform(dates, lambda d, i: F.struct((-d["confidence"]).alias("c"), i.alias("i"), d.alias("d")))
    return F.transform(F.array_sort(F.filter(numbered, lambda x: plausible(x["d"]["date"], now))), lambda x: x["d"])


def merged_authors(authors: Column) -> Column:
    """One author for each name key: the most confident (earliest among equals), with the first url of the group; by confidence."""
    keys = F.array_distinct(F.transform(authors, lambda a: a["key"]))

    def one(k):
        own = F.filter(authors, lambda a: a["key"] == k)
        best = F.array_min(F.transform(own, lambda a, i: F.struct((-a["confidence"]).alias("c"), i.alias("i"), a["name"].alias("name"), a["origin"].alias("origin"))))
        url = F.get(F.filter(F.transform(own, lambda a: a["url"]), lambda u: u.isNotNull()), F.lit(0))
        return F.struct(best["c"].alias("c"), k.alias("key"), best["name"].alias("name"), best["origin"].alias("origin"), url.alias("url"))

    ranked = F.array_sort(F.transform(keys, one))
    return F.transform(ranked, lambda a: F.struct(a["name"].alias("name"), (-a["c"]).alias("confidence"), a["origin"].alias("origin"), a["url"].alias("url")))


def social(html: Column) -> dict[str, Column]:
    """Counts by platform and measure (null where none), totals, indicator flags, hashtags and mentions, natively by patterns."""
    hit = lambda ps: F.coalesce(*[F.expr("try_cast(null as long)"), *[F.regexp_extract(html, f"(?i){p}", 1).try_cast("long") for p in ps]])
    out = {f"{p}_{m}": hit(ps) for p, ms in COUNTERS.items() for m, ps in ms.items()}
    out["has_sharing"], out["has_likes"], out["has_comments"] = html.rlike(f"(?i){SHARING}|{WIDGETS}"), html.rlike(f"(?i){LIKING}"), html.rlike(f"(?i){COMMENTING}")
    tags = F.array_distinct(F.transform(F.regexp_extract_all(html, F.lit(r"#([\p{L}\p{N}_]+)"), 1), lambda t: F.lower(t)))
    out["hashtags"] = F.slice(F.array_sort(F.filter(tags, lambda t: (F.length(t) > 1) & ~t.rlike(r"^\d+$"))), 1, 20)
    seen = F.concat(*[F.regexp_extract_all(html, F.lit(p), 0) for p in (r"@[\p{L}\p{N}_]+", r"(?i)facebook\.com/[^/\s]+", r"(?i)linkedin\.com/in/[^/\s]+")])
    out["mentions"] = F.slice(F.array_sort(F.array_distinct(seen)), 1, 10)
    return out


def social_report(df: DataFrame) -> DataFrame:
    """Engagement, its level, leading platforms, confidence, proof and advice beside the columns of ``social``; what counts as
    engagement leaves downvotes out."""
    total = lambda p: sum((F.coalesce(f"{p}_{m}", F.lit(0)) for m in COUNTERS[p] if m != "downvotes"), F.lit(0).cast("long"))
    x = df.withColumns({f"{p}_total": total(p) for p in COUNTERS} | {f"{p}_seen": F.coalesce(*[F.col(f"{p}_{m}") for m in COUNTERS[p]]).isNotNull() for p in COUNTERS})
    n, e = sum(F.col(f"{p}_seen").cast("int") for p in COUNTERS), sum(F.col(f"{p}_total") for p in COUNTERS)
    x = x.withColumns({"platforms": n, "engagement": e})
    n, e = F.col("platforms"), F.col("engagement")
    flags = sum(F.col(c).cast("int") for c in ("has_sharing", "has_likes", "has_comments"))
    sure = F.when(n > 0, 0.4).otherwise(0.0) + F.when(n > 1, 0.2).otherwise(0.0) + F.when(e > 0, 0.3).otherwise(0.0) + F.when(e > 100, 0.1).otherwise(0.0) + flags * 0.1 + F.when(F.size("hashtags") > 0, 0.05).otherwise(0.0) + F.when(F.size("mentions") > 0, 0.05).otherwise(0.0)
    proof = (flags + (n > 0).cast("int") + (e > 0).cast("int") + (F.size("mentions") > 0).cast("int")) / 6
    tops = F.array_sort(F.filter(F.array(*[F.struct((-F.col(f"{p}_total")).alias("n"), F.lit(i).alias("i"), F.lit(p).alias("p")) for i, p in enumerate(COUNTERS)]), lambda s: s["n"] < 0))
    advice = F.array_compact(F.array(F.when(~F.col("has_sharing"), "add_sharing"), F.when(~F.col("has_likes"), "add_likes"), F.when(~F.col("has_comments"), "add_comments"), F.when(e < 10, "promote")))
    return x.withColumns({
        "level": F.when(e == 0, "none").when(e < 10, "low").when(e < 100, "moderate").when(e < 1000, "high").otherwise("viral"), "leading": F.transform(F.slice(tops, 1, 3), lambda s: s["p"]), "confidence": F.least(F.lit(1.0), sure),
        "proof": F.when(proof >= 0.8, "strong").when(proof >= 0.5, "moderate").when(proof >= 0.2, "weak").otherwise("none"), "advice": advice,
    }).drop(*[f"{p}_seen" for p in COUNTERS])


def regex_meta(html: Column) -> dict[str, Column]:
    """Title, named meta tags and OpenGraph by patterns alone, where a page cannot be parsed; the last of equal tags wins."""
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<meta\s+([^>]+)>"), 1)

    def last(attr: str, name: str):
        own = F.filter(tags, lambda t: t.rlike(rf"(?i)\b{attr}=[\"']{re.escape(name)}[\"']") & t.rlike(r"(?i)\bcontent=[\"']"))
        return F.regexp_extract(F.element_at(F.concat(F.array(F.lit("")), own), -1), r"(?i)\bcontent=[\"'](.*?)[\"']", 1)

    out = {"meta_title": F.trim(F.regexp_extract(html, r"(?i)<title[^>]*>([^<]+)</title>", 1))}
    out |= {f"meta_{n}": last("name", n) for n in ("description", "keywords", "author", "robots")}
    return out | {f"og_{n}": last("property", f"og:{n}") for n in ("title", "description", "type", "url")}


def html_flags(html: Column) -> dict[str, Column]:
    """Whether a page has a title, headings, paragraphs, lists, links, images, a description, structured data, an author and a date."""
    p = {"has_title": r"<title[^>]*>[^<]+</title>", "has_headings": r"<h[1-6][^>]*>", "has_paragraphs": r"<p[^>]*>", "has_lists": r"<[ou]l[^>]*>", "has_links": r"<a\s[^>]*href", "has_images": r"<img[^>]*>", "has_description": r"<meta[^>]*name=[\"']description[\"']", "has_structured": r"application/ld\+json|itemscope", "has_author": r"<meta[^>]*name=[\"']author[\"']|class=[\"'][^\"']*author", "has_date": r"<time[^>]*>|article:published_time|datePublished"}
    return {k: html.rlike(f"(?i){v}") for k, v in p.items()}


def meta_completeness(flags: DataFrame) -> Column:
    """Mean of title, description, structured data, author and date flags."""
    return sum(F.col(c).cast("int") for c in ("has_title", "has_description", "has_structured", "has_author", "has_date")) / 5


def page_record(parts: DataFrame, now: Column) -> DataFrame:
    """One metadata row for each page: OpenGraph before schema before meta for title and description, best author, best date, and the
    confidence of its structured data."""
    f = lambda *names: F.coalesce(*[F.nullif(F.element_at("fields", n), F.lit("")) for n in names])
    x = parts.withColumns({"authors": merged_authors(F.col("authors")), "dates": ranked_dates(F.col("dates"), now)})
    return x.select(
        "request_id", "ts", f("og_title", "schema_title", "meta_title").alias("title"), f("og_description", "schema_description", "meta_description").alias("description"), F.coalesce(F.get("authors", F.lit(0))["name"], f("meta_author")).alias("author"),
        F.get("dates", F.lit(0))["date"].alias("published_date"), F.get("dates", F.lit(0))["confidence"].alias("date_confidence"), F.get("dates", F.lit(0))["origin"].alias("date_origin"), f("canonical_url").alias("canonical_url"), f("schema_type").alias("schema_type"), f("og_type").alias("og_type"), f("meta_keywords").alias("keywords"),
        F.size("authors").alias("n_authors"), F.size("dates").alias("n_dates"), F.size("micro").alias("n_microdata"), "n_json_ld", structured_confidence(F.col("fields"), F.col("n_json_ld")).alias("confidence"),
    )


# Words of the three flags of each domain; True where letter case counts.
DOMAIN_FLAGS = {
    "medical": (("has_medical_terms", False, ("patient", "diagnosis", "treatment", "clinical", "medical")), ("has_citations", False, ("pubmed", "doi:")), ("has_disclaimers", False, ("disclaimer", "consult", "physician", "doctor"))),
    "legal": (("has_legal_citations", True, ("v.", "F.2d", "F.3d", "U.S.C.", "C.F.R.")), ("has_jurisdiction", False, ("court", "federal", "state", "district")), ("has_case_law", False, ("precedent", "ruling"))),
    "ecommerce": (("has_price", True, ("$", "€", "£", "¥")), ("has_reviews", False, ("review", "rating", "stars", "customer")), ("has_product_info", False, ("sku", "model", "brand", "warranty"))),
    "technical": (("has_code_examples", False, ("function", "class", "import", "def ", "var ")), ("has_api_docs", False, ("api", "endpoint", "request", "response")), ("has_version_info", True, ("v1.", "v2.", "version", "release"))),
}


def domain_flags(text: Column, kind: Column) -> dict[str, Column]:
    """The flags of a text's own domain; null for other domains."""
    whole = F.coalesce(text, F.lit(""))
    low = F.lower(whole)
    return {n: F.when(kind == k, reduce(lambda a, b: a | b, [(whole if cased else low).contains(w) for w in ws])) for k, fs in DOMAIN_FLAGS.items() for n, cased, ws in fs}


def _pages(spark, d):
    return table(spark, d, "crawl_results").select("request_id", "ts", F.coalesce("final_url", "url").alias("url"), "content")


def _html(spark, d):
    return table(spark, d, "crawl_results").select("request_id", "ts", html_text(F.col("content")).alias("html"))


def _now() -> Column:
    return F.lit("2026-01-01").cast("timestamp_ntz")


def page_metadata(spark, d):
    return page_record(page_metadata_parts(_pages(spark, d)), _now())


def page_authors(spark, d):
    """Authors of each page, merged and ranked."""
    t = page_metadata_parts(_pages(spark, d)).select("request_id", "ts", F.posexplode(merged_authors(F.col("authors"))).alias("rank", "a"))
    return t.select("request_id", "ts", "rank", "a.*")


def page_dates(spark, d):
    """All plausible dates of each page, ranked."""
    t = page_metadata_parts(_pages(spark, d)).select("request_id", "ts", F.posexplode(ranked_dates(F.col("dates"), _now())).alias("rank", "x"))
    return t.select("request_id", "ts", "rank", "x.*")


def page_social(spark, d):
    x = _html(spark, d).select("request_id", "ts", *[c.alias(k) for k, c in social(F.col("html")).items()])
    return social_report(x).select("request_id", "ts", "platforms", "engagement", "level", "has_sharing", "has_likes", "has_comments", F.size("hashtags").alias("n_hashtags"), F.size("mentions").alias("n_mentions"), F.round("confidence", 6).alias("confidence"), "proof")


def page_meta_regex(spark, d):
    return _html(spark, d).select("request_id", "ts", *[c.alias(k) for k, c in regex_meta(F.col("html")).items()])


def page_flags(spark, d):
    x = _html(spark, d).select("request_id", "ts", *[c.alias(k) for k, c in html_flags(F.col("html")).items()])
    return x.withColumn("completeness", F.round(meta_completeness(x), 6))


def domain_metadata_flags(spark, d):
    t = table(spark, d, "documents")
    return t.select("doc_id", *[c.alias(k) for k, c in domain_flags(F.col("text"), F.col("domain_type")).items()])


QUERIES = {f.__name__: f for f in (page_metadata, page_authors, page_dates, page_social, page_meta_regex, page_flags, domain_metadata_flags)}

ORACLE = {
    "domain_metadata_flags": "select doc_id, " + ", ".join(f"case when domain_type = '{k}' then " + " or ".join(f"contains({'coalesce(text, {0})' if cased else 'lower(coalesce(text, {0}))'}, '{w}')".format("''") for w in ws) + f" end as {n}" for k, fs in DOMAIN_FLAGS.items() for n, cased, ws in fs) + " from documents",
}
