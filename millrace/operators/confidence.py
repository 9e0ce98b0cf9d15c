"""Quality of metadata from fourteen factors, and confidence in an extraction from six components, as native expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.links import netloc
from millrace.sources import table

# Weights of the factors and of the extraction components, factors by category.
FACTORS = {
    "content_length": 0.15, "readability": 0.15, "lexical_diversity": 0.10, "grammar_quality": 0.10, "html_structure": 0.10, "semantic_markup": 0.08, "accessibility": 0.07, "metadata_completeness": 0.08,
    "author_credibility": 0.05, "publication_info": 0.05, "social_proof": 0.03, "multimedia_content": 0.02, "dom_complexity": 0.01, "performance_impact": 0.01,
}
CATEGORIES = {"content": ("content_length", "readability", "lexical_diversity", "grammar_quality"), "technical": ("html_structure", "semantic_markup", "accessibility", "dom_complexity", "performance_impact"), "metadata": ("metadata_completeness", "author_credibility", "publication_info"), "engagement": ("social_proof", "multimedia_content")}
COMPONENTS = {"content_length": 0.15, "structure_quality": 0.20, "text_quality": 0.25, "extraction_method": 0.15, "html_quality": 0.15, "domain_specific": 0.10}
# Reliability of extraction methods by a part of their name, in order.
RELIABILITY = {"trafilatura": 0.95, "selectolax": 0.85, "llm_assisted": 0.90, "heuristic_fallback": 0.60}
# Words that speak for and against a text, and those of navigation.
GOOD = ("article|paragraph|section|content", "introduction|conclusion|summary", "first|second|third|finally|however|therefore")
BAD = ("click here|read more|advertisement|sponsored", "cookie|privacy|terms|conditions", "loading|error|404|not found")
NAVIGATION = ("home|about|contact|menu|navigation", "previous|next|back|forward", "login|register|sign up|sign in")
# Hosts that are trusted, terms of academic, official and news texts, and of advertising.
TRUSTED = ("wikipedia.org", "britannica.com", "nature.com", "sciencedirect.com", "pubmed.ncbi.nlm.nih.gov", "arxiv.org", "jstor.org", "springer.com", "gov", "edu", "ac.uk", "edu.au")
ACADEMIC_HOSTS, ACADEMIC = ("edu", "ac.", "arxiv", "pubmed"), ("research", "study", "analysis", "methodology", "conclusion")
OFFICIAL = ("official", "regulation", "policy", "public", "federal")
NEWS_HOSTS, NEWS = ("bbc.", "cnn.", "reuters.", "ap.org", "npr.org", "nytimes."), ("reported", "according to", "sources say")
ADVERTISING = ("click here", "buy now", "free trial", "limited time", "act now", "call now", "subscribe", "sign up now")
SEMANTIC, CONTENT_MARKS = ("article", "section", "main", "header", "footer", "nav", "aside"), ('class="content"', 'class="article"', 'class="post"', 'id="content"')


def _in(c: Column, parts) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(p) for p in parts])


def _between(c: Column, *bands) -> Column:
    """The value of the first closed band (low, high, value) that holds ``c``; the last item is the value elsewhere."""
    return reduce(lambda e, b: e.when(c.between(b[0], b[1]), b[2]), bands[1:-1], F.when(c.between(bands[0][0], bands[0][1]), bands[0][2])).otherwise(bands[-1])


def _least(c: Column, *steps) -> Column:
    """The value of the first step (low, value) that ``c`` reaches; the last item is the value below all."""
    return reduce(lambda e, s: e.when(c >= s[0], s[1]), steps[1:-1], F.when(c >= steps[0][0], steps[0][1])).otherwise(steps[-1])


def length_factor(words: Column) -> Column:
    return _least(words, (1000, 1.0), (500, 0.9), (300, 0.8), (150, 0.6), (50, 0.4), 0.2)


def readability_factor(ease: Column) -> Column:
    return F.when(ease.isNull(), 0.5).otherwise(_between(ease, (40, 70, 1.0), (30, 80, 0.8), (20, 90, 0.6), (10, 95, 0.4), 0.2))


def grammar_factor(*flags: Column) -> Column:
    """Mean of the flags for capitals, marks, few typos and coherence."""
    return sum(F.coalesce(f, F.lit(False)).cast("int") for f in flags) / len(flags)


def structure_factor(headings: Column, semantic: Column, ratio: Column, complexity: Column) -> Column:
    return F.least(F.lit(1.0), headings.cast("int") * 0.3 + semantic.cast("int") * 0.3 + _least(ratio, (0.2, 0.2), (0.1, 0.1), 0.0) + complexity * 0.2)


def semantic_factor(semantic: Column, kinds: Column) -> Column:
    return F.least(F.lit(1.0), semantic.cast("int") * 0.5 + (kinds > 0).cast("int") * 0.3 + _least(kinds, (3, 0.2), (1, 0.1), 0.0))


def completeness_factor(*present: Column) -> Column:
    """Share of eight: title, description, author, date, structured data, category, meta tags, image."""
    return sum(F.coalesce(p, F.lit(False)).cast("int") for p in present) / 8


def author_factor(confidence: Column, *details: Column) -> Column:
    """The best author's confidence and a tenth for each of address, page and biography; 0 without an author."""
    return F.when(confidence.isNull(), 0.0).otherwise(F.least(F.lit(1.0), confidence + sum((d.isNotNull().cast("int") * 0.1 for d in details), F.lit(0.0))))


def publication_factor(date: Column, confidence: Column, good_url: Column) -> Column:
    return F.least(F.lit(1.0), F.when(date.isNotNull(), 0.5 + F.coalesce(confidence, F.lit(0.0)) * 0.3).otherwise(0.0) + F.coalesce(good_url, F.lit(False)).cast("int") * 0.2)


def social_factor(engagement: Column, sharing: Column, platforms: Column) -> Column:
    return F.least(F.lit(1.0), F.when(engagement > 100, 0.4).when(engagement > 10, 0.2).when(engagement > 0, 0.1).otherwise(0.0) + sharing.cast("int") * 0.2 + _least(platforms, (3, 0.3), (1, 0.1), 0.0))


def media_factor(featured: Column, images: Column, videos: Column, audio: Column) -> Column:
    return F.least(F.lit(1.0), F.coalesce(featured, F.lit(False)).cast("int") * 0.3 + (images > 0).cast("int") * 0.4 + (videos > 0).cast("int") * 0.2 + (audio > 0).cast("int") * 0.1)


def updated_weights(base: dict, changes: dict) -> dict:
    """Weights with some changed, made to sum to 1 again."""
    new = {k: changes.get(k, v) for k, v in base.items()}
    total = sum(new.values())
    return {k: v / total for k, v in new.items()} if total > 0 else dict(base)


def metadata_quality(df: DataFrame, weights: dict | None = None) -> DataFrame:
    """Overall score, category means over factors above 0, grade parts and the lists of strong (0.8 or more) and weak (below 0.4)
    factors, beside columns named like FACTORS; nulls count as 0."""
    w = weights or FACTORS
    x = df.withColumns({k: F.coalesce(k, F.lit(0.0)) for k in FACTORS})
    x = x.withColumn("overall", sum(F.col(k) * v for k, v in w.items()) / sum(w.values()))
    mean = lambda ks: F.coalesce(F.try_divide(sum(F.col(k) for k in ks), sum((F.col(k) > 0).cast("int") for k in ks)), F.lit(0.0))
    lists = lambda test: F.array_compact(F.array(*[F.when(test(F.col(k)), F.lit(k)) for k in FACTORS]))
    return x.withColumns({f"{c}_quality": mean(ks) for c, ks in CATEGORIES.items()} | {"strengths": lists(lambda c: c >= 0.8), "weaknesses": lists(lambda c: c < 0.4), "factors_used": sum((F.col(k) > 0).cast("int") for k in FACTORS)})


def extraction_confidence(text: Column, method: Column, url: Column, html: Column | None, errors: Column) -> dict[str, Column]:
    """The six components and their weighted sum less a tenth for each error, three tenths at most; an empty text has 0."""
    t = F.coalesce(text, F.lit(""))
    low, n = F.lower(t), F.length(t)
    words = F.filter(F.split(low, r"\s+"), lambda w: w != "")
    n_words = F.size(words)
    trimmed = F.transform(F.split(t, "[.!?]+"), lambda s: F.length(F.trim(F.regexp_replace(s, r"\s+", " "))))
    n_sent = F.size(F.filter(trimmed, lambda s: s > 0))
    n_par = F.size(F.filter(F.split(t, r"\n\s*\n"), lambda p: F.trim(F.regexp_replace(p, r"\s+", " ")) != ""))
    distinct = F.when(n_words > 0, F.size(F.array_distinct(words)) / n_words).otherwise(F.lit(0.0))
    density = lambda ps: sum(F.regexp_count(low, F.lit(rf"\b(?:{p})\b")) for p in ps) * 100 / F.greatest(n, F.lit(1))
    n_valid = F.size(F.filter(trimmed, lambda s: s > 10))
    quality = 0.5 + F.least(F.lit(0.3), density(GOOD) * 10) - F.least(F.lit(0.4), density(BAD) * 20) - F.least(F.lit(0.2), density(NAVIGATION) * 15)
    quality += F.when((n_valid > 0) & (F.try_divide(n, n_valid)).between(50, 150), 0.1).otherwise(0.0) - F.when((n_words > 20) & (distinct < 0.3), 0.2).otherwise(0.0)
    host = netloc(url)
    times = lambda ws: sum(F.regexp_count(low, F.lit(w)) for w in ws)
    wiki = _in(low, ("references", "citation")).cast("int") * 0.1 + (n > 1000).cast("int") * 0.1
    domain = 0.5 + _in(host, TRUSTED).cast("int") * 0.3 + F.when(host.contains("wikipedia.org"), wiki).when(_in(host, ACADEMIC_HOSTS), (times(ACADEMIC) > 5).cast("int") * 0.2).when(host.contains("gov"), (times(OFFICIAL) > 3).cast("int") * 0.2).otherwise(0.0)
    domain += (_in(host, NEWS_HOSTS) & _in(low, NEWS)).cast("int") * 0.1 - (times(ADVERTISING) > 3).cast("int") * 0.3
    clamp = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    if html is None:
        page = F.lit(0.5)
    else:
        lh = F.lower(F.coalesce(html, F.lit("")))
        seen = F.length(F.trim(F.regexp_replace(F.regexp_replace(lh, r"<[^>]+>", " "), r"\s+", " ")))
        share = F.try_divide(n, seen)
        got = F.when(seen == 0, 0.0).when(share.between(0.2, 0.8), 0.3).when((share >= 0.1) & (share < 0.2), 0.1).when((share > 0.8) & (share <= 1.0), 0.2).otherwise(-0.1)
        marks = sum(F.regexp_count(lh, F.lit(f"<{e}")) for e in SEMANTIC)
        heavy = (F.regexp_count(lh, F.lit("<script")) + F.regexp_count(lh, F.lit("<style"))) / F.greatest(F.regexp_count(lh, F.lit("<")), F.lit(1))
        page = F.when(lh == "", 0.5).otherwise(clamp(0.5 + got + F.least(F.lit(0.2), marks * 0.05) + _in(lh, CONTENT_MARKS).cast("int") * 0.1 - F.when(heavy > 0.1, F.least(F.lit(0.2), heavy)).otherwise(0.0)))
    parts = {
        "content_length": F.when(n < 50, 0.0).when(n < 200, 0.3).when(n < 500, 0.6).when(n <= 5000, 1.0).when(n <= 10000, 0.9).when(n <= 20000, 0.7).otherwise(0.5),
        "structure_quality": (n_words > 50).cast("int") * 0.3 + (n_sent > 3).cast("int") * 0.2 + (n_par > 1).cast("int") * 0.2 + (distinct > 0.3).cast("int") * 0.3,
        "text_quality": clamp(quality), "extraction_method": F.coalesce(*[F.when(F.lower(method).contains(k), F.lit(v)) for k, v in RELIABILITY.items()], F.lit(0.5)), "html_quality": page, "domain_specific": clamp(domain),
    }
    total = sum(parts[k] * w for k, w in COMPONENTS.items()) * (1 - F.least(F.lit(0.3), F.coalesce(errors, F.lit(0)) * 0.1))
    return parts | {"confidence": F.when(t == "", 0.0).otherwise(clamp(total))}


def valid_extraction(text: Column, errors: Column, confidence: Column, least: int = 50) -> Column:
    """Enough text, no errors, and a confidence of two tenths where one is known."""
    return (F.length(F.trim(F.coalesce(text, F.lit("")))) >= least) & (F.coalesce(errors, F.lit(0)) == 0) & (F.coalesce(confidence, F.lit(1.0)) >= 0.2)


def _extractions(spark, d):
    e = table(spark, d, "extracted_content").select("extract_id", "url", "text", "extraction_method", "confidence_score")
    parts = extraction_confidence(F.col("text"), F.col("extraction_method"), F.col("url"), None, F.lit(0))
    return e.select("extract_id", "text", "confidence_score", F.col("extraction_method").alias("method"), *[c.alias(k) for k, c in parts.items()])


def extraction_scores(spark, d):
    """Components and confidence of each record."""
    x = _extractions(spark, d)
    return x.select("extract_id", *[F.round(k, 6).alias(k) for k in (*COMPONENTS, "confidence")], valid_extraction(F.col("text"), F.lit(0), F.col("confidence")).alias("valid"))


def extraction_benchmark(spark, d):
    """Count, mean, least and greatest confidence, and the means of the components, by method and in all."""
    return _extractions(spark, d).rollup("method").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 6).alias("mean"), F.round(F.min("confidence"), 6).alias("least"), F.round(F.max("confidence"), 6).alias("most"), *[F.round(F.avg(k), 6).alias(k) for k in COMPONENTS if k != "extraction_method"])


def metadata_scores(spark, d):
    """Metadata quality of each page from its measures, record and signals."""
    from millrace.functions.facts import few_typos
    from millrace.functions.markup import dom_scores, html_text, page_dom
    from millrace.functions.metadata import html_flags, meta_completeness, page_metadata_parts, page_record, social, social_report

    raw = table(spark, d, "crawl_results").select("request_id", "ts", F.coalesce("final_url", "url").alias("url"), "content").dropDuplicates(["request_id", "ts"])
    key = ["request_id", "ts"]
    shape = dom_scores(page_dom(raw)).select(*key, "has_semantic", "has_headings", "text_ratio", "complexity_score", "accessibility_score", "size_score", "semantic", "images", "videos", "audio")
    record = page_record(page_metadata_parts(raw), F.lit("2026-01-01").cast("timestamp_ntz")).select(*key, "title", "description", "author", "published_date", "date_confidence", "confidence")
    html = raw.select(*key, "url", html_text(F.col("content")).alias("html"))
    flags = html.select(*key, *[c.alias(k) for k, c in html_flags(F.col("html")).items()])
    signs = social_report(html.select(*key, *[c.alias(k) for k, c in social(F.col("html")).items()])).select(*key, "engagement", "has_sharing", "platforms")
    e = table(spark, d, "extracted_content").select("request_id", "text").dropDuplicates(["request_id"])
    j = shape.join(record, key).join(flags.withColumn("meta", meta_completeness(flags)).select(*key, "meta"), key).join(signs, key).join(e, "request_id", "left").join(html.select(*key, F.col("url").rlike("^https?://[^?]+$").alias("good_url")), key)
    n = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != ""))
    present = [F.col(c).isNotNull() for c in ("title", "description", "author", "published_date")]
    return metadata_quality(j.withColumns({
        "content_length": length_factor(n), "readability": F.lit(0.5), "lexical_diversity": F.lit(0.0), "grammar_quality": grammar_factor(few_typos(F.col("text"))), "html_structure": structure_factor(F.col("has_headings"), F.col("has_semantic"), F.col("text_ratio"), F.col("complexity_score")), "semantic_markup": semantic_factor(F.col("has_semantic"), F.col("semantic")),
        "accessibility": F.col("accessibility_score"), "metadata_completeness": completeness_factor(*present, F.col("confidence") > 0, F.lit(False), F.col("meta") > 0.5, F.lit(False)), "author_credibility": author_factor(F.when(F.col("author").isNotNull(), 0.6)), "publication_info": publication_factor(F.col("published_date"), F.col("date_confidence"), F.col("good_url")),
        "social_proof": social_factor(F.col("engagement"), F.col("has_sharing"), F.col("platforms")), "multimedia_content": media_factor(F.lit(False), F.col("images"), F.col("videos"), F.col("audio")), "dom_complexity": F.col("complexity_score"), "performance_impact": F.col("size_score"),
    })).select(*key, F.round("overall", 6).alias("overall"), *[F.round(f"{c}_quality", 6).alias(f"{c}_quality") for c in CATEGORIES], "strengths", "weaknesses", "factors_used")


QUERIES = {f.__name__: f for f in (extraction_scores, extraction_benchmark, metadata_scores)}


def _sql() -> str:
    dens = lambda ps: "(" + " + ".join(rf"len(regexp_extract_all(low, '\b(?:{p})\b'))" for p in ps) + ") * 100 / greatest(n, 1)"
    some = lambda c, ps: "(" + " or ".join(f"contains({c}, '{p}')" for p in ps) + ")"
    times = lambda ws: "(" + " + ".join(f"len(regexp_extract_all(low, '{w}'))" for w in ws) + ")"
    blank = r"lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'), ' ') <> ''"
    return rf"""with a as (select extract_id, extraction_method as method, coalesce(text, '') as t, lower(coalesce(text, '')) as low, length(coalesce(text, '')) as n, lower(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)', 1)) as host from extracted_content),
b as (select *, list_filter(string_split_regex(low, '\s+'), lambda x: x <> '') as w, list_transform(string_split_regex(t, '[.!?]+'), lambda s: length(trim(regexp_replace(s, '\s+', ' ', 'g'), ' '))) as tl, len(list_filter(string_split_regex(t, '\n\s*\n'), {blank})) as np from a),
c as (select *, len(w) as nw, case when len(w) > 0 then len(list_distinct(w)) / len(w) else 0 end as dv, len(list_filter(tl, lambda x: x > 0)) as ns, len(list_filter(tl, lambda x: x > 10)) as nv from b),
p as (select extract_id, method, t, case when n < 50 then 0 when n < 200 then 0.3::double when n < 500 then 0.6::double when n <= 5000 then 1 when n <= 10000 then 0.9::double when n <= 20000 then 0.7::double else 0.5::double end as content_length,
 (nw > 50)::int * 0.3::double + (ns > 3)::int * 0.2::double + (np > 1)::int * 0.2::double + (dv > 0.3)::int * 0.3::double as structure_quality,
 greatest(0, least(1, 0.5::double + least(0.3::double, {dens(GOOD)} * 10) - least(0.4::double, {dens(BAD)} * 20) - least(0.2::double, {dens(NAVIGATION)} * 15) + case when nv > 0 and n / nv between 50 and 150 then 0.1::double else 0 end - case when nw > 20 and dv < 0.3 then 0.2::double else 0 end)) as text_quality,
 case {' '.join(f"when contains(lower(method), '{k}') then {v}::double" for k, v in RELIABILITY.items())} else 0.5::double end as extraction_method, 0.5::double as html_quality,
 greatest(0, least(1, 0.5::double + {some('host', TRUSTED)}::int * 0.3::double + case when contains(host, 'wikipedia.org') then {some('low', ('references', 'citation'))}::int * 0.1::double + (n > 1000)::int * 0.1::double when {some('host', ACADEMIC_HOSTS)} then ({times(ACADEMIC)} > 5)::int * 0.2::double when contains(host, 'gov') then ({times(OFFICIAL)} > 3)::int * 0.2::double else 0 end + ({some('host', NEWS_HOSTS)} and {some('low', NEWS)})::int * 0.1::double - ({times(ADVERTISING)} > 3)::int * 0.3::double)) as domain_specific from c),
q as (select *, case when t = '' then 0 else greatest(0, least(1, {' + '.join(f'{k} * {w}::double' for k, w in COMPONENTS.items())})) end as confidence from p)
"""


ORACLE = {
    "extraction_scores": _sql() + "select extract_id, " + ", ".join(f"round({k}, 6) as {k}" for k in (*COMPONENTS, "confidence")) + ", length(trim(t, ' ')) >= 50 and confidence >= 0.2 as valid from q",
    "extraction_benchmark": _sql() + "select method, count(*) as n, round(avg(confidence), 6) as mean, round(min(confidence), 6) as least, round(max(confidence), 6) as most, " + ", ".join(f"round(avg(q.{k}), 6) as {k}" for k in COMPONENTS if k != "extraction_method") + " from q group by rollup(method)",
}
