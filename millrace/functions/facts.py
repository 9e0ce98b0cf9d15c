"""Facts named in texts - citations, specifications, reviews, stock, interfaces, performance - and checks of whole texts.

All are native expressions. Lists keep every hit in order of occurrence; a null text holds nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.sources import table

from .entities import any_of
from .text_metrics import flesch, sentences, total_syllables, words

# Patterns with the groups that are kept.
CASES = r"(?i)\b([A-Za-z0-9_]+\s+v\.?\s+[A-Za-z0-9_]+),?\s*(\d+\s+[A-Z][a-z]*\.?\s*\d+d?\s*\d+)(?:\s*\((\d{4})\))?"
STATUTES = r"(?i)\b(\d+)\s+(U\.?S\.?C\.?)\s*§?\s*(\d+)\b"
SPECIFICATION = r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*):?\s*([^,\n;]+)"
NO_SPECIFICATION = ("click", "see", "more")
RATING = r"(?i)(\d+(?:\.\d+)?)\s*(?:stars?|/5|out of 5)"
REVIEWS = r"(?i)(\d{1,9})\s*reviews?"
QUANTITY = r"(?i)(\d{1,9})\s*(?:left|remaining|available|in stock)"
STOCK_PHRASE = r"(?i)((?:in stock|out of stock|available|unavailable)[^.!?]*)"
#: Words of four or more letters, words with digits, inner capitals.
ODD_WORDS = (r"[A-Za-z0-9_]*[A-Za-z0-9_]{3}[A-Za-z0-9_]+", r"[A-Za-z0-9_]*[0-9]+[A-Za-z0-9_]*", r"(?:^|[^A-Za-z0-9_])[a-z][A-Z]")
STOCK = {"in_stock": ("in stock", "available now", "ready to ship"), "out_of_stock": ("out of stock", "sold out", "unavailable"), "backordered": ("backordered", "pre-order", "coming soon")}
ENDPOINT = r"(?i)\b(GET|POST|PUT|DELETE|PATCH)\s+(/[A-Za-z0-9_/\-:{}]*)"
AUTH = r"\b(Basic|Bearer|OAuth|API Key|Token)\b"
MEDIA_TYPE = r"\b((?:application/json|application/xml|application/csv|application/html|text/csv|text/plain))\b"
MEASURES = {"timing": r"(?i)(\d+(?:\.\d+)?)\s*(ms|milliseconds?|seconds?|minutes?|hours?)", "throughput": r"(?i)(\d+(?:\.\d+)?)\s*(MB/s|GB/s|Mbps|Gbps|requests?/s)", "memory": r"(?i)(\d+(?:\.\d+)?)\s*(KB|MB|GB|TB)"}
DISCOUNTS = (r"(?i)(\d+)%\s*off", r"(?i)save\s*\$(\d+(?:\.\d{2})?)", r"(?i)was\s*\$(\d+(?:\.\d{2})?)")
CURRENCY_CODES = r"(?i)(\d+\.\d{2})\s*(USD|EUR|GBP|CAD|AUD)"
TOPIC = r"(?:^|[^\p{L}\p{N}_])([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)"
KNOWN_TOPIC = r"\b(artificial intelligence|machine learning|data science|cloud computing)\b"
CONNECTIVES, EVIDENCE = ("because", "therefore", "however", "although"), ("study", "research", "analysis", "data", "results")
DANGEROUS_CALLS = ("eval(", "document.write", "innerhtml", "settimeout(", "setinterval(")
# Names of language codes.
LANGUAGE_NAMES = {
    "en": "English", "es": "Spanish", "fr": "French", "de": "German", "it": "Italian", "pt": "Portuguese", "ru": "Russian", "zh": "Chinese", "ja": "Japanese", "ko": "Korean", "ar": "Arabic", "hi": "Hindi", "th": "Thai", "nl": "Dutch", "sv": "Swedish",
    "no": "Norwegian", "da": "Danish", "fi": "Finnish", "pl": "Polish", "tr": "Turkish", "cs": "Czech", "hu": "Hungarian", "el": "Greek", "he": "Hebrew", "vi": "Vietnamese", "id": "Indonesian", "ms": "Malay", "uk": "Ukrainian", "ro": "Romanian", "bg": "Bulgarian",
}
# Stop words of the plain language guess.
GUESS_WORDS = {"es": ("el", "la", "los", "las", "de", "que", "y", "en", "un", "una", "es", "por", "con", "para"), "de": ("der", "die", "das", "und", "ist", "in", "zu", "den", "mit", "von", "ein", "eine", "nicht")}


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(_text(text), F.lit(pattern), group)


def _some(text: Column, parts) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(p) for p in parts])


def citations(text: Column) -> Column:
    """Cases (name, citation, year) and statutes (title, code, section)."""
    cases = F.arrays_zip(*[_all(text, CASES, i).alias(n) for i, n in ((1, "name"), (2, "citation"), (3, "year"))])
    statutes = F.arrays_zip(*[_all(text, STATUTES, i).alias(n) for i, n in ((1, "title"), (2, "code"), (3, "section"))])
    return F.struct(F.transform(cases, lambda c: F.struct(F.trim(c["name"]).alias("name"), F.trim(c["citation"]).alias("citation"), F.nullif(c["year"], F.lit("")).alias("year"))).alias("cases"), statutes.alias("statutes"))


def specifications(text: Column) -> Column:
    """Key and value pairs with values below 50 characters; the last value of a key wins."""
    pairs = F.arrays_zip(F.transform(_all(text, SPECIFICATION, 1), lambda k: F.replace(F.lower(F.trim(k)), F.lit(" "), F.lit("_"))).alias("k"), F.transform(_all(text, SPECIFICATION, 2), lambda v: F.trim(v)).alias("v"))
    kept = F.filter(pairs, lambda p: (F.length(p["v"]) < 50) & ~_some(F.lower(p["v"]), NO_SPECIFICATION))
    keys = F.array_distinct(F.transform(kept, lambda p: p["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(kept, lambda p: p["k"] == k), -1)["v"]))


def reviews(text: Column) -> Column:
    """Ratings, their mean (null without any) and the greatest number of reviews."""
    r = F.transform(_all(text, RATING), lambda x: x.cast("double"))
    mean = F.when(F.size(r) > 0, F.aggregate(r, F.lit(0.0), lambda a, x: a + x) / F.size(r))
    return F.struct(r.alias("ratings"), mean.alias("mean"), F.coalesce(F.array_max(F.transform(_all(text, REVIEWS), lambda x: x.cast("long"))), F.lit(0)).alias("reviews"))


def stock(text: Column) -> Column:
    """Availability, greatest quantity named (null without any) and the phrases that speak of it."""
    low = F.lower(_text(text))
    status = F.coalesce(*[F.when(_some(low, ps), F.lit(k)) for k, ps in STOCK.items()], F.lit("unknown"))
    return F.struct(status.alias("status"), F.array_max(F.transform(_all(text, QUANTITY), lambda x: x.cast("long"))).alias("quantity"), _all(text, STOCK_PHRASE).alias("phrases"))


def interfaces(text: Column) -> Column:
    """Endpoints as method and path, authentication schemes and media types."""
    points = F.zip_with(_all(text, ENDPOINT, 1), _all(text, ENDPOINT, 2), lambda m, p: F.concat_ws(" ", F.upper(m), p))
    return F.struct(points.alias("endpoints"), F.array_sort(F.array_distinct(_all(text, AUTH))).alias("authentication"), _all(text, MEDIA_TYPE).alias("media_types"))


def measures(text: Column) -> Column:
    """Values and units of time, throughput and memory."""
    one = lambda p: F.zip_with(_all(text, p, 1), _all(text, p, 2), lambda v, u: F.struct(v.cast("double").alias("value"), F.lower(u).alias("unit")))
    return F.struct(*[one(p).alias(k) for k, p in MEASURES.items()])


def discounts(text: Column) -> Column:
    return F.concat(*[_all(text, p) for p in DISCOUNTS])


def currencies(text: Column) -> Column:
    """Currencies of the prices in a text, sorted: codes, and USD for signs, whose currency is not told apart."""
    signs = F.when(_text(text).rlike(r"[$€£]\d"), F.array(F.lit("USD"))).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.concat(signs, F.transform(_all(text, CURRENCY_CODES, 2), lambda c: F.upper(c)))))


def topics(text: Column, n: int = 5) -> Column:
    """The most frequent capitalised phrases and known topics of more than three characters; ties by first occurrence."""
    found = F.filter(F.concat(_all(text, TOPIC), _all(text, KNOWN_TOPIC)), lambda t: F.length(t) > 3)
    each = F.transform(F.array_distinct(found), lambda t, i: F.struct((-F.size(F.filter(found, lambda x: x == t))).alias("c"), i.alias("i"), t.alias("t")))
    return F.transform(F.slice(F.array_sort(each), 1, n), lambda x: x["t"])


def top_categories(text: Column, keywords: dict, n: int = 3, least: float = 0.1) -> Column:
    """The categories whose keywords occur most per thousand words, at least ``least``; the first listed on ties."""
    count = F.greatest(F.size(_words(text)), F.lit(1))
    rate = lambda ws: F.regexp_count(F.lower(_text(text)), F.lit(r"\b(?:" + "|".join(ws) + r")\b")) * 1000 / count
    ranked = F.array_sort(F.filter(F.array(*[F.struct((-rate(ws)).alias("s"), F.lit(i).alias("i"), F.lit(k).alias("k")) for i, (k, ws) in enumerate(keywords.items())]), lambda x: x["s"] <= -least))
    return F.transform(F.slice(ranked, 1, n), lambda x: x["k"])


def _words(text: Column) -> Column:
    return F.filter(F.split(_text(text), r"\s+"), lambda w: w != "")


def completeness(text: Column) -> Column:
    """Points for words, sentences, paragraphs, connectives and evidence words, at most 1."""
    n, low = F.size(_words(text)), F.lower(_text(text))
    s = F.size(F.split(_text(text), "[.!?]+"))
    p = F.size(F.filter(F.split(_text(text), "\n\n"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")) != ""))
    step = lambda c, *levels: reduce(lambda e, lv: e.when(c >= lv[0], lv[1]), levels[1:], F.when(c >= levels[0][0], levels[0][1])).otherwise(0.0)
    points = step(n, (300, 0.3), (100, 0.2), (50, 0.1)) + step(s, (5, 0.2), (3, 0.1)) + step(p, (3, 0.2), (2, 0.1)) + F.when(_some(low, CONNECTIVES), 0.2).otherwise(0.0) + F.when(_some(low, EVIDENCE), 0.1).otherwise(0.0)
    return F.least(F.lit(1.0), points)


def few_typos(text: Column) -> Column:
    """Whether words of four or more letters, words with digits and inner capitals are below five in a hundred; few texts are."""
    n = F.size(_words(text))
    hits = sum(F.regexp_count(_text(text), F.lit(p)) for p in ODD_WORDS)
    return (n > 0) & (hits < 0.05 * n)


def simple_readability(text: Column) -> Column:
    """Reading ease by single vowels as syllables, within 0..100; 0 without words or sentences."""
    w = _words(text)
    n, s = F.size(w), F.size(sentences(text))
    syl = F.aggregate(w, F.lit(0), lambda a, x: a + F.greatest(F.lit(1), F.regexp_count(x, F.lit("[aeiouAEIOU]"))))
    return F.when((n > 0) & (s > 0), F.greatest(F.lit(0.0), F.least(F.lit(100.0), 206.835 - 1.015 * n / s - 84.6 * syl / n))).otherwise(0.0)


def content_metrics(text: Column) -> dict[str, Column]:
    """Words, sentences, paragraphs, minutes at 200 words and the share of distinct words."""
    w = _words(F.lower(_text(text)))
    n = F.size(w)
    return {"words": n, "sentences": F.size(sentences(text)), "paragraphs": F.size(F.filter(F.split(_text(text), r"\n\s*\n"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")) != "")), "minutes": n / 200, "diversity": F.when(n > 0, F.size(F.array_distinct(w)) / n)}


def clean_for_language(text: Column) -> Column:
    """A text without addresses, digits and marks, white space collapsed, for language identification."""
    t = F.regexp_replace(_text(text), r"https?://\S+|www\.\S+", " ")
    t = F.regexp_replace(F.regexp_replace(t, r"\S+@\S+", " "), r"[0-9]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[^\p{L}\p{M}\s_]", " "), r"\s+", " "))


def language_name(code: Column) -> Column:
    """The name of a code, or the code in capitals."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in LANGUAGE_NAMES.items() for x in kv]), F.lower(code)), F.upper(code))


def guess_language(text: Column) -> Column:
    """en, es or de by whether three or more tokens are stop words of es or de; 'unknown' below ten characters. A stand-in without a model."""
    toks = F.split(F.lower(F.trim(_text(text))), r"\s+")
    hits = lambda k: F.size(F.filter(toks, lambda w: w.isin(*GUESS_WORDS[k]))) >= 3
    return F.when(F.length(F.trim(_text(text))) < 10, "unknown").when(hits("es"), "es").when(hits("de"), "de").otherwise("en")


def sanitize_html(text: Column) -> Column:
    """Script blocks, script addresses and event handlers removed."""
    t = F.regexp_replace(_text(text), r"(?is)<script[^>]*>.*?</script>", "")
    return F.regexp_replace(F.regexp_replace(t, r"(?i)javascript:", ""), r"(?i)\s+on[a-z]+\s*=\s*[\"'][^\"']*[\"']", "")


def script_verdict(code: Column) -> Column:
    """A fifth for each kind of dangerous call; above a half the code is blocked."""
    low = F.lower(_text(code))
    risk = sum(F.when(low.contains(c), 0.2).otherwise(0.0) for c in DANGEROUS_CALLS)
    return F.struct(risk.alias("risk"), (risk > 0.5).alias("blocked"))


def hashtags(text: Column) -> Column:
    """Distinct hashtags in lower case, longer than one character and no numbers, sorted, at most 20."""
    tags = F.transform(_all(text, r"#([\p{L}\p{N}_]+)"), lambda t: F.lower(t))
    return F.slice(F.array_sort(F.array_distinct(F.filter(tags, lambda t: (F.length(t) > 1) & ~t.rlike(r"^\d+$")))), 1, 20)


def upload_verdict(name: Column, kind: Column, size: Column, types: tuple = ("text/plain", "text/html", "application/json", "text/csv", "application/xml"), extensions: tuple = ("txt", "html", "json", "csv", "xml", "jsonl"), most: int = 10 << 20) -> Column:
    """'ok' or the reason to refuse a file: its size, path, extension or type."""
    ext = F.lower(F.substring_index(_text(name), ".", -1))
    return F.when(size.isNull() | (size > most), "size").when(_text(name).rlike(r"\.\.|[/\\]|\x00"), "path").when(~ext.isin(*extensions) | ~_text(name).contains("."), "extension").when(~_text(kind).isin(*types), "type").otherwise("ok")


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def legal_citations(spark, d):
    return _docs(spark, d).select("doc_id", citations(F.col("text")).alias("c")).select("doc_id", F.size("c.cases").cast("long").alias("cases"), F.size("c.statutes").cast("long").alias("statutes"))


def product_facts(spark, d):
    t = F.col("text")
    x = _docs(spark, d).select("doc_id", reviews(t).alias("r"), stock(t).alias("s"), F.size(discounts(t)).cast("long").alias("discounts"), F.array_join(currencies(t), ",").alias("currencies"))
    return x.select("doc_id", F.size("r.ratings").cast("long").alias("ratings"), F.round("r.mean", 6).alias("mean_rating"), F.col("r.reviews").alias("reviews"), F.col("s.status").alias("status"), F.col("s.quantity").alias("quantity"), "discounts", "currencies")


def product_specifications(spark, d):
    """One row for each specification of a document."""
    return _docs(spark, d).select("doc_id", F.explode(specifications(F.col("text"))).alias("key", "value"))


def technical_facts(spark, d):
    t = F.col("text")
    x = _docs(spark, d).select("doc_id", interfaces(t).alias("i"), measures(t).alias("m"))
    total = lambda c: F.round(F.aggregate(F.col(c), F.lit(0.0), lambda a, v: a + v["value"]), 4)
    return x.select("doc_id", F.array_join("i.endpoints", "|").alias("endpoints"), F.array_join("i.authentication", "|").alias("authentication"), F.size("i.media_types").cast("long").alias("media_types"), F.size("m.timing").cast("long").alias("timings"), total("m.timing").alias("timing_sum"), F.size("m.throughput").cast("long").alias("throughputs"), F.size("m.memory").cast("long").alias("memories"))


def text_topics(spark, d):
    return _docs(spark, d).select("doc_id", F.array_join(topics(F.col("text")), "|").alias("topics"))


def text_completeness(spark, d):
    t = F.col("text")
    return _docs(spark, d).select("doc_id", F.round(completeness(t), 6).alias("completeness"), few_typos(t).alias("few_typos"), F.round(simple_readability(t), 6).alias("readability"))


def text_content_metrics(spark, d):
    m = content_metrics(F.col("text"))
    return _docs(spark, d).select("doc_id", *[(m[k].cast("long") if k in ("words", "sentences", "paragraphs") else F.round(m[k], 6)).alias(k) for k in m])


def text_categories(spark, d):
    """The three leading domains of each document by keywords."""
    from .entities import KEYWORDS

    return _docs(spark, d).select("doc_id", F.array_join(top_categories(F.col("text"), KEYWORDS), "|").alias("categories"))


def language_labels(spark, d):
    t = table(spark, d, "documents")
    return t.select("doc_id", guess_language(F.col("text")).alias("guess"), language_name(F.col("lang")).alias("name"), F.length(clean_for_language(F.col("text"))).cast("long").alias("cleaned_chars"))


QUERIES = {f.__name__: f for f in (legal_citations, product_facts, product_specifications, technical_facts, text_topics, text_completeness, text_content_metrics, text_categories, language_labels)}

_X = lambda p, g=1: f"regexp_extract_all(text, '{p}', {g})"
_W = r"list_filter(string_split_regex({0}, '\s+'), lambda x: x <> '')"
_BLANK = r"lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'), ' ') <> ''"
_SOME = lambda c, ps: "(" + " or ".join(f"contains({c}, '{p}')" for p in ps) + ")"
_SENT = rf"len(list_filter(string_split_regex(text, '[.!?]+'), {_BLANK}))"
_B = "with documents as (select * replace (coalesce(text, '') as text) from documents) "


def _step(c: str, *levels) -> str:
    return "case " + " ".join(f"when {c} >= {a} then {b}::double" for a, b in levels) + " else 0 end"


def _categories() -> str:
    from .entities import KEYWORDS

    rates = ", ".join(f"struct_pack(s := len(regexp_extract_all(lower(text), '\\b(?:{'|'.join(v)})\\b')) * 1000 / greatest(len({_W.format('text')}), 1), i := {-i}, k := '{k}')" for i, (k, v) in enumerate(KEYWORDS.items()))
    return f"select doc_id, array_to_string(list_transform(list_sort(list_filter([{rates}], lambda x: x.s >= 0.1), 'DESC')[1:3], lambda x: x.k), '|') as categories from documents"


ORACLE = {
    "legal_citations": _B + f"select doc_id, len({_X(CASES)}) as cases, len({_X(STATUTES)}) as statutes from documents",
    "product_facts": _B + f"select doc_id, len(r) as ratings, round(list_avg(r), 6) as mean_rating, coalesce(list_max(list_transform({_X(REVIEWS)}, lambda x: x::bigint)), 0) as reviews, case " + " ".join(f"when {_SOME('lower(text)', ps)} then '{k}'" for k, ps in STOCK.items()) + f" else 'unknown' end as status, list_max(list_transform({_X(QUANTITY)}, lambda x: x::bigint)) as quantity, {' + '.join(f'len({_X(p)})' for p in DISCOUNTS)} as discounts, array_to_string(list_sort(list_distinct(list_concat(case when regexp_matches(text, '[$€£]\\d') then ['USD'] else [] end, list_transform({_X(CURRENCY_CODES, 2)}, lambda c: upper(c))))), ',') as currencies from (select *, list_transform({_X(RATING)}, lambda x: x::double) as r from documents)",
    "product_specifications": _B + f"select doc_id, k as key, arg_max(v, i) as value from (select doc_id, unnest(range(len(ks))) as i, replace(lower(trim(unnest(ks), ' ')), ' ', '_') as k, trim(unnest(vs), ' ') as v from (select doc_id, {_X(SPECIFICATION, 1)} as ks, {_X(SPECIFICATION, 2)} as vs from documents)) where length(v) < 50 and not {_SOME('lower(v)', NO_SPECIFICATION)} group by doc_id, k",
    "technical_facts": _B + f"select doc_id, array_to_string(list_transform(list_zip({_X(ENDPOINT, 1)}, {_X(ENDPOINT, 2)}), lambda z: upper(z[1]) || ' ' || z[2]), '|') as endpoints, array_to_string(list_sort(list_distinct({_X(AUTH)})), '|') as authentication, len({_X(MEDIA_TYPE)}) as media_types, len({_X(MEASURES['timing'])}) as timings, round(coalesce(list_sum(list_transform({_X(MEASURES['timing'])}, lambda x: x::double)), 0), 4) as timing_sum, len({_X(MEASURES['throughput'])}) as throughputs, len({_X(MEASURES['memory'])}) as memories from documents",
    "text_topics": _B + f", w as (select doc_id, list_filter(list_concat({_X(TOPIC)}, {_X(KNOWN_TOPIC)}), lambda x: length(x) > 3) as f from documents), e as (select doc_id, t, count(*) as c, min(i) as i from (select doc_id, unnest(range(len(f))) as i, unnest(f) as t from w) group by doc_id, t), r as (select *, row_number() over (partition by doc_id order by c desc, i) as rn from e) select doc_id, coalesce(s, '') as topics from documents left join (select doc_id, string_agg(t, '|' order by rn) as s from r where rn <= 5 group by doc_id) using (doc_id)",
    "text_completeness": _B + f"select doc_id, round(least(1, {_step('n', (300, 0.3), (100, 0.2), (50, 0.1))} + {_step('s', (5, 0.2), (3, 0.1))} + {_step('p', (3, 0.2), (2, 0.1))} + case when {_SOME('lower(text)', CONNECTIVES)} then 0.2::double else 0 end + case when {_SOME('lower(text)', EVIDENCE)} then 0.1::double else 0 end), 6) as completeness, n > 0 and ({' + '.join(f'''len(regexp_extract_all(text, '{p}'))''' for p in ODD_WORDS)}) < 0.05::double * n as few_typos, round(case when n > 0 and ns > 0 then greatest(0, least(100, 206.835::double - 1.015::double * n / ns - 84.6::double * syl / n)) else 0 end, 6) as readability from (select *, len(w) as n, len(string_split_regex(text, '[.!?]+')) as s, {_SENT} as ns, len(list_filter(string_split(text, chr(10) || chr(10)), {_BLANK})) as p, coalesce(list_sum(list_transform(w, lambda x: greatest(1, len(regexp_extract_all(x, '[aeiouAEIOU]'))))), 0) as syl from (select *, {_W.format('text')} as w from documents))",
    "text_content_metrics": _B + rf"select doc_id, len(w) as words, {_SENT} as sentences, len(list_filter(string_split_regex(text, '\n\s*\n'), {_BLANK})) as paragraphs, round(len(w) / 200, 6) as minutes, round(case when len(w) > 0 then len(list_distinct(w)) / len(w) end, 6) as diversity from (select *, {_W.format('lower(text)')} as w from documents)",
    "text_categories": _B + _categories(),
}
