"""Entities, personal data and domain signals of texts as native expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.sources import table

# Patterns by domain and class; case is ignored.
ENTITIES = {
    "medical": {
        "medications": (r"\b[A-Z][a-z]+(?:cin|nol|pril|sartan|statin|mycin|cillin)\b", r"\b(?:mg|mcg|IU|units?)\b", r"\b\d+\s*(?:mg|mcg|ml|cc|IU|units?)\b"),
        "conditions": (r"\b[A-Z][a-z]+(?:itis|osis|emia|uria|pathy|plasia|trophy)\b", r"\b(?:acute|chronic|severe|mild|moderate)\s+\w+\b"),
        "procedures": (r"\b\w+(?:ectomy|otomy|ostomy|scopy|graphy|plasty)\b", r"\b(?:biopsy|surgery|operation|procedure|examination)\b"),
        "anatomy": (r"\b(?:heart|brain|liver|kidney|lung|stomach|intestine|bone|muscle|nerve)\b", r"\b(?:anterior|posterior|superior|inferior|medial|lateral|proximal|distal)\b"),
        "abbreviations": (r"\b(?:BP|HR|RR|O2|CO2|CBC|BUN|ECG|EKG|MRI|CT|PET|BMI)\b", r"\b(?:IV|IM|PO|PRN|BID|TID|QID|QD|HS|AC|PC)\b"),
    },
    "legal": {
        "citations": (r"\b\d+\s+[A-Z][a-z]*\.?\s*\d+d?\s*\d+\b", r"\b[A-Z][a-z]+\s+v\.?\s+[A-Z][a-z]+\b"),
        "statutes": (r"\b\d+\s+U\.?S\.?C\.?\s*§?\s*\d+\b", r"\b\d+\s+C\.?F\.?R\.?\s*§?\s*\d+\b", r"\bSection\s+\d+\b"),
        "entities": (r"\b(?:Judge|Justice|Hon\.|Honorable)\s+[A-Z][a-z]+\b", r"\b(?:Attorney|Counsel|Esq\.)\s+[A-Z][a-z]+\b", r"\b(?:Court|Tribunal|Commission)\s+of\s+[A-Z][a-z]+\b"),
        "procedures": (r"\b(?:motion|petition|appeal|writ|subpoena|deposition|discovery)\b", r"\b(?:filed|granted|denied|dismissed|reversed|affirmed|remanded)\b"),
        "jurisdictions": (r"\b(?:Federal|State|Municipal|County|District|Circuit)\s+Court\b", r"\b(?:Supreme Court|Court of Appeals|District Court)\b", r"\b(?:United States|U\.S\.|California|New York|Texas)\b"),
    },
    "ecommerce": {
        "prices": (r"\$\d+(?:\.\d{2})?", r"€\d+(?:\.\d{2})?", r"£\d+(?:\.\d{2})?", r"\d+(?:\.\d{2})?\s*(?:USD|EUR|GBP|CAD|AUD)"),
        "products": (r"\bSKU:?\s*[A-Z0-9-]+", r"\bModel:?\s*[A-Z0-9-]+", r"\bUPC:?\s*\d{12}", r"\bASIN:?\s*[A-Z0-9]{10}"),
        "reviews": (r"\b\d+(?:\.\d+)?\s*(?:stars?|/5|out of 5)\b", r"\b\d+\s*reviews?\b"),
        "inventory": (r"\b(?:in stock|available|out of stock|sold out|backordered)\b", r"\b\d+\s*(?:left|remaining|available)\b"),
    },
    "technical": {
        "languages": (r"\b(?:Python|JavaScript|Java|Ruby|PHP|Go|Rust|Swift|Kotlin)\b",),
        "frameworks": (r"\b(?:React|Angular|Vue|Django|Flask|Spring|Express|Rails|Laravel)\b",),
        "technologies": (r"\b(?:Docker|Kubernetes|AWS|Azure|GCP|MongoDB|PostgreSQL|MySQL|Redis)\b",),
        "versions": (r"\bv?\d+\.\d+(?:\.\d+)?(?:-[a-zA-Z0-9]+)?\b",),
        "performance": (r"\d+(?:\.\d+)?\s*(?:ms|seconds?|minutes?|hours?)", r"\d+(?:\.\d+)?\s*(?:MB/s|GB/s|Mbps|Gbps)", r"\d+(?:\.\d+)?\s*(?:MB|GB|KB)"),
    },
}
# Personal data.
PII = {"ssn": r"\b\d{3}-\d{2}-\d{4}\b", "date": r"\b\d{2}/\d{2}/\d{4}\b", "record": r"\b(?:MRN|Medical Record Number):\s*\d+\b", "long_number": r"\b\d{10,}\b"}
# Abbreviations written out.
ABBREVIATIONS = {
    "BP": "blood pressure", "HR": "heart rate", "RR": "respiratory rate", "CBC": "complete blood count", "BUN": "blood urea nitrogen", "ECG": "electrocardiogram", "EKG": "electrocardiogram", "MRI": "magnetic resonance imaging", "CT": "computed tomography", "PET": "positron emission tomography",
    "BMI": "body mass index", "IV": "intravenous", "IM": "intramuscular", "PO": "by mouth", "PRN": "as needed", "BID": "twice daily", "TID": "three times daily", "QID": "four times daily", "QD": "once daily",
}
# Words of each domain.
KEYWORDS = {
    "medical": ("patient", "diagnosis", "treatment", "therapy", "clinical", "medical", "disease", "syndrome", "disorder", "symptom", "procedure", "surgery", "medication", "drug", "dosage", "prescription", "pharmaceutical", "hospital", "clinic", "doctor", "physician", "nurse", "healthcare", "anatomy", "physiology", "pathology", "radiology", "oncology", "cardiology", "neurology", "pediatrics", "geriatrics", "psychiatry"),
    "legal": ("court", "judge", "jury", "trial", "case", "lawsuit", "litigation", "plaintiff", "defendant", "attorney", "lawyer", "counsel", "barrister", "statute", "regulation", "law", "legal", "judicial", "jurisdiction", "appeal", "motion", "brief", "ruling", "verdict", "judgment", "sentence", "contract", "agreement", "liability", "damages", "injunction", "precedent", "constitutional", "federal", "state", "municipal", "civil", "criminal"),
    "ecommerce": ("product", "price", "buy", "purchase", "order", "cart", "checkout", "shipping", "delivery", "return", "warranty", "guarantee", "review", "rating", "star", "customer", "seller", "brand", "model", "size", "color", "style", "material", "weight", "dimension", "specification", "inventory", "stock", "available", "sale", "discount", "offer"),
    "technical": ("code", "function", "class", "method", "variable", "parameter", "api", "endpoint", "request", "response", "json", "xml", "http", "library", "framework", "dependency", "package", "module", "import", "version", "release", "update", "patch", "build", "deploy", "test", "performance", "benchmark", "optimization", "scalability", "latency", "documentation", "tutorial", "example", "guide", "reference", "manual"),
}
# Signs of a jurisdiction, of stock, and parts of a technology stack.
JURISDICTION = {"federal": ("federal court", "u.s. district", "united states", "supreme court"), "state": ("state court", "california", "new york", "texas", "florida"), "local": ("municipal", "county", "district court")}
STOCK = {"in_stock": ("in stock", "available now", "ready to ship"), "out_of_stock": ("out of stock", "sold out", "unavailable"), "backordered": ("backordered", "pre-order", "coming soon")}
STACK = {
    "languages": ("python", "javascript", "java", "c++", "ruby", "php", "go", "rust"), "frameworks": ("react", "angular", "vue", "django", "flask", "spring", "express"), "databases": ("mongodb", "postgresql", "mysql", "redis", "elasticsearch"),
    "tools": ("docker", "kubernetes", "jenkins", "git", "npm", "webpack"), "platforms": ("aws", "azure", "gcp"),
}
# Sentences of an outcome.
OUTCOMES = {"granted": "granted|allowed|approved", "denied": "denied|rejected|dismissed", "reversed": "reversed|overturned|set aside", "affirmed": "affirmed|upheld|confirmed", "remanded": "remanded|sent back|returned"}


def find_all(text: Column, patterns: tuple[str, ...]) -> Column:
    """Distinct matches of the patterns, case ignored; null text has none."""
    t = F.coalesce(text, F.lit(""))
    return F.array_distinct(F.concat(*[F.regexp_extract_all(t, F.lit(f"(?i)({p})"), 1) for p in patterns]))


def any_of(text: Column, parts: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(p) for p in parts])


def first_of(text: Column, groups: dict[str, tuple[str, ...]], default: str) -> Column:
    """The first group of which the lower-case text has any part."""
    return F.coalesce(*[F.when(any_of(text, v), F.lit(k)) for k, v in groups.items()], F.lit(default))


def expand_abbreviations(text: Column) -> Column:
    return reduce(lambda c, kv: F.regexp_replace(c, rf"\b{kv[0]}\b", f"{kv[0]} ({kv[1]})"), ABBREVIATIONS.items(), text)


def domain_by_keywords(text: Column) -> Column:
    """The domain of which the largest share of keywords occurs, scaled by length; 'general' below 0.3."""
    low = F.lower(F.coalesce(text, F.lit("")))
    n = F.size(F.filter(F.split(low, r"\s+"), lambda w: w != ""))
    score = lambda ws: sum((low.contains(w).cast("int") for w in ws), F.lit(0)) / len(ws) * F.least(F.lit(1.0), n / 1000)
    best = F.array_max(F.array(*[F.struct(score(ws).alias("s"), F.lit(-i).alias("r"), F.lit(k).alias("k")) for i, (k, ws) in enumerate(KEYWORDS.items())]))
    return F.when(best["s"] >= 0.3, best["k"]).otherwise(F.lit("general"))


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", F.col("text"))


def _entities(domain: str):
    def query(spark, d):
        return _docs(spark, d).select("doc_id", *[F.size(find_all(F.col("text"), p)).cast("long").alias(k) for k, p in ENTITIES[domain].items()])

    query.__doc__ = f"Numbers of distinct {domain} entities of each document, by class."
    return query


def pii_scan(spark, d):
    return _docs(spark, d).select("doc_id", *[F.size(F.regexp_extract_all("text", F.lit(f"({p})"), 1)).cast("long").alias(k) for k, p in PII.items()])


def abbreviations_expanded(spark, d):
    return _docs(spark, d).select("doc_id", F.sha2(expand_abbreviations(F.col("text")), 256).alias("text_sha"))


def domain_guess(spark, d):
    return _docs(spark, d).select("doc_id", domain_by_keywords(F.col("text")).alias("domain"))


def jurisdiction_and_stock(spark, d):
    low = F.lower("text")
    return _docs(spark, d).select("doc_id", first_of(low, JURISDICTION, "none").alias("jurisdiction"), first_of(low, STOCK, "unknown").alias("stock"))


def tech_stack(spark, d):
    low = F.lower("text")
    return _docs(spark, d).select("doc_id", *[F.array_join(F.array_compact(F.array(*[F.when(low.contains(x), F.lit(x)) for x in v])), ",").alias(k) for k, v in STACK.items()])


def case_outcomes(spark, d):
    """Numbers of sentences that state each outcome."""
    parts = F.split("text", "[.!?]+")
    return _docs(spark, d).select("doc_id", *[F.size(_stating(parts, p)).cast("long").alias(k) for k, p in OUTCOMES.items()])


def _stating(parts: Column, words: str) -> Column:
    return F.filter(parts, lambda s: s.rlike(rf"(?i)\b(?:{words})\b"))


def pricing(spark, d):
    """Dollar, euro and pound prices of each document: number, least, largest, mean."""
    p = F.transform(F.regexp_extract_all("text", F.lit(r"[$€£](\d+(?:\.\d{2})?)"), 1), lambda x: x.cast("double"))
    t = _docs(spark, d).select("doc_id", p.alias("p"))
    return t.select("doc_id", F.size("p").cast("long").alias("prices"), F.array_min("p").alias("least"), F.array_max("p").alias("most"), F.round(F.when(F.size("p") > 0, F.aggregate("p", F.lit(0.0), lambda a, x: a + x) / F.size("p")), 6).alias("mean"))


def code_quality(spark, d):
    low = F.lower("text")
    parts = {"tests": (0.3, ("test", "spec", "unittest", "pytest")), "docs": (0.2, ("documentation", "readme", "docs", "comment")), "errors": (0.2, ("error", "exception", "try", "catch")), "concepts": (0.3, ("algorithm", "data structure", "design pattern", "architecture", "security"))}
    return _docs(spark, d).select("doc_id", F.round(sum((F.when(any_of(low, v), w).otherwise(0.0) for w, v in parts.values()), F.lit(0.0)), 6).alias("score"))


QUERIES = {f"entities_{k}": _entities(k) for k in ENTITIES} | {f.__name__: f for f in (pii_scan, abbreviations_expanded, domain_guess, jurisdiction_and_stock, tech_stack, case_outcomes, pricing, code_quality)}

_q = lambda p: p.replace("'", "''")
_has = lambda t, v: "(" + " or ".join(f"contains({t}, '{_q(x)}')" for x in v) + ")"
_first = lambda g, dflt: "case " + " ".join(f"when {_has('lower(text)', v)} then '{k}'" for k, v in g.items()) + f" else '{dflt}' end"
_ab = reduce(lambda c, kv: f"regexp_replace({c}, '\\b{kv[0]}\\b', '{kv[0]} ({kv[1]})', 'g')", ABBREVIATIONS.items(), "text")
_kw = "list_max([" + ", ".join(f"struct_pack(s := ({' + '.join(f'contains(l, {w!r})::int' for w in ws)}) / {len(ws)} * least(1.0::double, n / 1000), r := {-i}, k := '{k}')" for i, (k, ws) in enumerate(KEYWORDS.items())) + "])"
ORACLE = {f"entities_{k}": "select doc_id, " + ", ".join(f"cast(len(list_distinct({' || '.join(f'''regexp_extract_all(text, '(?i){_q(p)}')''' for p in ps)})) as bigint) as {c}" for c, ps in v.items()) + r" from (select doc_id, regexp_replace(text, '[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Cyrillic}\p{Arabic}\p{Devanagari}À-ÿ]', '_', 'g') as text from documents)" for k, v in ENTITIES.items()} | {
    "pii_scan": "select doc_id, " + ", ".join(f"cast(len(regexp_extract_all(text, '{p}')) as bigint) as {k}" for k, p in PII.items()) + " from documents",
    "abbreviations_expanded": f"select doc_id, sha256({_ab}) as text_sha from documents",
    "domain_guess": rf"select doc_id, case when m.s >= 0.3 then m.k else 'general' end as domain from (select doc_id, {_kw} as m from (select doc_id, lower(text) as l, len(list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '')) as n from documents))",
    "jurisdiction_and_stock": f"select doc_id, {_first(JURISDICTION, 'none')} as jurisdiction, {_first(STOCK, 'unknown')} as stock from documents",
    "tech_stack": "select doc_id, " + ", ".join(f"concat_ws(',', {', '.join(f'''case when contains(lower(text), '{x}') then '{x}' end''' for x in v)}) as {k}" for k, v in STACK.items()) + " from documents",
    "case_outcomes": "select doc_id, " + ", ".join(rf"cast(len(list_filter(string_split_regex(text, '[.!?]+'), lambda s: regexp_matches(s, '(?i)\b(?:{p})\b'))) as bigint) as {k}" for k, p in OUTCOMES.items()) + " from documents",
    "pricing": r"select doc_id, cast(len(p) as bigint) as prices, list_min(p) as least, list_max(p) as most, round(list_sum(p) / len(p), 6) as mean from (select doc_id, list_transform(regexp_extract_all(text, '[$€£](\d+(?:\.\d{2})?)', 1), lambda x: x::double) as p from documents)",
    "code_quality": "select doc_id, round(" + " + ".join(f"case when {_has('lower(text)', v)} then {w}::double else 0 end" for w, v in ((0.3, ("test", "spec", "unittest", "pytest")), (0.2, ("documentation", "readme", "docs", "comment")), (0.2, ("error", "exception", "try", "catch")), (0.3, ("algorithm", "data structure", "design pattern", "architecture", "security")))) + ", 6) as score from documents",
}
