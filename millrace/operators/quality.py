"""Quality scores of documents: length, language, lexical, grammar, spam, relevance and their weighted sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.entities import KEYWORDS
from millrace.functions.language import detect
from millrace.functions.text_metrics import flesch, sentences, total_syllables, words
from millrace.sources import table

# Spam words, the weights of the sums, and the constants that stand for model scores without a model.
SPAM = ("free", "win", "winner", "cash", "prize", "limited time", "offer", "subscribe", "buy now", "click here", "urgent")
WIRED = {"length": 0.3, "language": 0.4, "coherence": 0.3}
WEIGHTS = {"lexical": 0.15, "grammar": 0.15, "coherence": 0.3, "toxicity": -0.5, "density": 0.1, "relevance": 0.2, "spam": -0.3}
COHERENCE_WIRED, COHERENCE, TOXICITY = 0.75, 0.7, 0.1
MIN_WORDS = 10


def word_count(text: Column) -> Column:
    """Parts between white space."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != ""))


def length_score(text: Column) -> Column:
    return F.when(F.length(text) > 400, 1.0).otherwise(0.0)


def language_score(text: Column) -> Column:
    """1 for English, 0 for others and for blank texts."""
    return F.when((F.trim(F.coalesce(text, F.lit(""))) != "") & (detect(text) == "en"), 1.0).otherwise(0.0)


def wired_score(text: Column) -> Column:
    """The three-part sum with the constant that stands for coherence; 0 for empty texts."""
    coherence = F.when(word_count(text) < MIN_WORDS, 0.0).otherwise(COHERENCE_WIRED)
    total = WIRED["length"] * length_score(text) + WIRED["language"] * language_score(text) + WIRED["coherence"] * coherence
    return F.when(F.coalesce(text, F.lit("")) == "", 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)))


def lexical_score(text: Column) -> Column:
    """Half readability, three tenths diversity, two tenths sentence length near 20; 0 below ten words."""
    ws, n_s = words(text), F.size(sentences(text))
    raw = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")
    n = F.size(raw)
    ease = F.coalesce(flesch(F.size(ws), n_s, total_syllables(ws)), F.lit(0.0)) / 100
    diversity = F.size(F.array_distinct(raw)) / n
    shape = 1 - F.least(F.abs(F.when(n_s > 0, n / n_s).otherwise(F.lit(0.0)) - 20) / 20, F.lit(1.0))
    return F.when(n < MIN_WORDS, 0.0).otherwise(ease * 0.5 + diversity * 0.3 + shape * 0.2)


def grammar_score(text: Column) -> Column:
    """One minus penalties per sentence and for spacing and repeated marks; 0 below ten words."""
    parts = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\."), lambda s: F.trim(F.regexp_replace(s, r"\s+", " "))), lambda s: s != "")
    faults = F.aggregate(parts, F.lit(0), lambda a, s: a + F.when(s.rlike(r"^\p{Lu}"), 0).otherwise(1) + F.when(F.size(F.split(s, " ")).between(3, 50), 0).otherwise(1))
    score = 1.0 - 0.05 * faults - F.when(text.contains("  "), 0.1).otherwise(0.0) - F.when(text.rlike("[,.!?][a-zA-Z]"), 0.1).otherwise(0.0) - F.when(text.rlike("[.!?]{2,}"), 0.05).otherwise(0.0)
    return F.when(word_count(text) < MIN_WORDS, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


def spam_score(text: Column) -> Column:
    """Mean of the shares of spam words, capitals and exclamation marks, each against its limit."""
    low = F.lower(text)
    hits = sum((low.contains(w).cast("int") for w in SPAM), F.lit(0))
    n = F.greatest(F.length(text), F.lit(1))
    upper = F.length(F.regexp_replace(text, r"[^\p{Lu}]", "")) / n
    bangs = F.regexp_count(text, F.lit("!")) / (F.regexp_count(text, F.lit(r"\.")) + 1)
    return (F.least(hits / 5.0, F.lit(1.0)) + F.least(upper / 0.3, F.lit(1.0)) + F.least(bangs / 0.1, F.lit(1.0))) / 3


def relevance(text: Column, kind: Column) -> Column:
    """Share of the domain's keywords that occur; 0 for domains without a list."""
    low = F.lower(text)
    out = F.lit(0.0)
    for k, ws in KEYWORDS.items():
        out = F.when(kind == k, sum((low.contains(w).cast("int") for w in ws), F.lit(0)) / len(ws)).otherwise(out)
    return out


def density(text: Column) -> Column:
    """Capitalised phrases per sentence, standing for named entities."""
    return F.when(F.size(sentences(text)) > 0, F.regexp_count(text, F.lit(r"[A-Z][a-z]+(?: [A-Z][a-z]+)*")) / F.size(sentences(text))).otherwise(0.0)


def overall(text: Column, kind: Column) -> Column:
    w = WEIGHTS
    total = w["lexical"] * lexical_score(text) + w["grammar"] * grammar_score(text) + w["coherence"] * COHERENCE + w["toxicity"] * TOXICITY + w["density"] * F.least(density(text), F.lit(1.0)) + w["relevance"] * relevance(text, kind) + w["spam"] * spam_score(text)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), total))


def tier(score: Column) -> Column:
    return F.when(score >= 0.8, "premium").when(score >= 0.6, "standard").when(score >= 0.4, "basic").otherwise("below_threshold")


def letter(score: Column) -> Column:
    return F.when(score >= 0.9, "A+").when(score >= 0.8, "A").when(score >= 0.7, "B").when(score >= 0.6, "C").when(score >= 0.5, "D").otherwise("F")


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "domain_type")


def quality_wired(spark, d):
    t = F.col("text")
    return _docs(spark, d).select("doc_id", length_score(t).alias("length"), language_score(t).alias("language"), F.round(wired_score(t), 6).alias("overall"))


def quality_parts(spark, d):
    t = F.col("text")
    return _docs(spark, d).select("doc_id", F.round(lexical_score(t), 6).alias("lexical"), F.round(grammar_score(t), 6).alias("grammar"), F.round(spam_score(t), 6).alias("spam"), F.round(relevance(t, F.col("domain_type")), 6).alias("relevance"), F.round(density(t), 6).alias("density"))


def quality_overall(spark, d):
    scored = _docs(spark, d).select("doc_id", F.round(overall(F.col("text"), F.col("domain_type")), 6).alias("overall"))
    return scored.select("doc_id", "overall", tier(F.col("overall")).alias("tier"), letter(F.col("overall")).alias("grade"))


def quality_gate(spark, d):
    """How many documents pass each gate of the wired score."""
    s = quality_wired(spark, d)
    return s.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("overall") >= 0.6).alias("passed"), F.count_if(F.col("overall") < 0.6).alias("rejected"))


QUERIES = {f.__name__: f for f in (quality_wired, quality_parts, quality_overall, quality_gate)}


def _sql() -> str:
    from millrace.functions.language import ORACLE as LANG
    from millrace.functions.text_metrics import _SYL, _T

    lang = LANG["lang_patterns"].replace("select doc_id, detected from d", "").strip()
    rel = "case " + " ".join(f"when domain_type = '{k}' then ({' + '.join(f'contains(lower(text), {w!r})::int' for w in ws)}) / {len(ws)}" for k, ws in KEYWORDS.items()) + " else 0 end"
    spam = " + ".join(f"contains(lower(text), '{w}')::int" for w in SPAM)
    return (
        lang.rstrip() + ", " + _T.strip()[len("with "):].rsplit("),\nc as", 1)[0] + ")"
        + rf""", q as (select doc_id, text, domain_type, detected, w, s, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') as r, coalesce(list_sum(list_transform(w, lambda x: {_SYL})), 0) as syl,
 list_filter(list_transform(string_split(text, '.'), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'), ' ')), lambda x: x <> '') as g from documents join t using (doc_id, text) join d using (doc_id)),
m as (select *, len(r) as n, len(s) as ns, len(w) as nw from q),
p as (select doc_id, domain_type, text, detected, n, case when length(text) > 400 then 1.0::double else 0 end as length, case when trim(text, ' ') <> '' and detected = 'en' then 1.0::double else 0 end as language,
 case when n < 10 then 0 else case when nw > 0 and ns > 0 then greatest(0, least(100, 206.835::double - 1.015::double * nw / ns - 84.6::double * syl / nw)) else 0 end / 100 * 0.5::double + len(list_distinct(r)) / n * 0.3::double + (1 - least(abs(case when ns > 0 then n / ns else 0 end - 20) / 20, 1)) * 0.2::double end as lexical,
 case when n < 10 then 0 else greatest(0, least(1, 1.0::double - 0.05::double * coalesce(list_sum(list_transform(g, lambda x: case when regexp_matches(x, '^\p{{Lu}}') then 0 else 1 end + case when len(string_split(x, ' ')) between 3 and 50 then 0 else 1 end)), 0) - case when contains(text, '  ') then 0.1::double else 0 end - case when regexp_matches(text, '[,.!?][a-zA-Z]') then 0.1::double else 0 end - case when regexp_matches(text, '[.!?]{{2,}}') then 0.05::double else 0 end)) end as grammar,
 (least(({spam}) / 5.0::double, 1) + least(length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) / greatest(length(text), 1) / 0.3::double, 1) + least(len(regexp_extract_all(text, '!')) / (len(regexp_extract_all(text, '\.')) + 1) / 0.1::double, 1)) / 3 as spam,
 {rel} as relevance, case when ns > 0 then len(regexp_extract_all(text, '[A-Z][a-z]+(?: [A-Z][a-z]+)*')) / ns else 0 end as density from m),
o as (select *, case when text = '' then 0 else least(1, greatest(0, 0.3::double * length + 0.4::double * language + 0.3::double * case when n < 10 then 0 else 0.75::double end)) end as wired,
 round(greatest(0, least(1, 0.15::double * lexical + 0.15::double * grammar + 0.3::double * 0.7::double - 0.5::double * 0.1::double + 0.1::double * least(density, 1) + 0.2::double * relevance - 0.3::double * spam)), 6) as overall from p)
"""
    )


_S = _sql()
ORACLE = {
    "quality_wired": _S + "select doc_id, length, language, round(wired, 6) as overall from o",
    "quality_parts": _S + "select doc_id, round(lexical, 6) as lexical, round(grammar, 6) as grammar, round(spam, 6) as spam, round(relevance, 6) as relevance, round(density, 6) as density from o",
    "quality_overall": _S + "select doc_id, overall, case when overall >= 0.8 then 'premium' when overall >= 0.6 then 'standard' when overall >= 0.4 then 'basic' else 'below_threshold' end as tier, case when overall >= 0.9 then 'A+' when overall >= 0.8 then 'A' when overall >= 0.7 then 'B' when overall >= 0.6 then 'C' when overall >= 0.5 then 'D' else 'F' end as grade from o",
    "quality_gate": _S + "select count(*) as n, count(*) filter (round(wired, 6) >= 0.6) as passed, count(*) filter (round(wired, 6) < 0.6) as rejected from o",
}
