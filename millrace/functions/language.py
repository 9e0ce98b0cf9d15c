"""Pattern-based language identification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.sources import table

# The word lists by which a language is recognised, two for each.
PATTERNS = {
    "en": ("the|and|or|but|in|on|at|to|for|of|with|by", "this|that|these|those|what|where|when|why|how"),
    "es": ("el|la|los|las|y|o|pero|en|de|con|por|para", "que|como|cuando|donde|quien|cual"),
    "fr": ("le|la|les|et|ou|mais|dans|de|avec|par|pour", "que|comme|quand|où|qui|quel"),
    "de": ("der|die|das|und|oder|aber|in|auf|mit|von|für", "was|wie|wann|wo|wer|welch"),
    "it": ("il|la|lo|gli|e|o|ma|in|di|con|per", "che|come|quando|dove|chi|quale"),
    "pt": ("o|a|os|as|e|ou|mas|em|de|com|por|para", "que|como|quando|onde|quem|qual"),
    "ru": ("и|или|но|в|на|с|по|для|от|до", "что|как|когда|где|кто|какой"),
    "ar": ("في|من|إلى|على|مع|عن|بعد|قبل", "ما|كيف|متى|أين|من|أي"),
}
#: Scripts whose text holds no spaced words: any character of theirs counts.
SCRIPTS = {"zh": "[一-鿿]", "ja": "[぀-ヿ]"}
LEAST = 0.1
SHORT = 10


def _once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once however often it occurs there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scores(text: Column, use) -> Column:
    """``use`` of the hits per thousand characters of each language, by code; words are whole tokens. The text is split once, and
    only tokens that are in some list are looked up again."""
    every = sorted({w for ab in PATTERNS.values() for x in ab for w in x.split("|")})

    def of(b):
        n = F.length(b["t"])
        per = lambda hits: F.when(n > 0, hits * 1000 / n).otherwise(F.lit(0.0))

        def hits(first, second):
            first, second = first.split("|"), second.split("|")
            total = F.size(F.filter(b["known"], lambda w: w.isin(*dict.fromkeys(first + second))))
            twice = set(first) & set(second)
            return total + F.size(F.filter(b["known"], lambda w: w.isin(*twice))) if twice else total

        out = {k: per(hits(*ab)) for k, ab in PATTERNS.items()}
        return use(out | {k: per(F.regexp_count(b["t"], F.lit(p))) for k, p in SCRIPTS.items()})

    low = F.lower(F.coalesce(text, F.lit("")))
    known = F.filter(F.regexp_extract_all(low, F.lit(r"([\p{L}\p{N}_]+)"), 1), lambda w: w.isin(*every))
    return _once(F.struct(low.alias("t"), known.alias("known")), of)


def detect(text: Column) -> Column:
    """The best language if its score exceeds LEAST, the first listed on ties; 'en' below SHORT characters or without a match."""

    def best(found):
        ranked = F.array(*[F.struct(c.alias("score"), F.lit(-i).alias("rank"), F.lit(k).alias("lang")) for i, (k, c) in enumerate(found.items())])
        return F.array_max(ranked)

    top = _once(scores(text, best), lambda m: F.when(m["score"] > LEAST, m["lang"]).otherwise(F.lit("en")))
    return F.when(F.length(F.trim(F.coalesce(text, F.lit("")))) < SHORT, F.lit("en")).otherwise(top)


def lang_patterns(spark, d):
    return table(spark, d, "documents").select("doc_id", detect(F.col("text")).alias("detected"))


def lang_distribution(spark, d):
    g = lang_patterns(spark, d).groupBy("detected").agg(F.count(F.lit(1)).alias("n"))
    return g.crossJoin(F.broadcast(g.agg(F.sum("n").alias("total")))).select("detected", "n", F.round(F.col("n") * 100 / F.col("total"), 6).alias("percent"))


def lang_accuracy(spark, d):
    """How often the detected language is the stated one, by stated language in lower case."""
    t = table(spark, d, "documents").select(F.lower("lang").alias("lang"), (detect(F.col("text")) == F.lower("lang")).alias("ok")).filter("lang IS NOT NULL AND lang != ''")
    return t.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("right"))


QUERIES = {f.__name__: f for f in (lang_patterns, lang_distribution, lang_accuracy)}


def _case() -> str:
    cols = [f"struct_pack(s := (len(list_filter(w, lambda x: x in ({', '.join(repr(x) for x in a.split('|'))}))) + len(list_filter(w, lambda x: x in ({', '.join(repr(x) for x in b.split('|'))})))) * 1000 / n, r := {-i}, l := '{k}')" for i, (k, (a, b)) in enumerate(PATTERNS.items())]
    cols += [f"struct_pack(s := len(regexp_extract_all(t, '{p}')) * 1000 / n, r := {-8 - i}, l := '{k}')" for i, (k, p) in enumerate(SCRIPTS.items())]
    return "[" + ", ".join(cols) + "]"


_D = r"with b as (select doc_id, lang, text, lower(text) as t, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') as w, greatest(1, length(text)) as n from documents), " + f"""
d as (select doc_id, lang, case when length(trim(text, ' ')) < 10 then 'en' when m.s > 0.1 then m.l else 'en' end as detected from (select *, list_max({_case()}) as m from b))
"""
ORACLE = {
    "lang_patterns": _D + "select doc_id, detected from d",
    "lang_distribution": _D + "select detected, count(*) as n, round(count(*) * 100 / sum(count(*)) over (), 6) as percent from d group by detected",
    "lang_accuracy": _D + "select lower(lang) as lang, count(*) as n, count(*) filter (detected = lower(lang)) as \"right\" from d where lang is not null and lang <> '' group by 1",
}
