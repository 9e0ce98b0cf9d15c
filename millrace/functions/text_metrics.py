"""Word, sentence, reading and lexical metrics as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.sources import table

WORD = r"[\p{L}\p{N}_]+"
# The stop words left out of lexical metrics.
STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it", "its", "of", "on", "that", "the", "to", "was", "were", "will", "with")


def words(text: Column) -> Column:
    """Lower-case word tokens longer than one character; null text gives none."""
    return F.filter(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"), 1), lambda w: F.length(w) > 1)


def sentences(text: Column) -> Column:
    """Non-blank parts between runs of . ! ?"""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "[.!?]+"), lambda s: F.trim(F.regexp_replace(s, r"\s+", " "))), lambda s: s != "")


def paragraphs(text: Column) -> Column:
    """Non-blank parts between empty lines."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n\n"), lambda p: F.trim(F.regexp_replace(p, r"\s+", " ")) != "")


def syllables(word: Column) -> Column:
    """Vowel groups, one less for a final e, at least one."""
    groups = F.regexp_count(F.lower(word), F.lit("[aeiouy]+"))
    return F.greatest(F.lit(1), groups - F.when(F.lower(word).endswith("e"), 1).otherwise(0))


def total_syllables(ws: Column) -> Column:
    return F.aggregate(ws, F.lit(0), lambda a, w: a + syllables(w))


def flesch(n_words: Column, n_sentences: Column, n_syllables: Column) -> Column:
    """Flesch reading ease within 0..100; null without words or sentences."""
    raw = 206.835 - 1.015 * n_words / n_sentences - 84.6 * n_syllables / n_words
    return F.when((n_words > 0) & (n_sentences > 0), F.greatest(F.lit(0.0), F.least(F.lit(100.0), raw)))


def grade(n_words: Column, n_sentences: Column, n_syllables: Column) -> Column:
    """Flesch-Kincaid grade, at least 0."""
    return F.when((n_words > 0) & (n_sentences > 0), F.greatest(F.lit(0.0), 0.39 * n_words / n_sentences + 11.8 * n_syllables / n_words - 15.59))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _tokens(spark, d):
    return table(spark, d, "documents").select("doc_id", "text", words(F.col("text")).alias("w"), F.size(sentences(F.col("text"))).alias("s"), F.size(paragraphs(F.col("text"))).alias("p"))


def text_reading_metrics(spark, d):
    t = _tokens(spark, d).withColumn("n", F.size("w")).withColumn("syl", total_syllables(F.col("w")))
    r = lambda c: F.round(c, 6)
    return t.select("doc_id", F.col("n").cast("long").alias("word_count"), F.length("text").cast("long").alias("char_count"), F.col("s").cast("long").alias("sentence_count"), F.col("p").cast("long").alias("paragraph_count"), r(F.col("n") / 200).alias("minutes_average"), r(F.col("n") / 150).alias("minutes_slow"), r(F.col("n") / 250).alias("minutes_fast"), r(_ratio(F.col("n"), F.col("s"))).alias("words_per_sentence"), r(_ratio(F.col("syl"), F.col("n"))).alias("syllables_per_word"), r(flesch(F.col("n"), F.col("s"), F.col("syl"))).alias("flesch"), r(grade(F.col("n"), F.col("s"), F.col("syl"))).alias("grade"))


def mattr(ws: Column, window: int = 100) -> Column:
    """Mean share of distinct words over every window of 100 words; the plain share for shorter texts."""
    n = F.size(ws)
    wins = F.transform(F.sequence(F.lit(1), n - window + 1), lambda i: F.size(F.array_distinct(F.slice(ws, i, window))) / F.lit(float(window)))
    return F.when(n >= window, F.aggregate(wins, F.lit(0.0), lambda a, x: a + x) / (n - window + 1)).otherwise(_ratio(F.size(F.array_distinct(ws)), n))


def text_lexical_metrics(spark, d):
    t = _tokens(spark, d).select("doc_id", "w", F.filter("w", lambda x: ~x.isin(*STOP_WORDS)).alias("c"))
    n, u = F.size("c"), F.size(F.array_distinct("c"))
    return t.select("doc_id", n.cast("long").alias("content_words"), u.cast("long").alias("unique_words"), F.round(_ratio(u, n), 6).alias("ttr"), F.round(mattr(F.col("c")), 6).alias("mattr"), F.size(F.filter("c", lambda w: syllables(w) >= 3)).cast("long").alias("complex_words"))


def text_top_words(spark, d):
    """The ten most common content words of each document, ties by first place; and the vocabulary richness 1 - sum of squared shares."""
    from pyspark.sql import Window

    t = _tokens(spark, d).select("doc_id", F.posexplode(F.filter("w", lambda x: ~x.isin(*STOP_WORDS))).alias("pos", "word"))
    g = t.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("n"), "first"))
    return g.withColumn("rank", rank).filter("rank <= 10").select("doc_id", F.col("rank").cast("long").alias("rank"), "word", "n")


def text_richness(spark, d):
    t = _tokens(spark, d).select("doc_id", F.explode(F.filter("w", lambda x: ~x.isin(*STOP_WORDS))).alias("word"))
    g = t.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n")).groupBy("doc_id").agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.col("n")).alias("q"))
    return g.select("doc_id", F.round(1 - F.col("q") / (F.col("t") * F.col("t")), 6).alias("richness"))


def text_format_checks(spark, d):
    """Capitalisation, punctuation, typo and coherence checks of each document."""
    t = table(spark, d, "documents").select("doc_id", "text", F.split("text", "[.!?]+").alias("parts"), sentences(F.col("text")).alias("s"))
    up = F.size(F.filter("parts", lambda s: F.trim(F.regexp_replace(s, r"^\s+", "")).rlike("^[A-Z]")))
    sw = F.transform("s", lambda s: F.size(F.split(s, " ")))
    avg = F.aggregate(sw, F.lit(0), lambda a, x: a + x) / F.size("s")
    return t.select("doc_id", (up / F.size("parts") > 0.8).alias("capitalised"), F.col("text").contains(".").alias("has_period"), F.col("text").rlike("[.!?]").alias("has_ending"), F.coalesce(F.when(F.size("s") > 0, avg.between(10, 25)), F.lit(False)).alias("coherent"))


QUERIES = {f.__name__: f for f in (text_reading_metrics, text_lexical_metrics, text_top_words, text_richness, text_format_checks)}

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_T = r"""
with t as (select doc_id, text, list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), lambda x: length(x) > 1) as w,
  list_filter(list_transform(string_split_regex(text, '[.!?]+'), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'), ' ')), lambda x: x <> '') as s,
  list_filter(string_split(text, chr(10) || chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'), ' ') <> '') as p from documents),
c as (select doc_id, list_filter(w, lambda x: x not in (""" + _STOP + r""")) as c from t)
"""
_SYL = "greatest(1, len(regexp_extract_all(x, '[aeiouy]+')) - case when x like '%e' then 1 else 0 end)"
ORACLE = {
    "text_reading_metrics": _T + f"""
, m as (select doc_id, text, len(w) as n, len(s) as s, len(p) as p, coalesce(list_sum(list_transform(w, lambda x: {_SYL})), 0) as syl from t)
select doc_id, cast(n as bigint) as word_count, cast(length(text) as bigint) as char_count, cast(s as bigint) as sentence_count, cast(p as bigint) as paragraph_count,
 round(n / 200, 6) as minutes_average, round(n / 150, 6) as minutes_slow, round(n / 250, 6) as minutes_fast, round(case when s > 0 then n / s else 0 end, 6) as words_per_sentence,
 round(case when n > 0 then syl / n else 0 end, 6) as syllables_per_word,
 round(case when n > 0 and s > 0 then greatest(0, least(100, 206.835::double - 1.015::double * n / s - 84.6::double * syl / n)) end, 6) as flesch,
 round(case when n > 0 and s > 0 then greatest(0, 0.39::double * n / s + 11.8::double * syl / n - 15.59::double) end, 6) as grade from m""",
    "text_lexical_metrics": _T + f"""
select doc_id, cast(len(c) as bigint) as content_words, cast(len(list_distinct(c)) as bigint) as unique_words, round(case when len(c) > 0 then len(list_distinct(c)) / len(c) else 0 end, 6) as ttr,
 round(case when len(c) >= 100 then list_avg(list_transform(range(1, len(c) - 98), lambda i: len(list_distinct(c[i:i + 99])) / 100)) when len(c) > 0 then len(list_distinct(c)) / len(c) else 0 end, 6) as mattr,
 cast(len(list_filter(c, lambda x: {_SYL} >= 3)) as bigint) as complex_words from c""",
    "text_top_words": _T + """
, e as (select doc_id, unnest(c) as word, unnest(range(len(c))) as pos from c), g as (select doc_id, word, count(*) as n, min(pos) as f from e group by all)
select doc_id, rank, word, n from (select *, row_number() over (partition by doc_id order by n desc, f) as rank from g) where rank <= 10""",
    "text_richness": _T + """
, e as (select doc_id, unnest(c) as word from c), g as (select doc_id, word, count(*) as n from e group by all)
select doc_id, round(1 - sum(n * n) / (sum(n) * sum(n)), 6) as richness from g group by doc_id""",
    "text_format_checks": _T + """
, q as (select doc_id, text, s, string_split_regex(text, '[.!?]+') as parts from t)
select doc_id, len(list_filter(parts, lambda x: regexp_matches(x, '^\\s*[A-Z]'))) / len(parts) > 0.8 as capitalised, contains(text, '.') as has_period, regexp_matches(text, '[.!?]') as has_ending,
 coalesce(case when len(s) > 0 then list_sum(list_transform(s, lambda x: len(string_split(x, ' ')))) / len(s) between 10 and 25 end, false) as coherent from q""".replace("\\\\", "\\"),
}
