"""Selection, sampling, chunking, formatting and reports of training sets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.quality import overall, word_count
from millrace.sources import table


@dataclass(frozen=True)
class DatasetConfig:
    """What is selected, how much of it, and in which form it leaves."""

    min_quality: float = 0.3
    min_words: int = 50
    max_words: int = 50_000
    languages: tuple[str, ...] = ("en",)
    excluded_domains: tuple[str, ...] = ()
    chunk_size: int = 512
    chunk_overlap: int = 50
    target_size: int = 200
    balance: dict = field(default_factory=dict)
    seed: str = "17"
    instruction: str = "Summarize the following content: {text}"


def select_documents(docs: DataFrame, c: DatasetConfig) -> DataFrame:
    """Rows of docs (score, words, lang, domain) that a configuration admits; nulls fail."""
    keep = (F.col("score") >= c.min_quality) & F.col("words").between(c.min_words, c.max_words)
    if c.languages:
        keep &= F.col("lang").isin(*c.languages)
    if c.excluded_domains:
        keep &= ~F.coalesce(F.col("domain"), F.lit("")).isin(*c.excluded_domains)
    return docs.filter(keep)


def seeded_order(id_: Column, seed: str) -> Column:
    """A portable pseudo-random order: the md5 of seed and id."""
    return F.md5(F.concat(F.lit(seed), F.lit(":"), id_.cast("string")))


def take_by_stratum(docs: DataFrame, stratum: str, quota: Column, order: list) -> DataFrame:
    """The first ``quota`` rows of each stratum in ``order``. Rows are ranked within salted parts of a stratum first and only each
    part's first ``quota`` rows meet in the stratum's final ranking, so that a hot stratum is not one task's sort."""
    part = F.pmod(F.xxhash64(F.struct(*[c for c in docs.columns])), F.lit(64))
    d = docs.withColumn("_part", part).withColumn("_quota", quota)
    d = d.withColumn("_r", F.row_number().over(Window.partitionBy(stratum, "_part").orderBy(*order))).filter("_r <= _quota")
    return d.withColumn("_r", F.row_number().over(Window.partitionBy(stratum).orderBy(*order))).filter("_r <= _quota").drop("_part", "_r", "_quota")


def chunk_tokens(words: Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` tokens stepping by size - overlap; one window if all fit; none for no tokens."""
    step = size - overlap
    n = F.size(words)
    return F.when(n == 0, F.array().cast("array<array<string>>")).when(n <= size, F.array(words)).otherwise(F.transform(F.sequence(F.lit(0), n - 1, F.lit(step)), lambda i: F.slice(words, i + 1, size)))


def _base(spark, d):
    t = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lower("lang").alias("lang"), F.coalesce("domain_type", F.lit("general")).alias("domain"))
    return t.withColumn("words", word_count(F.col("text"))).withColumn("score", F.round(overall(F.col("text"), F.col("domain")), 6))


def select_filters(spark, d):
    return select_documents(_base(spark, d), DatasetConfig()).select("doc_id", "domain", F.col("words").cast("long").alias("words"), "score")


def sample_balanced(spark, d):
    """At most 20 documents of each domain type in a seeded order."""
    t = table(spark, d, "documents").select("doc_id", F.coalesce("domain_type", F.lit("general")).alias("domain"))
    return take_by_stratum(t, "domain", F.lit(20), [seeded_order(F.col("doc_id"), "17"), F.col("doc_id")])


def sample_quota(spark, d):
    """Each domain type its equal share of 200 documents, drawn in a seeded order."""
    t = _base(spark, d)
    n = t.select("domain").distinct().count()
    s = take_by_stratum(t.select("doc_id", "domain", "score"), "domain", F.lit(200 // max(1, n)), [seeded_order(F.col("doc_id"), "17"), F.col("doc_id")])
    return s.select("doc_id", "domain", "score")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def chunks(spark, d):
    t = table(spark, d, "documents").select("doc_id", F.posexplode(chunk_tokens(_words(F.coalesce("text", F.lit(""))), 128, 16)).alias("chunk", "w"))
    return t.select("doc_id", F.col("chunk").cast("long").alias("chunk"), F.size("w").cast("long").alias("n_tokens"), F.md5(F.array_join("w", " ")).alias("text_md5"))


def instruction(text: Column, template: str) -> Column:
    """Instruction, response and both as one text."""
    ask = template.replace("{text}", "").strip()
    return F.struct(F.lit(ask).alias("instruction"), text.alias("response"), F.concat(F.lit(f"### Instruction:\n{ask}\n\n### Response:\n"), text).alias("text"))


def conversation(text: Column) -> Column:
    title = F.trim(F.substring_index(text, "\n", 1))
    return F.array(F.struct(F.lit("user").alias("role"), F.concat(F.lit("Can you tell me about: "), title).alias("content")), F.struct(F.lit("assistant").alias("role"), text.alias("content")))


def format_instruction(spark, d):
    t = table(spark, d, "documents").select("doc_id", instruction(F.coalesce("text", F.lit("")), DatasetConfig().instruction).alias("r"))
    return t.select("doc_id", F.col("r.instruction").alias("instruction"), F.md5("r.text").alias("text_md5"))


def format_conversation(spark, d):
    t = table(spark, d, "documents").select("doc_id", conversation(F.coalesce("text", F.lit(""))).alias("m"))
    return t.select("doc_id", F.col("m")[0]["content"].alias("question"), F.md5(F.col("m")[1]["content"]).alias("answer_md5"))


def dataset_analytics(spark, d):
    """Records, vocabulary, token statistics and quality statistics of the selected set."""
    s = select_documents(_base(spark, d), DatasetConfig())
    w = s.select("doc_id", "score", _words(F.col("text")).alias("w"))
    v = w.select(F.explode("w").alias("t")).agg(F.count_distinct("t").alias("vocabulary"))
    n = F.size("w")
    a = w.agg(F.count(F.lit(1)).alias("records"), F.round(F.avg(n), 6).alias("mean"), F.round(F.stddev_pop(n), 6).alias("std"), F.min(n).cast("long").alias("min"), F.max(n).cast("long").alias("max"), *[F.round(F.percentile(n, p / 100), 6).alias(f"p{p}") for p in (25, 50, 75)], F.round(F.avg("score"), 6).alias("score_mean"), F.round(F.stddev_pop("score"), 6).alias("score_std"))
    return a.join(F.broadcast(v))  # one row each


def domain_distribution(spark, d):
    """Documents, words and mean score by domain type, with the total, in one pass."""
    t = _base(spark, d)
    return t.rollup("domain").agg(F.count(F.lit(1)).alias("docs"), F.sum("words").alias("words"), F.round(F.avg("score"), 5).alias("mean_score"))


QUERIES = {f.__name__: f for f in (select_filters, sample_balanced, sample_quota, chunks, format_instruction, format_conversation, dataset_analytics, domain_distribution)}


def _oracle() -> dict:
    from millrace.operators.quality import ORACLE as Q

    score = Q["quality_overall"].split("select doc_id, overall, case")[0] + ", bb as (select doc_id, coalesce(d.domain_type, 'general') as domain, coalesce(d.text, '') as text, lower(lang) as lang, len(list_filter(string_split_regex(coalesce(d.text, ''), '\\s+'), lambda x: x <> '')) as words, overall as score from documents d join (select doc_id, overall from o) using (doc_id)), s as (select * from bb where score >= 0.3 and words between 50 and 50000 and lang = 'en') "
    toks = "list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')"
    return {
        "select_filters": score + "select doc_id, domain, cast(words as bigint) as words, score from s",
        "sample_balanced": "select doc_id, domain from (select doc_id, coalesce(domain_type, 'general') as domain, row_number() over (partition by coalesce(domain_type, 'general') order by md5('17:' || doc_id), doc_id) rn from documents) where rn <= 20",
        "sample_quota": score + "select doc_id, domain, score from (select *, row_number() over (partition by domain order by md5('17:' || doc_id), doc_id) rn from bb) where rn <= 200 // (select count(distinct domain) from bb)",
        "chunks": f"with w as (select doc_id, {toks} as w from documents), c as (select doc_id, w, unnest(case when len(w) = 0 then [] when len(w) <= 128 then [0] else range(0, len(w), 112) end) as i from w) select doc_id, i // 112 as chunk, cast(len(w[i + 1:i + 128]) as bigint) as n_tokens, md5(array_to_string(w[i + 1:i + 128], ' ')) as text_md5 from c",
        "format_instruction": "select doc_id, 'Summarize the following content:' as instruction, md5('### Instruction:' || chr(10) || 'Summarize the following content:' || chr(10) || chr(10) || '### Response:' || chr(10) || text) as text_md5 from documents",
        "format_conversation": "select doc_id, 'Can you tell me about: ' || trim(split_part(text, chr(10), 1), ' ') as question, md5(text) as answer_md5 from documents",
        "dataset_analytics": score + f"select count(*) as records, round(avg(words), 6) as mean, round(stddev_pop(words), 6) as std, cast(min(words) as bigint) as min, cast(max(words) as bigint) as max, round(quantile_cont(words, 0.25), 6) as p25, round(quantile_cont(words, 0.5), 6) as p50, round(quantile_cont(words, 0.75), 6) as p75, round(avg(score), 6) as score_mean, round(stddev_pop(score), 6) as score_std, (select count(distinct t) from (select unnest({toks}) as t from s)) as vocabulary from s",
        "domain_distribution": score + "select domain, count(*) as docs, cast(sum(words) as bigint) as words, round(avg(score), 5) as mean_score from bb group by rollup(domain)",
    }


ORACLE = _oracle()
