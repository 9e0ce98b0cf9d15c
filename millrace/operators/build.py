"""Building a dataset end to end, and the run of the pipeline from urls to the store with resume.

Every stage is a function of DataFrames, so that a plan of all stages is one plan; what must be settled between stages is a
reliable checkpoint.
"""

from __future__ import annotations

import argparse
import dataclasses
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.language import detect
from millrace.functions.links import domain_type, netloc
from millrace.functions.markup import CASCADE, cascade, per_page
from millrace.operators.dataset import DatasetConfig, chunk_tokens, conversation, instruction, select_documents
from millrace.operators.dedup import hybrid_verdicts
from millrace.operators.quality import overall, tier, wired_score, word_count
from millrace.session import build_session, cut_lineage
from millrace.sources import table


def seeded(id_: Column, seed: str, salt: str = "") -> Column:
    """A pseudo-random number of 48 bits from seed and id that any engine can make."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:{salt}:"), id_.cast("string"))), 1, 12), 16, 10).cast("long")


def rejection_sample(docs: DataFrame, shares: dict[str, float] | None, size: int, factor: int = 2, seed: str = "17") -> DataFrame:
    """docs (id, stratum, score) thinned to int(size * share) of each stratum, equal shares by default, better ones kept more often:
    candidates in a seeded order are dealt to groups of up to ``factor`` each (the stratum's size over its quota, if that is less),
    and of each group the best is drawn. A stratum no larger than its quota stays whole.

    The draws are made without replacement and at once rather than one after another; a stratum is ranked within 64 salted parts
    and the parts' sizes give the places, so no stratum is sorted in one task."""
    if shares is None:
        n = docs.select("stratum").distinct().count()
        quota = F.lit(size // max(1, n))
    else:
        quota = F.coalesce(F.try_element_at(F.create_map(*[x for k, v in shares.items() for x in (F.lit(k), F.lit(int(size * v)))]), F.col("stratum")), F.lit(0))
    u = seeded(F.col("id"), seed)
    d = docs.withColumns({"_q": quota.cast("long"), "_u": u, "_p": F.shiftright(u, 42)})  # leading bits: parts in the seeded order
    sizes = d.groupBy("stratum", "_p").agg(F.count(F.lit(1)).alias("c"))
    before = sizes.withColumns({"_at": F.sum("c").over(Window.partitionBy("stratum").orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)) - F.col("c"), "_n": F.sum("c").over(Window.partitionBy("stratum"))}).drop("c")
    place = F.col("_at") + F.row_number().over(Window.partitionBy("stratum", "_p").orderBy("_u", "id")) - 1
    d = d.join(F.broadcast(before), ["stratum", "_p"]).withColumn("_r", place)  # strata times 64 rows
    whole = d.filter("_n <= _q").select("id", "stratum", "score")
    width = F.least(F.lit(factor), F.floor(F.col("_n") / F.col("_q")))
    drawn = d.filter("_n > _q AND _q > 0").withColumn("_g", F.floor(F.col("_r") / width)).filter("_g < _q")
    best = drawn.groupBy("stratum", "_g").agg(F.max_by(F.struct("id", "score"), F.struct("score", -F.col("_r"))).alias("b")).select("b.id", "stratum", "b.score")
    return whole.unionByName(best)


def curriculum(sample: DataFrame) -> DataFrame:
    """``position`` by ascending score, then id: ranks come from a range partitioning, not from one task's sort."""
    parts = cut_lineage(sample.repartitionByRange("score", "id").sortWithinPartitions("score", "id").withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()))
    starts = parts.groupBy("_p").agg(F.count(F.lit(1)).alias("c"), F.min("_i").alias("_m"))
    starts = starts.withColumn("_at", F.sum("c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)) - F.col("c"))  # one row a partition
    return parts.join(F.broadcast(starts.drop("c")), "_p").withColumn("position", F.col("_at") + F.col("_i") - F.col("_m")).drop("_p", "_i", "_m", "_at")


def training_rows(docs: DataFrame, form: str) -> DataFrame:
    """docs (text, title, url, domain, quality_score, language, word_count) as rows of a training form: text, instruction or chat."""
    meta = F.struct("url", "domain", "quality_score").alias("metadata")
    if form == "text":
        return docs.select("text", "title", "url", "quality_score", "word_count", "language", "domain")
    if form == "instruction":
        return docs.select(F.concat(F.lit("Summarize the following content: "), F.coalesce("title", F.lit(""))).alias("instruction"), F.col("text").alias("input"), F.col("title").alias("output"), meta)
    if form == "chat":
        return docs.select(F.array(F.struct(F.lit("user").alias("role"), F.concat(F.lit("Tell me about: "), F.coalesce("title", F.lit(""))).alias("content")), F.struct(F.lit("assistant").alias("role"), F.col("text").alias("content"))).alias("messages"), meta)
    raise ValueError(f"unsupported form: {form}; known: text, instruction, chat")


def formatted(chunks: DataFrame, mode: str, template: str = "Summarize the following content: {text}") -> DataFrame:
    """Chunks (text) as instruction, document or conversation records."""
    rest = [c for c in chunks.columns if c != "text"]
    if mode == "instruction":
        return chunks.select(*rest, instruction(F.col("text"), template).alias("r")).select(*rest, "r.*")
    if mode == "document":
        return chunks.select(*rest, "text")
    if mode == "conversation":
        return chunks.select(*rest, conversation(F.col("text")).alias("messages"))
    raise ValueError(f"unsupported mode: {mode}; known: instruction, document, conversation")


def create_dataset(docs: DataFrame, c: DatasetConfig, mode: str = "document") -> DataFrame:
    """docs (id, text, lang, domain, words, score): selected, sampled by domain, ordered by the curriculum, chunked and formatted."""
    s = rejection_sample(select_documents(docs, c).select("id", F.col("domain").alias("stratum"), "score"), c.balance or None, c.target_size, seed=c.seed)
    text = docs.select("id", F.filter(F.split("text", r"\s+"), lambda w: w != "").alias("w"))
    x = curriculum(s).join(text, "id").select("id", "position", "score", F.posexplode(chunk_tokens(F.col("w"), c.chunk_size, c.chunk_overlap)).alias("chunk", "w"))
    return formatted(x.select("id", "position", "chunk", "score", F.array_join("w", " ").alias("text")), mode, c.instruction)


def report(dataset: DataFrame) -> str:
    """Counts and sizes of a dataset as indented JSON; an empty one says so."""
    r = dataset.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("id").alias("documents"), F.round(F.avg("score"), 6).alias("mean_score")).first()
    return json.dumps(r.asDict() if r.records else {"error": "the dataset is empty"}, indent=2)


@dataclass(frozen=True)
class RunConfig:
    """Settings of a run; unknown keys and wrong values of a file are refused by ``load``."""

    order: tuple = CASCADE
    min_quality: float = 0.6
    near_dedup: bool = True

    @classmethod
    def load(cls, path: str) -> RunConfig:
        """From a JSON file, or a YAML file where a YAML reader is installed."""
        with open(path, encoding="utf-8") as f:
            raw = f.read()
        if path.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as e:
                raise ValueError("no YAML reader is installed; use JSON") from e
            data = yaml.safe_load(raw) or {}
        else:
            data = json.loads(raw)
        unknown = set(data) - {f.name for f in dataclasses.fields(cls)}
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        got = cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in data.items()})
        if not 0 <= got.min_quality <= 1:
            raise ValueError("min_quality must lie between 0 and 1")
        return got


def process(pages: DataFrame, c: RunConfig, done: DataFrame | None = None) -> DataFrame:
    """Pages (request_id, ts, url, content) as rows of the store: the latest delivery of each, text by the cascade, language, scores,
    verdict and the stage that a rejected page failed in. Pages whose request is in ``done`` are skipped, which resumes a run."""
    if done is not None:
        pages = pages.join(done.select("request_id").distinct(), "request_id", "left_anti")
    last = pages.groupBy("request_id").agg(F.max_by(F.struct("ts", "url", "content"), F.struct("ts", F.octet_length("content"))).alias("p")).select("request_id", "p.*")
    order = c.order
    text = per_page(last, lambda h, u: [{k: v for k, v in cascade(h, u, order).items() if k in ("text", "title", "method")}], "text string, title string, method string")
    x = last.select("request_id", "url").join(text, "request_id")
    x = x.select("request_id", "ts", "url", "title", "method", "text", detect(F.col("text")).alias("language"), netloc(F.col("url")).alias("domain"), domain_type(F.col("url")).alias("domain_type"), word_count(F.col("text")).alias("word_count"), wired_score(F.col("text")).alias("quality_score"))
    x = cut_lineage(x)
    if c.near_dedup:
        kept = x.filter((F.col("quality_score") >= c.min_quality) & (F.col("text") != "")).select(F.xxhash64("request_id").alias("ord"), "text")
        v = hybrid_verdicts(kept).withColumnRenamed("ord", "_o")
        x = x.join(v, F.xxhash64("request_id") == v["_o"], "left").drop("_o")
    else:
        x = x.withColumn("verdict", F.lit("unchecked"))
    failed = F.when(F.col("text") == "", "extraction").when(F.col("quality_score") < c.min_quality, "quality").when(F.col("verdict").isin("exact", "near"), "deduplication")
    return x.withColumns({"rejected_by": failed, "tier": tier(F.col("quality_score"))})


def main(argv: list[str] | None = None) -> None:
    """``run PAGES OUT [--config FILE] [--resume]``: pages of a Parquet table through all stages into a table."""
    p = argparse.ArgumentParser(prog="millrace")
    p.add_argument("pages")
    p.add_argument("out")
    p.add_argument("--config")
    p.add_argument("--resume", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    a = p.parse_args(argv)
    c = RunConfig.load(a.config) if a.config else RunConfig()
    if a.dry_run:
        print(json.dumps(dataclasses.asdict(c), indent=2))
        return
    spark = build_session()
    done = spark.read.parquet(a.out).select("request_id") if a.resume else None
    process(spark.read.parquet(a.pages).select("request_id", "ts", "url", "content"), c, done).write.mode("append" if a.resume else "errorifexists").parquet(a.out)


def _docs(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"), F.lower("lang").alias("lang"), F.coalesce("domain_type", F.lit("general")).alias("domain"))
    return cut_lineage(t.withColumn("words", word_count(F.col("text"))).withColumn("score", F.round(overall(F.col("text"), F.col("domain")), 6)))


def dataset_rejection(spark, d):
    """A sample of 200 documents by domain type, better ones more often, in the order of the curriculum."""
    s = rejection_sample(_docs(spark, d).select("id", F.col("domain").alias("stratum"), "score"), None, 200)
    return curriculum(s).select(F.col("id").alias("doc_id"), F.col("stratum").alias("domain"), "score", "position")


def dataset_created(spark, d):
    """Records of a dataset built with the default configuration."""
    x = create_dataset(_docs(spark, d), DatasetConfig())
    return x.select(F.col("id").alias("doc_id"), "position", F.col("chunk").cast("long").alias("chunk"), F.md5("text").alias("text_md5"))


def training_chat(spark, d):
    e = table(spark, d, "extracted_content").select("extract_id", "text", "title", "url", netloc(F.col("url")).alias("domain"), F.col("confidence_score").alias("quality_score"), "language", "word_count")
    x = training_rows(e.withColumn("url", F.concat_ws("#", "url", "extract_id")), "chat")
    return x.select(F.substring_index("metadata.url", "#", -1).cast("long").alias("extract_id"), F.col("messages")[0]["content"].alias("question"), F.md5(F.coalesce(F.col("messages")[1]["content"], F.lit(""))).alias("answer_md5"))


def pipeline_run(spark, d):
    """Every page through all stages: its tier, verdict and the stage that rejected it."""
    pages = table(spark, d, "crawl_results").select("request_id", "ts", F.coalesce("final_url", "url").alias("url"), "content")
    return process(pages, RunConfig()).select("request_id", "method", "language", "domain_type", F.round("quality_score", 6).alias("quality_score"), "tier", "verdict", "rejected_by")


QUERIES = {f.__name__: f for f in (dataset_rejection, dataset_created, training_chat, pipeline_run)}


def _oracle() -> dict:
    from millrace.operators.quality import ORACLE as Q

    base = Q["quality_overall"].split("select doc_id, overall, case")[0] + ", bb as (select doc_id, coalesce(d.domain_type, 'general') as domain, coalesce(d.text, '') as text, lower(lang) as lang, len(list_filter(string_split_regex(coalesce(d.text, ''), '\\s+'), lambda x: x <> '')) as words, overall as score from documents d join (select doc_id, overall from o) using (doc_id)) "
    draw = ", {n}q as (select doc_id, domain, score, ('0x' || substr(md5('17::' || doc_id), 1, 12))::bigint as u from {src}), {n}r as (select *, row_number() over (partition by domain order by u, doc_id) - 1 as r, count(*) over (partition by domain) as n, 200 // (select count(distinct domain) from {n}q) as quota from {n}q), {n}g as (select *, r // greatest(1, least(2, n // greatest(1, quota))) as g from {n}r where n > quota), {n}b as (select doc_id, domain, score from {n}r where n <= quota union all select unnest(arg_max(struct_pack(doc_id := doc_id, domain := domain, score := score), struct_pack(s := score, r := -r))) from {n}g where g < quota group by domain, g), {n}s as (select *, row_number() over (order by score, doc_id) - 1 as position from {n}b) "
    chunk = "select doc_id, position, i // 462 as chunk, md5(array_to_string(w[i + 1:i + 512], ' ')) as text_md5 from (select doc_id, position, w, unnest(case when len(w) = 0 then [] when len(w) <= 512 then [0] else range(0, len(w), 462) end) as i from (select doc_id, position, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') as w from ss join bb using (doc_id)))"
    return {
        "dataset_rejection": base + draw.format(n="s", src="bb") + "select doc_id, domain, score, position from ss",
        "dataset_created": base + ", sel as (select * from bb where score >= 0.3 and words between 50 and 50000 and lang = 'en')" + draw.format(n="s", src="sel") + chunk,
        "training_chat": "select extract_id, 'Tell me about: ' || coalesce(title, '') as question, md5(coalesce(text, '')) as answer_md5 from extracted_content",
    }


ORACLE = _oracle()
