"""The content store as two tables, its writes, reads, checkpoints, audit log and upkeep, on files that all executors share.

A write is one commit of Spark's protocol for each table; text goes before metadata, so that a metadata row never lacks its text.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
from dataclasses import asdict, dataclass, field, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.canon import clean_domain
from millrace.functions.clean import slugify
from millrace.functions.markup import html_text
from millrace.sources import table

META = ("content_id", "url", "content_hash", "title", "description", "domain", "author", "published_date", "quality_score", "is_duplicate", "processed_at")
AUDIT = "at timestamp, user_id string, action string, resource string, details map<string, string>"
SECRET = r"(?i)password|secret|token|key|credential"


def store_contents(df: DataFrame, root: str) -> None:
    """Rows (content_id, text and any of META) to the text table, then to the metadata table by day; a failed second write leaves
    texts without metadata, which reads do not see and ``compact`` takes off."""
    df.select("content_id", F.coalesce("text", F.lit("")).alias("text")).write.mode("append").option("compression", "zstd").parquet(f"{root}/text")
    meta = df.select(*[c for c in META if c in df.columns])
    meta.withColumn("day", F.to_date("processed_at")).write.mode("append").partitionBy("day").option("compression", "zstd").parquet(f"{root}/meta")


def raw_contents(crawl: DataFrame) -> DataFrame:
    """Crawl results as rows of the store before extraction: the body as text, the rest as JSON, no scores."""
    rest = [c for c in crawl.columns if c not in ("content", "headers")]
    return crawl.select(F.col("request_id").alias("content_id"), "url", html_text(F.col("content")).alias("text"), F.to_json(F.struct(*rest)).alias("full_metadata"), F.lit(0.0).alias("quality_score"), F.col("ts").alias("processed_at"))


def document_rows(docs: DataFrame) -> DataFrame:
    """Loose documents (any of text, url, title) with the defaults of the store."""
    get = lambda c, d: F.coalesce(F.col(c), F.lit(d)) if c in docs.columns else F.lit(d)
    x = docs.select(get("text", "").alias("text"), get("url", "").alias("url"), get("title", "").alias("title"))
    return x.withColumns({"content_id": F.sha2(F.concat_ws("\x1f", "url", "text"), 256), "content_hash": F.sha2("text", 256), "quality_score": F.lit(0.0), "is_duplicate": F.lit(False), "processed_at": F.current_timestamp()})


def query_contents(meta: DataFrame, text: DataFrame | None = None, domain: str | None = None, min_quality: float = 0.0, limit: int = 100) -> DataFrame:
    """The newest contents of a domain and least quality, with their text where given; one without text has null."""
    x = meta
    if domain is not None:
        x = x.filter(clean_domain(F.col("domain")) == domain)
    if min_quality > 0:
        x = x.filter(F.col("quality_score") >= min_quality)
    x = x.orderBy(F.desc("processed_at"), "content_id").limit(limit)
    return x if text is None else x.join(text.dropDuplicates(["content_id"]), "content_id", "left")


def content_by_url(contents: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted urls with the latest content of each; urls without content are left out."""
    last = contents.groupBy("url").agg(F.max_by(F.struct(*[c for c in contents.columns if c != "url"]), F.struct("processed_at", "id")).alias("c"))
    return wanted.select("url").distinct().join(last, "url").select("url", "c.*")


def metadata_of(meta: DataFrame, content_id) -> DataFrame:
    """The JSON metadata of one id as text; broken JSON is '{}', an unknown id has no row."""
    return meta.filter(F.col("id") == content_id).select("id", F.when(F.try_parse_json("full_metadata").isNull(), "{}").otherwise(F.col("full_metadata")).alias("metadata"))


def compact(spark: SparkSession, path: str, to: str, files: int = 16) -> None:
    """A copy of a table in few files, which is also its backup."""
    spark.read.parquet(path).repartition(files).write.mode("errorifexists").parquet(to)


def remove_ids(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among those to be removed."""
    return df.join(gone.select(key).distinct(), key, "left_anti")


def append_audit(events: DataFrame, root: str) -> None:
    """Audit events (AUDIT) as JSON lines by day; values of secret keys are masked."""
    mask = lambda k, v: F.when(k.rlike(SECRET), F.when(F.length(v) > 4, F.concat(F.substring(v, 1, 2), F.lit("***"), F.substring(v, -2, 2))).otherwise("***")).otherwise(v)
    events.withColumns({"details": F.transform_values("details", mask), "day": F.to_date("at")}).write.mode("append").partitionBy("day").json(root)


def user_activity(spark: SparkSession, root: str, user: str, first: str, last: str) -> DataFrame:
    """A user's audit events of some days, only those days' files being read; broken lines are left out."""
    t = spark.read.schema(AUDIT + ", day date").option("mode", "DROPMALFORMED").json(root)
    return t.filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")) & (F.col("user_id") == user))


def write_json(data, path: str) -> bool:
    """A small file written whole or not at all: beside its place first, then moved over it."""
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    fd, temp = tempfile.mkstemp(dir=folder, suffix=".part")
    try:
        with os.fdopen(fd, "w", encoding="utf-8") as f:
            json.dump(data, f, ensure_ascii=False, default=str)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temp, path)
        return True
    except OSError:
        if os.path.exists(temp):
            os.unlink(temp)
        return False


@dataclass
class Checkpoint:
    """Progress of a job: what is done and what remains."""

    job_id: str
    stage: str = "start"
    processed: int = 0
    failed: int = 0
    remaining: list = field(default_factory=list)
    errors_by_stage: dict = field(default_factory=dict)

    def save(self, folder: str) -> str:
        path = os.path.join(folder, re.sub(r"[^A-Za-z0-9._-]", "-", self.job_id) + ".json")
        return path if write_json(asdict(self), path) else ""

    @classmethod
    def load(cls, path: str) -> Checkpoint:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        known = {x.name for x in fields(cls)}
        return cls(**{k: v for k, v in data.items() if k in known})


def validate_files(lines: DataFrame) -> DataFrame:
    """(file, bytes, records, bad, mean_bytes) of JSON lines read with their file: how many there are and do not parse."""
    ok = F.try_parse_json("value").isNotNull()
    return lines.filter("trim(value) != ''").groupBy("file").agg(F.max("size").alias("bytes"), F.count(F.lit(1)).alias("records"), F.count_if(~ok).alias("bad"), F.avg(F.octet_length("value")).alias("mean_bytes"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))


def export_folder(df: DataFrame, path: str, name: str, license_: str = "unknown") -> None:
    """A dataset folder: Parquet and a card with its columns and row count."""
    df.write.mode("errorifexists").parquet(f"{path}/data")
    n = df.sparkSession.read.parquet(f"{path}/data").count()
    card = df.sparkSession.createDataFrame([(json.dumps({"name": name, "license": license_, "rows": n, "columns": df.schema.simpleString()}),)], "value string")
    card.coalesce(1).write.mode("errorifexists").text(f"{path}/card")


def fresh_responses(cache: DataFrame, urls: DataFrame, now: Column, hours: int = 1) -> DataFrame:
    """Urls with the cached response of at most so many hours, its tags for a conditional request; others have nulls."""
    ok = cache.filter(F.col("fetched_at") >= now - F.make_dt_interval(F.lit(0), F.lit(hours)))
    last = ok.groupBy("url").agg(F.max_by(F.struct("etag", "last_modified", "fetched_at"), "fetched_at").alias("c"))
    return urls.join(last, "url", "left").select("url", "c.*")


def assign_proxy(urls: DataFrame, proxies: list[str]) -> DataFrame:
    """Each url with a proxy of its scheme, spread evenly and always the same."""
    by = {s: [p for p in proxies if p.startswith(s)] or proxies for s in ("http://", "https://")}
    pick = lambda ps: F.element_at(F.array(*map(F.lit, ps)), (F.pmod(F.xxhash64("url"), F.lit(len(ps))) + 1).cast("int"))
    return urls.withColumn("proxy", F.when(F.col("url").startswith("https://"), pick(by["https://"])).otherwise(pick(by["http://"])))


def assign_agent(urls: DataFrame, agents: dict[str, list[str]], weights: dict[str, float], seed: int = 7) -> DataFrame:
    """Each url with a user agent: its kind by weight, made to sum to 1 over the kinds given, then evenly; seeded."""
    kinds = [k for k in weights if agents.get(k)]
    total = sum(weights[k] for k in kinds)
    u = F.pmod(F.xxhash64("url", F.lit(seed)), F.lit(1_000_000)) / 1_000_000.0
    out, upto = F.lit(None).cast("string"), 1.0
    for k in reversed(kinds):
        one = F.element_at(F.array(*map(F.lit, agents[k])), (F.pmod(F.xxhash64("url", F.lit(seed + 1)), F.lit(len(agents[k]))) + 1).cast("int"))
        upto -= weights[k] / total
        out = one if k == kinds[-1] else F.when(u < upto + weights[k] / total, one).otherwise(out)
    return urls.withColumn("agent", out)


def robots_allow(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls (url, netloc) with ``allowed`` by rules (netloc, disallow array<string>): no rule's path begins the url's path; hosts
    without rules allow all. rules are one row a host."""
    path = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    x = urls.join(rules, "netloc", "left")
    return x.withColumn("allowed", ~F.exists(F.coalesce("disallow", F.array().cast("array<string>")), lambda p: (p != "") & F.startswith(path, p))).drop("disallow")


def _contents(spark, d):
    return table(spark, d, "processed_content")


def store_search(spark, d):
    """Full-text search over title and description: the 20 best rows for two words."""
    from millrace.operators.store import search

    t = _contents(spark, d).select("id", F.concat_ws(" ", "title", "description").alias("text"))
    return search(t, "harbour bridge", 20).select("id", F.round("score", 5).alias("score"))


def store_domain_query(spark, d):
    """The newest 50 contents of the largest domain with a quality of at least a half."""
    t = _contents(spark, d).select("id", "content_id", "domain", "quality_score", "processed_at").withColumn("d", clean_domain(F.col("domain")))
    top = t.filter("d != ''").groupBy("d").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1)
    return t.join(F.broadcast(top), "d").filter("quality_score >= 0.5").orderBy(F.desc("processed_at"), F.desc("id")).limit(50).select("id", "content_id", "quality_score")  # one-row side


def content_lookup(spark, d):
    """The latest content of the url of each extracted record."""
    c = _contents(spark, d).select("id", "url", "processed_at", "quality_score")
    e = table(spark, d, "extracted_content").select("url").filter("url IS NOT NULL")
    return content_by_url(c, e).select("url", "id", "quality_score")


def file_names(spark, d):
    """Safe file names of titles and how many titles share each."""
    return table(spark, d, "extracted_content").select(slugify(F.col("title")).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


def domain_rollup(spark, d):
    """Contents, mean quality, mean words and share of duplicates by domain, and in all, in one pass."""
    t = _contents(spark, d).select(clean_domain(F.col("domain")).alias("domain"), "quality_score", "is_duplicate", F.size(F.filter(F.split(F.coalesce("description", F.lit("")), r"\s+"), lambda w: w != "")).alias("words"))
    return t.rollup("domain").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("quality_score"), 5).alias("mean_quality"), F.round(F.avg("words"), 5).alias("mean_words"), F.round(F.avg(F.col("is_duplicate").cast("double")), 5).alias("duplicate_rate"))


QUERIES = {f.__name__: f for f in (store_search, store_domain_query, content_lookup, file_names, domain_rollup)}

_D = r"regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce(domain, ''), ' ')), '^www\.', ''), ':\d*$', ''), '\.$', '')"
ORACLE = {
    "store_search": r"""with t as (select id, regexp_extract_all(lower(concat_ws(' ', title, description)), '[\p{L}\p{N}_]+') as w from processed_content), s as (select count(*) as n, avg(len(w)) as m from t), e as (select id, len(w) as l, unnest(w) as w from t),
 f as (select id, l, w, count(*) as tf from e where w in ('harbour', 'bridge') group by all), g as (select w, count(*) as df from f group by w)
 select id, round(sc, 5) as score from (select id, sum(ln(1 + (n - df + 0.5::double) / (df + 0.5::double)) * tf * 2.2::double / (tf + 1.2::double * (0.25::double + 0.75::double * l / m))) as sc from f join g using (w), s group by id order by round(sc, 9) desc, id limit 20)""",
    "store_domain_query": f"with t as (select *, {_D} as d from processed_content), top as (select d from t where d <> '' group by d order by count(*) desc, d limit 1) select id, content_id, quality_score from t where d = (select d from top) and quality_score >= 0.5 order by processed_at desc, id desc limit 50",
    "content_lookup": "select url, arg_max(id, struct_pack(a := processed_at, b := id)) as id, arg_max(struct_pack(q := quality_score), struct_pack(a := processed_at, b := id)).q as quality_score from processed_content where url in (select url from extracted_content) group by url",
    "domain_rollup": rf"select domain, count(*) as n, round(avg(quality_score), 5) as mean_quality, round(avg(len(list_filter(string_split_regex(coalesce(description, ''), '\s+'), lambda x: x <> ''))), 5) as mean_words, round(avg(is_duplicate::int), 5) as duplicate_rate from (select * replace ({_D} as domain) from processed_content) group by rollup(domain)",
}
