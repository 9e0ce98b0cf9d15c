"""Reads and writes of the content store: filtered reads, point lookup, full-text search, statistics and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.canon import clean_domain
from millrace.sources import table

K1, B = 1.2, 0.75
FORMATS = ("parquet", "json", "jsonl", "orc", "csv")


def write_content(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("domain", "date"), codec: str = "zstd", mode: str = "append") -> None:
    """Partitioned Parquet; rows of one partition value are brought together over several files when many."""
    cols = [c for c in partition_by if c in df.columns]
    w = (df.repartition(*cols, F.pmod(F.xxhash64(*df.columns[:1]), F.lit(16))) if cols else df).write.mode(mode).option("compression", codec)
    (w.partitionBy(*cols) if cols else w).parquet(path)


def export(df: DataFrame, path: str, fmt: str = "jsonl", mode: str = "errorifexists") -> None:
    """A dataset as parquet, jsonl/json lines, orc or csv; an unknown format or an empty dataset is refused."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format: {fmt}; supported: {', '.join(FORMATS)}")
    if df.isEmpty():
        raise ValueError("the dataset is empty")
    df.write.mode(mode).format({"jsonl": "json"}.get(fmt, fmt)).save(path)


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """The non-blank lines of a text file, trimmed."""
    return spark.read.text(path).select(F.trim("value").alias("url")).filter("url != ''")


def read_jsonl_valid(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines that fit the schema; broken lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def expire(df: DataFrame, ts: str, days: int, now) -> DataFrame:
    """Rows not older than so many days."""
    return df.filter(F.col(ts) >= F.lit(now) - F.expr(f"INTERVAL {int(days)} DAYS"))


def search(docs: DataFrame, query: str, limit: int = 20) -> DataFrame:
    """BM25 over (id, text): the ``limit`` best documents for the words of a query. Only the query's words are exploded; the
    collection's size and mean length come from one aggregate row."""
    terms = sorted({w for w in query.lower().split() if w})
    toks = F.filter(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"([\p{L}\p{N}_]+)"), 1), lambda w: w != "")
    t = docs.select("id", F.size(toks).alias("len"), F.filter(toks, lambda w: w.isin(*terms)).alias("hits"))
    stats = t.agg(F.count(F.lit(1)).alias("n"), F.avg("len").alias("mean"))
    tf = t.filter(F.size("hits") > 0).select("id", "len", F.explode("hits").alias("w")).groupBy("id", "len", "w").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("w").agg(F.count(F.lit(1)).alias("df"))  # one row for each word of the query
    j = tf.join(F.broadcast(df), "w").join(F.broadcast(stats))
    s = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)) * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("mean")))
    return j.groupBy("id").agg(F.sum(s).alias("score")).orderBy(F.desc(F.round("score", 9)), "id").limit(limit)


def _content(spark, d):
    return table(spark, d, "processed_content")


def store_query(spark, d):
    """Newest 100 contents of at least the given quality (a top-k read: the limit is the feature)."""
    return _content(spark, d).filter("quality_score >= 0.7").select("id", "content_id", "quality_score", "processed_at").orderBy(F.desc("processed_at"), F.desc("id")).limit(100)


def recent_top(spark, d):
    return _content(spark, d).select("id", "processed_at").orderBy(F.desc("processed_at"), F.desc("id")).limit(50)


def metadata_lookup(spark, d):
    """The id and validity of each row's JSON metadata."""
    return _content(spark, d).select("id", F.when(F.col("full_metadata").isNull() | F.try_parse_json("full_metadata").isNull(), "invalid_metadata").otherwise("ok").alias("state"))


def fts_bm25(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return search(docs, "quiet harbour budget", 20).select(F.col("id").alias("doc_id"), F.round("score", 5).alias("score"))


def store_stats(spark, d):
    """Totals, distinct contents, mean quality, duplicates and rows of the newest day."""
    t = _content(spark, d)
    newest = t.agg(F.max("processed_at").alias("newest"))
    return t.join(F.broadcast(newest)).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("content_id").alias("contents"), F.round(F.avg("quality_score"), 5).alias("mean_quality"), F.count_if("is_duplicate").alias("duplicates"), F.count_if(F.col("processed_at") > F.col("newest") - F.expr("INTERVAL 24 HOURS")).alias("last_day"))


def domain_report(spark, d):
    return _content(spark, d).groupBy(clean_domain(F.col("domain")).alias("domain")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("quality_score"), 5).alias("mean_quality"))


QUERIES = {f.__name__: f for f in (store_query, recent_top, metadata_lookup, fts_bm25, store_stats, domain_report)}

ORACLE = {
    "store_query": "select id, content_id, quality_score, processed_at from processed_content where quality_score >= 0.7 order by processed_at desc nulls last, id desc limit 100",
    "recent_top": "select id, processed_at from processed_content order by processed_at desc nulls last, id desc limit 50",
    "fts_bm25": r"""with t as (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') as w from documents), s as (select count(*) as n, avg(len(w)) as m from t), e as (select doc_id, len(w) as l, unnest(w) as w from t),
 f as (select doc_id, l, w, count(*) as tf from e where w in ('quiet', 'harbour', 'budget') group by all), g as (select w, count(*) as df from f group by w)
 select doc_id, round(sc, 5) as score from (select doc_id, sum(ln(1 + (n - df + 0.5::double) / (df + 0.5::double)) * tf * 2.2::double / (tf + 1.2::double * (0.25::double + 0.75::double * l / m))) as sc from f join g using (w), s group by doc_id order by round(sc, 9) desc, doc_id limit 20)""",
    "store_stats": "select count(*) as rows, count(distinct content_id) as contents, round(avg(quality_score), 5) as mean_quality, count(*) filter (is_duplicate) as duplicates, count(*) filter (processed_at > (select max(processed_at) from processed_content) - interval 24 hour) as last_day from processed_content",
    "domain_report": r"select regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce(domain, ''), ' ')), '^www\.', ''), ':\d*$', ''), '\.$', '') as domain, count(*) as n, round(avg(quality_score), 5) as mean_quality from processed_content group by 1",
}
