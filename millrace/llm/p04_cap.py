"""Problem 4: a bounded number of records per dominant contributor, the best by quality.

Stratum-aware cap: the cap of a contributor is split over its strata (a topic, a period, or one stratum)
by largest remainder, spare slots go to strata that can use them, and inside a stratum rows are ranked by quality.

Ranks are never taken by sorting a whole contributor in one task: a histogram over quality buckets gives the
bucket in which the quota ends; only that bucket is resolved further, first by exact quality, then by blocks of
ids. Every window below runs over pre-aggregated counts or over one such block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.canon import clean_domain, site_of
from millrace.session import cut_lineage
from millrace.sources import table

#: Quality is cut into this many buckets between its bounds; a number of rows per id block bounds one task's sort.
BUCKETS = 1024
ID_BLOCK = 1 << 14


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row of each key with the largest ``order`` tuple, by aggregation with map-side combine (a hot key is
    combined in every map task first). Rows whose key is null are each kept as their own key."""
    cols = [c for c in df.columns if c not in order and c != key]
    keyed = df.filter(F.col(key).isNotNull())
    top = keyed.groupBy(key).agg(F.max(F.struct(*order, *cols)).alias("_top")).select(key, "_top.*").select(*df.columns)
    return top.unionByName(df.filter(F.col(key).isNull()))


def _ends(hist: DataFrame, keys: list[str], level: Column, quota: str) -> DataFrame:
    """Of a histogram (keys, _b, _n, quota): per key the level at which the quota ends and the rows before it."""
    w = Window.partitionBy(*keys).orderBy(level).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = hist.withColumn("_cum", F.sum("_n").over(w)).withColumn("_before", F.col("_cum") - F.col("_n"))
    return c.filter((F.col("_before") <= F.col(quota)) & (F.col("_cum") > F.col(quota)))


def over_quota(rows: DataFrame, quotas: DataFrame, keys: list[str], quality: str, id_: str, small: bool, keep_keys: bool = False) -> DataFrame:
    """Rows beyond their key's quota in the order quality descending (null and NaN last), id ascending.

    ``quotas``: keys and ``_quota``, only of keys that hold more rows than their quota. ``small``: the number of such
    keys has a proven bound (see ``cap_contributors``), so they may be broadcast; otherwise they are joined."""
    hint = F.broadcast if small else (lambda d: d)
    q = F.when(F.isnan(quality), F.lit(None)).otherwise(F.col(quality))
    r = rows.select(*keys, F.col(id_).alias("_id"), (-q).alias("_q")).join(hint(quotas), keys)
    r = cut_lineage(r)  # only rows of keys over their quota, four narrow columns; read several times below
    lo, hi = r.agg(F.min("_q"), F.max("_q")).first()
    span = (hi - lo) if lo is not None and hi > lo else 1.0
    # _b ascends as quality descends; unknown quality comes last
    r = r.withColumn("_b", F.coalesce(F.floor((F.col("_q") - F.lit(lo if lo is not None else 0.0)) / F.lit(span) * BUCKETS).cast("int"), F.lit(BUCKETS + 1)))
    hist = r.groupBy(*keys, "_b", "_quota").agg(F.count(F.lit(1)).alias("_n"))
    end1 = _ends(hist, keys, F.col("_b"), "_quota").select(*keys, F.col("_b").alias("_eb"), (F.col("_quota") - F.col("_before")).alias("_left"))
    r = r.join(hint(end1), keys)
    out = [*keys, "_id"] if keep_keys else ["_id"]
    beyond = r.filter(F.col("_b") > F.col("_eb")).select(*out)
    edge = r.filter(F.col("_b") == F.col("_eb")).select(*keys, "_id", F.coalesce("_q", F.lit(float("inf"))).alias("_q"), "_left")
    hist2 = edge.groupBy(*keys, "_q", "_left").agg(F.count(F.lit(1)).alias("_n"))
    end2 = _ends(hist2, keys, F.col("_q"), "_left").select(*keys, F.col("_q").alias("_eq"), (F.col("_left") - F.col("_before")).alias("_left2"))
    edge = edge.join(hint(end2), keys)
    beyond = beyond.unionByName(edge.filter(F.col("_q") > F.col("_eq")).select(*out))
    tie = edge.filter(F.col("_q") == F.col("_eq")).select(*keys, "_id", "_left2", F.floor(F.col("_id") / ID_BLOCK).alias("_blk"))
    hist3 = tie.groupBy(*keys, "_blk", "_left2").agg(F.count(F.lit(1)).alias("_n"))
    end3 = _ends(hist3, keys, F.col("_blk"), "_left2").select(*keys, F.col("_blk").alias("_eblk"), (F.col("_left2") - F.col("_before")).alias("_left3"))
    tie = tie.join(hint(end3), keys)
    beyond = beyond.unionByName(tie.filter(F.col("_blk") > F.col("_eblk")).select(*out))
    last = tie.filter(F.col("_blk") == F.col("_eblk")).withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy("_id")))
    return beyond.unionByName(last.filter(F.col("_rn") > F.col("_left3")).select(*out)).withColumnRenamed("_id", id_)


def stratum_quotas(counts: DataFrame, contributor: str, stratum: str, cap: int) -> DataFrame:
    """Largest-remainder shares of ``cap`` over the strata of each contributor that exceeds it.

    ``counts``: contributor, stratum, _n. A stratum's share is cap * _n / total, rounded down; the slots left go to the
    largest remainders (ties: larger stratum, then its name). As a share never exceeds the stratum's rows when the total
    exceeds the cap, spare slots arise only from rounding; they are redistributed by the same order of remainders."""
    w = Window.partitionBy(contributor)
    c = counts.withColumn("_total", F.sum("_n").over(w)).filter(F.col("_total") > cap)
    c = c.withColumn("_exact", F.col("_n") * F.lit(cap) / F.col("_total")).withColumn("_base", F.floor("_exact").cast("long"))
    c = c.withColumn("_spare", F.lit(cap) - F.sum("_base").over(w))
    rank = F.row_number().over(w.orderBy((F.col("_exact") - F.col("_base")).desc(), F.col("_n").desc(), F.col(stratum).asc_nulls_last()))
    c = c.withColumn("_quota", F.col("_base") + F.when(rank <= F.col("_spare"), 1).otherwise(0))
    return c.filter(F.col("_n") > F.col("_quota")).select(contributor, stratum, "_quota")


def cap_contributors(rows: DataFrame, contributor: Column, quality: str, id_: str, cap: int, stratum: Column | None = None, max_over: int | None = None) -> DataFrame:
    """Ids of the rows that exceed their contributor's cap.

    Nulls: a null contributor counts as ''; a null stratum is a stratum; null quality ranks last; ids are unique.
    An empty table gives no row; extra columns are ignored; repeated rows count as rows; ties go to the smaller id.
    ``max_over`` is a proven bound on (contributor, stratum) keys over their quota, e.g. 1/f when the cap is the
    fraction f of all rows; with it these keys are broadcast, without it they are joined by shuffle."""
    r = rows.select(F.coalesce(contributor, F.lit("")).alias("_who"), F.coalesce((stratum if stratum is not None else F.lit("all")).cast("string"), F.lit("")).alias("_what"), F.col(quality).cast("double").alias("_quality"), F.col(id_).alias("_rid"))
    counts = r.groupBy("_who", "_what").agg(F.count(F.lit(1)).alias("_n"))
    quotas = stratum_quotas(counts, "_who", "_what", cap)
    out = over_quota(r, quotas, ["_who", "_what"], "_quality", "_rid", small=max_over is not None and max_over <= 10_000)
    return out.select(F.col("_rid").alias(id_))


#: The cap of TESTDATA.md: one fiftieth of the distinct contents.
CAP_SHARE = 50


def _contents(spark, d: str) -> DataFrame:
    """The latest row of each content with its contributor; narrow, checkpointed because counts and ranks both read it."""
    t = table(spark, d, "processed_content").select("content_id", "processed_at", "id", "domain", "url", "quality_score", "published_date")
    dom = clean_domain(F.col("domain"))
    return cut_lineage(latest_per_key(t, "content_id", ["processed_at", "id"]).select("content_id", "id", "quality_score", F.when(dom == "", site_of(F.col("url"))).otherwise(dom).alias("who"), F.date_trunc("quarter", "published_date").cast("date").alias("period")))


def _cap(rows: DataFrame) -> int:
    return rows.filter(F.col("content_id").isNotNull()).count() // CAP_SHARE


def p4_found(spark, d: str) -> DataFrame:
    rows = _contents(spark, d)
    return cap_contributors(rows, F.col("who"), "quality_score", "id", _cap(rows), max_over=2 * CAP_SHARE)


def p4_stratified(spark, d: str) -> DataFrame:
    """Ids dropped when each contributor's cap is shared over publication quarters."""
    rows = _contents(spark, d)
    return cap_contributors(rows, F.col("who"), "quality_score", "id", _cap(rows), stratum=F.col("period"))


QUERIES = {"p4_found": p4_found, "p4_stratified": p4_stratified}

_BASE = """
with latest as (
  select * from (select *, row_number() over (partition by content_id order by processed_at desc nulls last, id desc) rn from processed_content) where rn = 1
), who as (
  select id, quality_score, cast(date_trunc('quarter', published_date) as date) as period,
    case when dom = '' then regexp_replace(lower(regexp_extract(trim(coalesce(url, '')), '^(?:[a-zA-Z][a-zA-Z0-9+.\\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^(www|m)\\.', '') else dom end as who
  from (select *, regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce(domain, ''))), '^www\\.', ''), ':[0-9]*$', ''), '\\.$', '') as dom from latest)
), cap as (select count(distinct content_id) // 50 as cap from processed_content)
"""

ORACLE = {
    "p4_found": _BASE + """
select id from (select id, row_number() over (partition by who order by quality_score desc nulls last, id) rn from who), cap where rn > cap""",
    "p4_stratified": _BASE + """
, n as (select who, coalesce(cast(period as varchar), '') as p, count(*) as n from who group by all),
t as (select *, sum(n) over (partition by who) as total from n),
e as (select *, n * cap.cap / total as exact from t, cap where total > cap.cap),
q as (select *, floor(exact) + case when row_number() over (partition by who order by exact - floor(exact) desc, n desc, p) <= cap - sum(floor(exact)) over (partition by who) then 1 else 0 end as quota from e)
select id from (select w.id, q.quota, row_number() over (partition by w.who, coalesce(cast(w.period as varchar), '') order by w.quality_score desc nulls last, w.id) rn
  from who w join q on q.who = w.who and q.p = coalesce(cast(w.period as varchar), '')) where rn > quota""",
}
