"""Deduplication of the reference pipeline: exact, MinHash, vectors and fuzzy strings, as set-at-a-time joins.

All levels ask whether an earlier document, itself no exact copy, is similar enough; with a total order on documents
that is an ordered semi-join, so no level depends on the order in which partitions arrive.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.edits import near_strings
from millrace.operators.sets import set_links, signed
from millrace.session import cut_lineage
from millrace.sources import table

# Thresholds of each content type, MinHash parameters (bands, rows) by threshold.
SEMANTIC = {"medical": 0.9, "legal": 0.88, "technical": 0.85, "ecommerce": 0.8, "general": 0.85}
BANDS = {0.85: (8, 16), 0.8: (9, 13), 0.5: (25, 5)}
PERMUTATIONS = 128
SHINGLE = 7


def content_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def canonical_html(html: Column) -> Column:
    """Text of markup by patterns: scripts, styles, comments and tags dropped, six entities decoded, white space collapsed."""
    raw = t = F.coalesce(html, F.lit(""))
    for p in (r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?s)<!--.*?-->"):
        t = F.regexp_replace(t, p, "")
    t = F.when(F.contains(raw, F.lit("<")), F.regexp_replace(t, r"(?s)<[^>]+>", " ")).otherwise(raw)  # no pattern matches without it
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def mark_exact(docs: DataFrame, key: Column, order: str) -> DataFrame:
    """``docs`` with is_duplicate: not the first of its key in ``order``. The first is found by an aggregate that combines in the
    map tasks, so that a hot key is no task's sort; every row is then compared to it."""
    keyed = docs.withColumn("_k", key)
    first = keyed.groupBy("_k").agg(F.min(order).alias("_first"))
    return keyed.join(first, "_k").withColumn("is_duplicate", F.col(order) > F.col("_first")).drop("_k", "_first")


def _shingle_hashes(texts: pd.Series) -> pd.Series:
    mul = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1)) & 0xFFFFFFFFFFFFFFFF for k in range(SHINGLE)], dtype=np.uint64)
    out = []
    for raw in texts:
        raw = raw or ""
        t = " ".join(raw.lower().split()) if len(raw) >= SHINGLE else raw.ljust(SHINGLE, "\0")
        cp = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        n = len(cp) - SHINGLE + 1
        h = sum((cp[k : k + n] * mul[k] for k in range(1, SHINGLE)), cp[:n] * mul[0]) if n > 0 else np.zeros(0, np.uint64)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h.sort()
        out.append(h[np.concatenate(([True], h[1:] != h[:-1]))].view(np.int64) if n > 0 else h.view(np.int64))
    return pd.Series(out)


def _shingle_sets(texts: list) -> list[np.ndarray]:
    return [h.view(np.uint64) for h in _shingle_hashes(pd.Series(texts, dtype=object))]


def shingles(text: Column) -> Column:
    """Hashes of the distinct 7-character windows of lower-case collapsed text; a raw text shorter than that is its own shingle, and
    one that only collapsing makes shorter has none. Arrow batches: in an SQL lambda each window would walk the text again."""
    return F.pandas_udf(_shingle_hashes, T.ArrayType(T.LongType()))(text)


def tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_]+", " ")), " "), lambda w: w != ""))


def _signature(sets: pd.Series) -> pd.Series:
    rng = np.random.RandomState(1)
    prime = np.uint64((1 << 61) - 1)
    a, b = rng.randint(1, 1 << 31, PERMUTATIONS).astype(np.uint64), rng.randint(0, 1 << 31, PERMUTATIONS).astype(np.uint64)
    out = []
    for s in sets:
        h = (np.asarray(s, dtype=np.int64).astype(np.uint64)) & np.uint64(0xFFFFFFFF)
        out.append(((a[:, None] * h[None, :] + b[:, None]) % prime).min(axis=1).astype(np.int64) if len(h) else np.full(PERMUTATIONS, -1, np.int64))
    return pd.Series(out)


def signature(parts: Column) -> Column:
    """128 minima over universal hashes of the parts; Arrow batches, vectorised per document."""
    udf = F.pandas_udf(_signature, T.ArrayType(T.LongType()))
    return udf(F.transform(parts, lambda x: F.xxhash64(x)))


def similar_sets(docs: DataFrame, parts: Column, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Membership (ord, rep) of documents with equal sets, and all pairs (a, b, jaccard) of representatives, a < b, that reach the threshold.

    One pass keeps the sets packed, as hashes; the pairs come from the exact join of ``sets``."""
    signs = signed(docs.select("ord", F.lit(None).cast("string").alias("key"), F.transform(parts, lambda x: F.xxhash64(x)).alias("v")))
    member = set_members(signs.filter("n > 0"))
    return member.select("ord", "rep"), set_links(signs, member.filter("ord = rep").select("ord", "n"), None, None, threshold)


def set_members(signs: DataFrame) -> DataFrame:
    """(ord, rep, n) of signs (ord, digest, n): the first of the same set."""
    first = signs.groupBy("digest").agg(F.min("ord").alias("rep"))
    return cut_lineage(signs.select("ord", "digest", "n").join(first, "digest").select("ord", "rep", "n"))


def all_pairs(member: DataFrame, links: DataFrame) -> DataFrame:
    """(a, b, jaccard) of all documents, a < b: links of representatives carried over to their copies, and pairs of copies at 1."""
    x, y = member.select("rep", F.col("ord").alias("x")), member.select("rep", F.col("ord").alias("y"))
    same = x.join(y, "rep").filter("x < y").select("x", "y", F.lit(1.0).alias("jaccard"))
    across = links.join(x.withColumnRenamed("rep", "a"), "a").join(y.withColumnRenamed("rep", "b"), "b").select("x", "y", "jaccard")
    return across.unionByName(same).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "jaccard")


def lsh_pairs(docs: DataFrame, parts: Column, threshold: float = 0.8, verify: bool = True) -> DataFrame:
    """(a, b, jaccard) of documents (ord) with a < b that share a band and, unless ``verify`` is off, reach the threshold exactly.

    Copies of one set are one representative; a band bucket joins its members to each other only through the equi-join
    on (band, hash), which the engine splits when skewed; sets travel only for candidate pairs."""
    b, r = BANDS.get(threshold, BANDS[0.8])
    base = docs.select("ord", parts.alias("parts")).filter(F.size("parts") > 0)
    reps = base.groupBy(F.xxhash64("parts").alias("k")).agg(F.min("ord").alias("ord"))
    sets = base.join(reps.select("ord"), "ord", "left_semi")
    sig = sets.select("ord", signature(F.col("parts")).alias("sig"))
    bands = sig.select("ord", F.posexplode(F.array(*[F.xxhash64(F.slice("sig", i * r + 1, r)) for i in range(b)])).alias("band", "h"))
    x, y = bands.select(F.col("ord").alias("a"), "band", "h"), bands.select(F.col("ord").alias("b"), "band", "h")
    pairs = x.join(y, ["band", "h"]).filter("a < b").select("a", "b").distinct()
    if not verify:
        return pairs.select("a", "b", F.lit(None).cast("double").alias("jaccard"))
    p = pairs.join(sets.select(F.col("ord").alias("a"), F.col("parts").alias("pa")), "a").join(sets.select(F.col("ord").alias("b"), F.col("parts").alias("pb")), "b")
    i = F.size(F.array_intersect("pa", "pb"))
    return p.select("a", "b", (i / (F.size("pa") + F.size("pb") - i)).alias("jaccard")).filter(F.col("jaccard") >= threshold)


def match_class(similarity: Column, la: Column, lb: Column) -> Column:
    """Kind of a fuzzy match by similarity and lengths."""
    return F.when(similarity >= 0.95, "near_exact").when(similarity >= 0.9, "very_similar").when(la > lb * 1.5, "contains").when(lb > la * 1.5, "contained_in").otherwise("similar")


def knn(vectors: DataFrame, queries: DataFrame, k: int, threshold: float, block: int = 512) -> DataFrame:
    """(q, id, sim): for each query vector its k nearest others by inner product that reach the threshold; ties by smaller id.

    Queries are a stated set, laid against all rows in blocks: each block of queries meets each partition of the vectors once
    as a matrix product, keeping k per block and partition; a final window over those few rows takes the best k."""
    n = max(1, -(-queries.count() // block))
    qs = queries.select("id", "embedding", F.pmod(F.xxhash64("id"), F.lit(n)).alias("block")).groupBy("block").agg(F.collect_list("id").alias("qid"), F.collect_list("embedding").alias("qv"))
    vs = vectors.select("id", "embedding", F.pmod(F.xxhash64("id"), F.lit(max(1, vectors.sparkSession.sparkContext.defaultParallelism))).alias("part")).groupBy("part", F.floor(F.col("id") / 4096).alias("chunk")).agg(F.collect_list("id").alias("vid"), F.collect_list("embedding").alias("vv"))
    blocks = vs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))).join(qs, "block")

    def run(it):
        for pdf in it:
            rows = []
            for vid, vv, qid, qv in zip(pdf.vid, pdf.vv, pdf.qid, pdf.qv, strict=True):
                s = np.stack([np.asarray(x, np.float64) for x in qv]) @ np.stack([np.asarray(x, np.float64) for x in vv]).T
                ids = np.asarray(vid)
                for q, sim in zip(qid, s, strict=True):
                    ok = np.flatnonzero((sim >= threshold) & (ids != q))
                    ok = ok[np.lexsort((ids[ok], -sim[ok]))][:k]
                    rows += [(int(q), int(ids[j]), float(sim[j])) for j in ok]
            yield pd.DataFrame(rows, columns=["q", "id", "sim"])

    near = blocks.select("vid", "vv", "qid", "qv").mapInPandas(run, "q long, id long, sim double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("sim"), "id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k)


def _docs(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("ord"), F.coalesce("text", F.lit("")).alias("text"), "source", "domain_type")


def dedup_exact(spark, d):
    t = mark_exact(_docs(spark, d), content_hash(F.col("text")), "ord")
    return t.select(F.col("ord").alias("doc_id"), content_hash(F.col("text")).alias("hash"), "is_duplicate")


def dedup_canonical_text(spark, d):
    t = mark_exact(_docs(spark, d), content_hash(canonical_html(F.col("text"))), "ord")
    return t.select(F.col("ord").alias("doc_id"), "is_duplicate")


def dedup_history(spark, d):
    """Items whose hash the history holds (a batch lookup: equal items of one batch are both new)."""
    h = table(spark, d, "hash_dedup").select(F.lower("hash").alias("h")).distinct()
    i = table(spark, d, "batch_items").select("item_id", F.sha2(F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"\s+", " ")), 256).alias("h"))
    return i.join(h.withColumn("known", F.lit(True)), "h", "left").select("item_id", F.coalesce("known", F.lit(False)).alias("is_duplicate"))


def dedup_summary(spark, d):
    t = dedup_exact(spark, d)
    n = t.agg(F.count(F.lit(1)).alias("checked"), F.count_if("is_duplicate").alias("exact"))
    return n.select("checked", "exact", F.round(F.col("exact") / F.greatest(F.col("checked"), F.lit(1)), 6).alias("rate"))


def dedup_minhash(spark, d):
    """All pairs of documents, copies too, whose word tokens reach 0.8."""
    return all_pairs(*similar_sets(_docs(spark, d), tokens(F.col("text")), 0.8)).select(F.col("a").alias("doc_a"), F.col("b").alias("doc_b"), F.round("jaccard", 6).alias("jaccard"))


def hybrid_verdicts(docs: DataFrame) -> DataFrame:
    """(ord, verdict) of docs (ord, text): exact copies first, then near ones of an earlier document by character shingles at 0.85."""
    signs = signed(docs.select("ord", content_hash(canonical_html(F.col("text"))).alias("key"), F.col("text").alias("v")), _shingle_sets)
    t = cut_lineage(mark_exact(signs.filter("block IS NULL").select("ord", "key", "digest", "n"), F.col("key"), "ord").drop("key"))
    member = set_members(t.filter("NOT is_duplicate AND n > 0"))
    links = set_links(signs, member.filter("ord = rep").select("ord", "n"), docs.select("ord", F.col("text").alias("v")), _shingle_sets, 0.85)
    # a representative is the first of its set: all others of the set are near it
    near = member.filter("ord != rep").select("ord").unionByName(links.select(F.col("b").alias("ord"))).distinct().withColumn("near", F.lit(True))
    kind = F.when(F.col("is_duplicate"), "exact").when(F.col("near"), "near").otherwise("unique")
    return t.join(near, "ord", "left").select("ord", kind.alias("verdict"))


def dedup_hybrid(spark, d):
    """Exact copies first, then character shingles at 0.85 among the rest: the verdict and its kind for each document."""
    return hybrid_verdicts(_docs(spark, d)).withColumnRenamed("ord", "doc_id")


def knn_semantic(spark, d):
    """Nearest vectors of each vector whose id is divisible by 50, against all."""
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return knn(v, v.filter("id % 50 = 0"), 10, -1.0).select(F.col("q").alias("vec_id"), F.col("id").alias("near_id"), F.col("rank").cast("long").alias("rank"), F.round("sim", 4).alias("sim"))


def fuzzy_pairs(strings: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(a, b, ta, tb, sim) of distinct strings (id, t), a < b, whose Levenshtein similarity reaches ``threshold``.

    Blocks of strings are laid against each other in one task each (``edits``); what the bounds let through is verified there."""
    near = near_strings(strings, threshold)
    # beyond the edits that a pair may have the distance is -1
    near = near.withColumn("edits", F.expr("levenshtein(tx, ty, most)")).filter("edits >= 0")
    near = near.withColumn("sim", 1 - F.col("edits") / F.greatest(F.length("tx"), F.length("ty"))).filter(F.col("sim") >= threshold)
    first = F.col("x") < F.col("y")
    return near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.when(first, F.col("tx")).otherwise(F.col("ty")).alias("ta"), F.when(first, F.col("ty")).otherwise(F.col("tx")).alias("tb"), "sim")


def fuzzy_titles(spark, d):
    """Titles that resemble the title of an earlier record: Levenshtein similarity of 0.85 or more."""
    t = table(spark, d, "extracted_content").select("extract_id", F.lower(F.trim(F.coalesce("title", F.lit("")))).alias("t")).filter("t != ''")
    j = fuzzy_pairs(cut_lineage(t.groupBy("t").agg(F.min("extract_id").alias("id"))))
    return j.select(F.col("a").alias("title_a"), F.col("b").alias("title_b"), F.round("sim", 6).alias("sim"), match_class(F.col("sim"), F.length("ta"), F.length("tb")).alias("match"))


QUERIES = {f.__name__: f for f in (dedup_exact, dedup_canonical_text, dedup_history, dedup_summary, dedup_minhash, dedup_hybrid, knn_semantic, fuzzy_titles)}

_CH = r"trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '<script[^>]*>.*?</script>', '', 'gis'), '<style[^>]*>.*?</style>', '', 'gis'), '<!--.*?-->', '', 'gs'), '<[^>]+>', ' ', 'gs'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '" + '"' + r"'), '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g'))"
ORACLE = {
    "dedup_minhash": r"""with t as (select doc_id, list_distinct(list_filter(string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}_]+', ' ', 'g'), ' '), ' '), lambda x: x <> '')) as w from documents), e as (select doc_id, len(w) as n, unnest(w) as tok from t),
 p as (select a.doc_id as doc_a, b.doc_id as doc_b, a.n as na, b.n as nb, count(*) as i from e a join e b on a.tok = b.tok and a.doc_id < b.doc_id and least(a.n, b.n) >= 0.79 * greatest(a.n, b.n) group by all) select doc_a, doc_b, round(i / (na + nb - i), 6) as jaccard from p where i / (na + nb - i) >= 0.8""",
    "dedup_exact": "select doc_id, sha256(coalesce(text, '')) as hash, row_number() over (partition by sha256(coalesce(text, '')) order by doc_id) > 1 as is_duplicate from documents",
    "dedup_canonical_text": f"select doc_id, row_number() over (partition by {_CH} order by doc_id) > 1 as is_duplicate from documents",
    "dedup_history": r"select item_id, sha256(trim(regexp_replace(lower(coalesce(text, '')), '\s+', ' ', 'g'))) in (select lower(hash) from hash_dedup) as is_duplicate from batch_items",
    "dedup_summary": "select count(*) as checked, count(*) filter (d) as exact, round(count(*) filter (d) / greatest(count(*), 1), 6) as rate from (select row_number() over (partition by text order by doc_id) > 1 as d from documents)",
    "knn_semantic": "with p as (select a.vec_id, b.vec_id as near_id, list_dot_product(a.embedding::double[], b.embedding::double[]) as sim from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0) select vec_id, near_id, rank, round(sim, 4) as sim from (select *, row_number() over (partition by vec_id order by sim desc, near_id) as rank from p) where rank <= 10",
}
