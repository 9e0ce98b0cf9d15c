"""Fuzzy similarity, duplicate clusters and the verdict of several levels, as joins.

Candidates always come from an exact filter (prefixes of rare parts), so no similar pair depends on buckets or on the order in
which rows arrive; what the filter lets through is verified. Python appears only where no expression gives the measure.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.dedup import SEMANTIC, canonical_html, content_hash, fuzzy_pairs, mark_exact, match_class, signature, similar_sets, tokens
from millrace.session import cut_lineage
from millrace.sources import table

# Fuzzy thresholds of content types, sizes of chunks, the order of levels among equals.
FUZZY = {"medical": 0.9, "legal": 0.95, "technical": 0.8, "ecommerce": 0.75, "general": 0.8}
CHUNK, OVERLAP = 1000, 100
LEVELS = ("exact", "near", "semantic", "fuzzy")


def prepared(text: Column) -> Column:
    """Lower case, white space collapsed, marks but . , ! ? as spaces."""
    return F.lower(F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")), r"[^\p{L}\p{M}\p{N}_\s.,!?]", " "))


def fuzzy_chunks(text: Column) -> Column:
    """Windows of CHUNK characters that overlap by OVERLAP; one if all fits."""
    n = F.length(text)
    return F.when(n <= CHUNK, F.array(text)).otherwise(F.transform(F.sequence(F.lit(0), n - 1, F.lit(CHUNK - OVERLAP)), lambda i: F.substr(text, i + 1, F.lit(CHUNK))))


def token_modes(text: Column, mode: str = "word") -> Column:
    """Parts of lower-case text with marks as spaces: words, characters or runs of three words."""
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_\s]", " "), r"\s+", " "))
    words = F.filter(F.split(clean, " "), lambda w: w != "")
    if mode == "word":
        return words
    if mode == "char":
        return F.filter(F.split(clean, ""), lambda c: c != "")
    n = F.size(words)
    return F.when(n < 3, F.when(n > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>"))).otherwise(F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.array_join(F.slice(words, i, F.lit(3)), " ")))


def signature_similarity(a: Column, b: Column) -> Column:
    """Share of equal positions of two signatures."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / F.size(a)


def band_choice(threshold: float, permutations: int = 128) -> tuple[int, int]:
    """Bands and rows whose false positives and negatives around a threshold are least, each weighing a half."""
    s = (np.arange(1000) + 0.5) / 1000

    def cost(b, r):
        p = 1 - (1 - s**r) ** b
        return 0.5 * p[s < threshold].sum() + 0.5 * (1 - p[s >= threshold]).sum()

    return min(((b, r) for b in range(1, permutations + 1) for r in range(1, permutations // b + 1)), key=lambda x: cost(*x))


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits of a machine-independent integer."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    mask, row = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        u = row & at.get(c, 0)
        row = ((row + u) | (row - u)) & mask
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the common subsequence over both lengths; two empty strings are equal."""
    return 2 * _lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter string to a window of the longer one as long as it, the ends cut short."""
    a, b = sorted((a, b), key=len)
    if not a:
        return float(not b)
    return max(ratio(a, b[max(0, i) : i + len(a)]) for i in range(1 - len(a), len(b)))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio among the common tokens and the common ones with either rest."""
    x, y = set(a.split()), set(b.split())
    both, first, second = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not first or not second):
        return 1.0
    one, two = (f"{both} {s}".strip() for s in (first, second))
    return max(ratio(both, one) if both else 0.0, ratio(both, two) if both else 0.0, ratio(one, two))


RATIOS = {"ratio": ratio, "partial_ratio": partial_ratio, "token_sort_ratio": token_sort_ratio, "token_set_ratio": token_set_ratio}


def string_similarity(a: Column, b: Column, algorithm: str = "ratio") -> Column:
    """Similarity of two columns by an algorithm of RATIOS (Arrow batches) or by Levenshtein distance (native)."""
    if algorithm == "edit_distance":
        most = F.greatest(F.length(a), F.length(b))
        return F.when(most == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / most)
    if algorithm not in RATIOS:
        raise ValueError(f"unknown algorithm: {algorithm}; known: edit_distance, {', '.join(RATIOS)}")
    f = RATIOS[algorithm]

    @F.pandas_udf(T.DoubleType())
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([f(i or "", j or "") for i, j in zip(x, y, strict=True)], dtype="float64")

    return run(a, b)


def by_type(kind: Column, thresholds: dict) -> Column:
    """The threshold of a content type, that of 'general' for others."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in thresholds.items() for x in kv]), kind), F.lit(thresholds["general"]))


def fuzzy_links(docs: DataFrame, thresholds: dict | None = None) -> DataFrame:
    """(a, b, sim, match) of docs (ord, text, kind), a < b, whose prepared texts reach the Levenshtein similarity of the less strict of
    the two types.

    Equal texts are one text: pairs are of representatives (the first of each), copies keep their link at 1.0 in ``fuzzy_member``."""
    th = thresholds or FUZZY
    rep = fuzzy_member(docs).filter("ord = rep").select("ord", "t", "kind")
    k = rep.select("ord", by_type(F.col("kind"), th).alias("least"))
    least = k.agg(F.min("least")).first()[0]  # of the types that are met
    pairs = fuzzy_pairs(rep.select(F.col("ord").alias("id"), "t"), min(th.values()) if least is None else least)
    j = pairs.join(k.select(F.col("ord").alias("a"), F.col("least").alias("la")), "a").join(k.select(F.col("ord").alias("b"), F.col("least").alias("lb")), "b")
    return j.filter(F.col("sim") >= F.least("la", "lb")).select("a", "b", "sim", match_class(F.col("sim"), F.length("ta"), F.length("tb")).alias("match"))


def fuzzy_member(docs: DataFrame) -> DataFrame:
    """(ord, rep, t, kind): each document's prepared text and the first document with the same one; blank texts are left out."""
    t = docs.select("ord", prepared(F.col("text")).alias("t"), "kind").filter("t != ''")
    first = t.groupBy("t").agg(F.min("ord").alias("rep"))
    return cut_lineage(t.join(first, "t"))


def partial_overlaps(docs: DataFrame, queries: DataFrame, least: int = 100) -> DataFrame:
    """(q, id, start, end) of the blocks of ``least`` characters or more that a document (id, text) shares with a query (q, text), as
    positions in the document's prepared text.

    A block that long holds a whole window of ``least`` // 2 characters that begins at a multiple of it in the query, so only
    documents that hold such a window are compared. Queries are a stated set; a repeated row is compared again."""
    w = least // 2
    q = queries.select("q", prepared(F.col("text")).alias("tq"))
    t = docs.select("id", prepared(F.col("text")).alias("td"))
    keys = q.filter(F.length("tq") >= w).select("q", F.explode(F.transform(F.sequence(F.lit(0), F.length("tq") - w, F.lit(w)), lambda i: F.xxhash64(F.substr("tq", i + 1, F.lit(w))))).alias("h")).distinct()

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def windows(s: pd.Series) -> pd.Series:
        import xxhash

        return pd.Series([list({xxhash.xxh64_intdigest(x[i : i + w].encode(), seed=42) - (1 << 64 if xxhash.xxh64_intdigest(x[i : i + w].encode(), seed=42) >> 63 else 0) for i in range(len(x) - w + 1)}) for x in s])

    held = t.filter(F.length("td") >= w).select("id", F.explode(windows("td")).alias("h")).join(keys, "h").select("q", "id").distinct()

    @F.pandas_udf("array<struct<start: int, end: int>>")
    def blocks(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([[(m.b, m.b + m.size) for m in SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks() if m.size >= least] for x, y in zip(a, b, strict=True)])

    return held.join(q, "q").join(t, "id").select("q", "id", F.explode(blocks("tq", "td")).alias("m")).select("q", "id", "m.start", "m.end")


def ranked_matches(links: DataFrame, k: int = 10) -> DataFrame:
    """Both directions of links (a, b, score): each document's ``k`` best matches, ties by smaller id."""
    links = cut_lineage(links.select("a", "b", "score"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))
    return both.withColumn("rank", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("score"), "b"))).filter(F.col("rank") <= k)


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, cluster): the smallest id that links (a, b) reach, by rounds of least neighbours with pointer jumping, each a reliable
    checkpoint; long chains take as many rounds as the logarithm of their length."""
    edges = cut_lineage(links.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(links.select(F.col("b").alias("x"), F.col("a").alias("y"))).distinct())
    label = cut_lineage(edges.groupBy("x").agg(F.least(F.min("y"), F.min("x")).alias("c")))
    for _ in range(most_rounds):
        near = edges.join(label.select(F.col("x").alias("y"), "c"), "y").groupBy("x").agg(F.min("c").alias("n"))
        hop = label.join(near, "x").select("x", "c", F.least("c", "n").alias("m"))
        new = cut_lineage(hop.join(label.select(F.col("x").alias("m"), F.col("c").alias("up")), "m", "left").select("x", F.least("m", F.coalesce("up", "m")).alias("c"), F.col("c").alias("old")))
        if new.filter("c != old").isEmpty():
            return new.select(F.col("x").alias("id"), F.col("c").alias("cluster"))
        label = new.select("x", "c")
    raise RuntimeError("clusters did not settle")


class BloomFilter:
    """Membership of hashes in a fixed number of bits, merged over partitions by OR; it may say yes wrongly, never no wrongly."""

    def __init__(self, capacity: int, error: float = 0.001, bits: bytes | None = None):
        self.m = max(64, int(-capacity * np.log(error) / np.log(2) ** 2) // 64 * 64)
        self.k = max(1, round(self.m / max(1, capacity) * np.log(2)))
        self.bits = np.frombuffer(bits, np.uint8).copy() if bits else np.zeros(self.m // 8, np.uint8)

    def _at(self, h: np.ndarray) -> np.ndarray:
        h = np.asarray(h, np.int64).view(np.uint64)
        step = (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(17)) | np.uint64(1)
        return ((h[:, None] + step[:, None] * np.arange(self.k, dtype=np.uint64)) % np.uint64(self.m)).astype(np.int64)

    def add(self, h: np.ndarray) -> BloomFilter:
        at = self._at(h).ravel()
        np.bitwise_or.at(self.bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        return self

    def has(self, h: np.ndarray) -> np.ndarray:
        at = self._at(h)
        return ((self.bits[at >> 3] >> (at & 7)) & 1).all(axis=1)


def build_bloom(keys: DataFrame, capacity: int, error: float = 0.001) -> bytes:
    """Bits of a filter over ``keys`` (h long): one filter a partition, brought together by OR in a tree; its size follows from the
    stated capacity, not from the data."""

    def fill(batches):
        f = BloomFilter(capacity, error)
        for b in batches:
            f.add(b.h.to_numpy())
        yield pd.DataFrame({"g": [0], "bits": [f.bits.tobytes()]})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bits": [np.bitwise_or.reduce(np.stack([np.frombuffer(x, np.uint8) for x in pdf.bits])).tobytes()]})

    part = keys.select("h").mapInPandas(fill, "g int, bits binary").withColumn("g", F.spark_partition_id() % 16)
    once = part.groupBy("g").applyInPandas(merge, "bits binary").withColumn("g", F.lit(0))
    return bytes(once.groupBy("g").applyInPandas(merge, "bits binary").first().bits)


def bloom_has(h: Column, bits: bytes, capacity: int, error: float = 0.001) -> Column:
    @F.pandas_udf(T.BooleanType())
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(BloomFilter(capacity, error, bits).has(s.to_numpy()))

    return run(h)


def best_level(levels: DataFrame) -> DataFrame:
    """Of verdicts (ord, level, kind, confidence) the most confident of each document, the earlier level among equals."""
    rank = F.array_position(F.array(*map(F.lit, LEVELS)), F.col("level"))
    return levels.groupBy("ord").agg(F.max_by(F.struct("level", "kind", "confidence"), F.struct("confidence", -rank)).alias("v")).select("ord", "v.*")


def multi_level(docs: DataFrame, vectors: DataFrame | None = None, near: float = 0.8) -> DataFrame:
    """(ord, level, kind, confidence) of every document of docs (ord, text, kind): exact copies of an earlier one settle it; among the
    rest word sets at ``near``, vectors (ord, embedding) where given, and fuzzy texts all speak and the most confident counts;
    level 'none' for documents without an earlier match."""
    t = cut_lineage(mark_exact(docs, content_hash(canonical_html(F.col("text"))), "ord"))
    exact = t.filter("is_duplicate").select("ord", F.lit("exact").alias("level"), F.lit("exact_duplicate").alias("kind"), F.lit(1.0).alias("confidence"))
    rest = cut_lineage(t.filter("NOT is_duplicate").select("ord", "text", "kind"))
    member, links = similar_sets(rest, tokens(F.col("text")), near)
    later = member.filter("ord != rep").select("ord").unionByName(links.select(F.col("b").alias("ord"))).distinct()
    found = exact.unionByName(later.select("ord", F.lit("near").alias("level"), F.lit("near_duplicate").alias("kind"), F.lit(near).alias("confidence")))
    if vectors is not None:
        from millrace.operators.dedup import knn

        v = vectors.join(rest.select("ord", "kind"), "ord").select(F.col("ord").alias("id"), "embedding", "kind")
        near_v = knn(v, v, 10, min(SEMANTIC.values())).join(v.select(F.col("id").alias("q"), by_type(F.col("kind"), SEMANTIC).alias("least")), "q").filter("id < q AND sim >= least")
        found = found.unionByName(near_v.groupBy("q").agg(F.max("sim").alias("s")).select(F.col("q").alias("ord"), F.lit("semantic").alias("level"), F.lit("semantic_similar").alias("kind"), F.col("s").alias("confidence")))
    same = fuzzy_member(rest)
    f = fuzzy_links(rest).select("b", "sim", "match").unionByName(same.filter("ord != rep").select(F.col("ord").alias("b"), F.lit(1.0).alias("sim"), F.lit("near_exact").alias("match")))
    g = f.groupBy("b").agg(F.max("sim").alias("s"), F.collect_set("match").alias("m"))
    kind = F.when(F.array_contains("m", "near_exact"), "near_duplicate").when(F.array_contains("m", "contains") | F.array_contains("m", "contained_in"), "partial_overlap").otherwise("fuzzy_match")
    found = found.unionByName(g.select(F.col("b").alias("ord"), F.lit("fuzzy").alias("level"), kind.alias("kind"), F.col("s").alias("confidence")))
    return docs.select("ord").join(best_level(found), "ord", "left").select("ord", F.coalesce("level", F.lit("none")).alias("level"), F.coalesce("kind", F.lit("unique")).alias("kind"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))


def legacy_verdict(verdicts: DataFrame) -> DataFrame:
    """A verdict in the older form: is_duplicate, the fixed type 'exact', confidence 1 or 0."""
    dup = F.col("level") != "none"
    return verdicts.select("ord", dup.alias("is_duplicate"), F.lit("exact").alias("duplicate_type"), dup.cast("double").alias("confidence"))


def _titles(spark, d):
    t = table(spark, d, "extracted_content")
    return t.select(F.col("extract_id").alias("ord"), F.col("title").alias("text"), F.lit("general").alias("kind"))


def title_links(spark, d):
    """Titles that resemble each other, by the fuzzy level."""
    return fuzzy_links(_titles(spark, d)).select("a", "b", F.round("sim", 6).alias("sim"), "match")


def title_matches(spark, d):
    """The three best matches of each title."""
    return ranked_matches(fuzzy_links(_titles(spark, d)).withColumnRenamed("sim", "score"), 3).select("a", "b", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


def document_levels(spark, d):
    """The verdict of all levels for each title."""
    return multi_level(_titles(spark, d)).select(F.col("ord").alias("extract_id"), "level", "kind", F.round("confidence", 6).alias("confidence"))


def level_summary(spark, d):
    """Documents by level, and in all, with their share."""
    v = document_levels(spark, d)
    return v.rollup("level").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("level") != "none").alias("duplicates"))


def duplicate_clusters(spark, d):
    """Clusters of documents whose word sets reach 0.8, copies among them: each document's cluster."""
    t = table(spark, d, "documents").select(F.col("doc_id").alias("ord"), F.coalesce("text", F.lit("")).alias("text"))
    member, links = similar_sets(t, tokens(F.col("text")), 0.8)
    links = cut_lineage(links.select("a", "b").unionByName(member.filter("ord != rep").select(F.col("rep").alias("a"), F.col("ord").alias("b"))))
    return components(links).select(F.col("id").alias("doc_id"), "cluster")


def known_items(spark, d):
    """Items whose hash the history may hold by a bloom filter, and whether it does (an exact join of those alone)."""
    h = table(spark, d, "hash_dedup").select(F.lower("hash").alias("key"))
    i = table(spark, d, "batch_items").select("item_id", F.sha2(F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"\s+", " ")), 256).alias("key"))
    capacity = 1_000_000
    bits = build_bloom(h.select(F.xxhash64("key").alias("h")), capacity)
    maybe = i.filter(bloom_has(F.xxhash64("key"), bits, capacity))
    known = maybe.join(h.distinct(), "key", "left_semi").select("item_id", F.lit(True).alias("known"))
    return i.select("item_id").join(known, "item_id", "left").select("item_id", F.coalesce("known", F.lit(False)).alias("is_duplicate"))


def semantic_duplicates(spark, d):
    """Vectors that reach the general threshold of an earlier one: queries are the ids divisible by 50, against all."""
    from millrace.operators.dedup import knn

    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    near = knn(v, v.filter("id % 50 = 0"), 10, SEMANTIC["general"])
    return near.groupBy(F.col("q").alias("vec_id")).agg(F.count(F.lit(1)).alias("n"), F.round(F.max("sim"), 4).alias("best"))


QUERIES = {f.__name__: f for f in (title_links, title_matches, document_levels, level_summary, duplicate_clusters, known_items, semantic_duplicates)}

ORACLE = {
    "known_items": r"select item_id, sha256(trim(regexp_replace(lower(coalesce(text, '')), '\s+', ' ', 'g'))) in (select lower(hash) from hash_dedup) as is_duplicate from batch_items",
    "semantic_duplicates": f"with p as (select a.vec_id, list_dot_product(a.embedding::double[], b.embedding::double[]) as sim, row_number() over (partition by a.vec_id order by list_dot_product(a.embedding::double[], b.embedding::double[]) desc) as r from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0) select vec_id, count(*) as n, round(max(sim), 4) as best from p where r <= 10 and sim >= {SEMANTIC['general']}::double group by vec_id",
}
