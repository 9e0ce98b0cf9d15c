"""Problem 2: near-duplicate records with small edits.

Set-relation skipping, distributed. Exact copies are one set. Prefixes of the whole window sets, rare windows first, meet
in an index that loses no similar pair (``windows.candidates``). Candidate pairs are gathered around leaders
(the smallest record that one is linked to): a leader's set is intersected once with each member, and every further
answer in the group is derived from the members' small differences to the leader, not from the sets themselves.

Scale: only packed prefixes are shuffled to find candidates; texts travel once to each group they have candidates in.
Groups beyond GROUP records are split into blocks of record pairs, so no group is one task's work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans import checked_broadcast
from millrace.session import cut_lineage
from millrace.sources import table

from .windows import DEN, NUM, build_index, candidates, canonical, index_parts, sign, similarity, window_order, window_set

MIN_CHARS = 300
GROUP = 64


def _apart(lead: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of two sorted sets what the second has more, and what it lacks."""
    if not len(lead) or not len(own):
        return own, lead
    at = np.minimum(np.searchsorted(lead, own), len(lead) - 1)
    both = lead[at] == own
    lacks = np.ones(len(lead), bool)
    lacks[at[both]] = False
    return own[~both], lead[lacks]


def _verify(num: int, den: int):
    """mapInArrow over rows (g, i, j, id, text, partners) sorted by group: similar pairs with intersection and union."""

    def answers(rows):
        sets = {r[3]: window_set(canonical(r[4])) for r in rows}
        asked = [(r[3], p) for r in rows for p in r[5] or () if p in sets]
        if not asked:
            return []
        out = []
        if len(asked) == 1:
            a, b = asked[0]
            i, u = similarity(sets[a], sets[b])
            return [(a, b, i, u)] if i * den >= u * num else []
        lead = sets[min(sets)]
        # differences to the leader: what a member has more, and what of the leader it lacks
        apart = {x: _apart(lead, sets[x]) for x in {x for ab in asked for x in ab}}
        for a, b in asked:
            (more_a, less_a), (more_b, less_b) = apart[a], apart[b]
            if len(more_a) + len(less_a) + len(more_b) + len(less_b) < len(sets[a]) + len(sets[b]):
                gone = len(less_a) + len(less_b) - similarity(less_a, less_b)[0]
                i = len(lead) - gone + similarity(more_a, more_b)[0]
                u = len(sets[a]) + len(sets[b]) - i
            else:
                i, u = similarity(sets[a], sets[b])
            if i * den >= u * num:
                out.append((a, b, i, u))
        return out

    def run(batches):
        key, rows = None, []

        def flush():
            got = answers(rows) if rows else []
            cols = list(zip(*got, strict=True)) if got else [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", "inter", "uni"])

        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[:3] != key:
                    if len(rows) > 1:
                        yield flush()
                    key, rows = r[:3], []
                rows.append(r)
        if len(rows) > 1:
            yield flush()

    return run


def verified(pairs: DataFrame, texts: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """Of candidate pairs (a, b) those whose window sets have similarity num/den or more: (a, b, inter, uni). texts: (id, text)."""
    pairs = cut_lineage(pairs)
    both = pairs.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(pairs.select(F.col("b").alias("x"), F.col("a").alias("y")))
    lead = both.groupBy("x").agg(F.least(F.min("x"), F.min("y")).alias("lead"))
    led = pairs.join(lead.select(F.col("x").alias("a"), F.col("lead").alias("la")), "a").join(lead.select(F.col("x").alias("b"), F.col("lead").alias("lb")), "b").select("a", "b", F.least("la", "lb").alias("g"))
    sizes = led.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    led = led.join(sizes, "g").withColumn("parts", F.ceil(F.sqrt(F.col("n") * 2.0) / GROUP).cast("int"))
    led = led.select("g", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("i"), F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("j"), "a", "b")
    role = F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("p")), F.struct(F.col("b").alias("id"), F.lit(None).cast("long").alias("p")))
    member = cut_lineage(led.select("g", "i", "j", F.explode(role).alias("r")).groupBy("g", "i", "j", "r.id").agg(F.collect_list("r.p").alias("partners")))
    rows = texts.join(checked_broadcast(member), "id").select("g", "i", "j", "id", "text", "partners")
    return rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "id").mapInArrow(_verify(num, den), "a long, b long, inter long, uni long")


def similar_candidates(texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts (id, seq, text) among which is every similar one; b is of seq 0 or more."""
    parts = index_parts(texts)
    order = texts.sparkSession.sparkContext.broadcast(window_order(texts))
    return candidates(build_index(texts, order, parts), parts)


def near_classes(docs: DataFrame, least: int = MIN_CHARS) -> tuple[DataFrame, DataFrame]:
    """Membership (id, rep) of exact copies of a canonical text, and similar pairs of representatives (a, b, inter, uni), a < b.

    docs: id (unique), text. Null and short texts belong to no class. No link between different texts is left out."""
    signed = cut_lineage(sign(docs.select("id", F.lit(0).cast("long").alias("seq"), "text"), least))
    member = signed.select("id", "digest")
    reps = cut_lineage(signed.groupBy("digest").agg(F.min("id").alias("id")))
    listed = docs.select("id", F.lit(0).cast("long").alias("seq"), "text").join(checked_broadcast(reps.select("id")), "id", "left_semi")
    pairs = similar_candidates(listed)
    return member.join(reps.select("digest", F.col("id").alias("rep")), "digest").select("id", "rep"), verified(pairs, docs.select("id", "text"))


def _docs(spark, d: str) -> DataFrame:
    return table(spark, d, "extracted_content").select(F.col("extract_id").alias("id"), "text")


def p2_found(spark, d: str) -> DataFrame:
    """All pairs, as TESTDATA.md asks: links of representatives carried over to their copies, and pairs of copies."""
    member, links = near_classes(_docs(spark, d))
    member, links = cut_lineage(member), cut_lineage(links.select("a", "b"))
    more = member.groupBy("rep").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("rep")
    copies = member.join(more, "rep")
    same = copies.select(F.col("id").alias("x"), "rep").join(copies.select(F.col("id").alias("y"), "rep"), "rep").filter("x < y").select("x", "y")
    across = links.join(member.select(F.col("rep").alias("a"), F.col("id").alias("x")), "a").join(member.select(F.col("rep").alias("b"), F.col("id").alias("y")), "b").select("x", "y")
    return across.unionByName(same).select(F.least("x", "y").alias("extract_id_a"), F.greatest("x", "y").alias("extract_id_b"))


def p2_classes(spark, d: str) -> DataFrame:
    """One row for each record of enough length: its class of exact copies and the number of other texts linked to it."""
    member, links = near_classes(_docs(spark, d))
    links = cut_lineage(links)
    n = links.select(F.col("a").alias("rep")).unionByName(links.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    return member.join(n, "rep", "left").select(F.col("id").alias("extract_id"), F.col("rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


QUERIES = {"p2_found": p2_found, "p2_classes": p2_classes}
ORACLE: dict[str, str] = {}
