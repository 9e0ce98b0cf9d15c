"""Problem 3: lines repeated across the documents of one site.

Lines are parsed into templates by fixed-depth token trees. The levels of a site's tree are the number of tokens and the
first DEPTH tokens; a token that holds digits is a wildcard at once, and a token whose node covers too few lines of its site
becomes its parent's wildcard slot. Behind the last level a slot is constant if all lines of the leaf agree in it, else a
wildcard. Nodes are counts: each partition counts its own tree and the shuffle adds the counts of equal nodes, which merges
the trees of all partitions. A template that covers many documents is repeated; ``p3_found`` adds the exact test of
TESTDATA.md on each line of such a template.

No repeated line is lost: the nodes on its path hold at least the lines it stands in, so none of them becomes a wildcard.

Scale: each level is one count by (site, node) with map-side combine, linear in the lines whatever the number of lines of a
site or leaf; only hashes are shuffled. The nodes that stay are bounded by MIN_SHARE times a document's lines for each site.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.canon import site_of
from millrace.plans import checked_broadcast
from millrace.session import cut_lineage
from millrace.sources import table

MIN_DOCS = 4
MIN_SHARE = 5  # one fifth
DEPTH = 3
WILD = "<*>"


def line_keys(text: Column) -> Column:
    """Canonical lines of a text with each run of ASCII digits made one 0: the text is rewritten whole, then split."""
    flat = F.regexp_replace(F.lower(text), r"(?U)[\s&&[^\n ]][\s&&[^\n]]*| [\s&&[^\n]]+", " ")
    return F.transform(F.split(F.regexp_replace(flat, "[0-9]+", "0"), "\n"), lambda x: F.trim(x))


def _masked(token: Column) -> Column:
    """Hash of a token; those with digits share that of the wildcard, a missing one has its own."""
    return F.hash(F.when(token.contains("0"), F.lit(WILD)).otherwise(F.coalesce(token, F.lit(""))))


def _tokens(docs: DataFrame) -> DataFrame:
    """(id, site, keys, toks): the lines of each document and their tokens. Null text is as an empty one."""
    keys = docs.filter(F.col("site") != "").select("id", "site", line_keys(F.coalesce("text", F.lit(""))).alias("keys"))
    return keys.select("id", "site", "keys", F.transform("keys", lambda k: F.split(k, " ")).alias("toks"))


def _signed(docs: DataFrame) -> DataFrame:
    """(id, site, hs, ns, t1..): per line the hash of its key (0 for blank lines), its number of tokens, hashes of its first tokens."""
    hs = F.transform("keys", lambda k: F.when(k == "", F.lit(0).cast("long")).otherwise(F.xxhash64(k))).alias("hs")
    at = lambda i: lambda t: _masked(F.get(t, F.lit(i)))
    first = [F.transform("toks", at(i)).alias(f"t{i + 1}") for i in range(DEPTH)]
    return _tokens(docs).select("id", "site", hs, F.transform("toks", lambda t: F.size(t)).alias("ns"), *first)


def _lines(signed: DataFrame) -> DataFrame:
    """(id, site, line_no, h, node, t1..) of each line that is not blank; node: that of its number of tokens."""
    cols = ("hs", "ns", *(f"t{i + 1}" for i in range(DEPTH)))
    x = signed.select("id", "site", F.posexplode(F.arrays_zip(*cols)).alias("line_no", "z")).filter("z.hs != 0")
    return x.select("id", "site", "line_no", F.col("z.hs").alias("h"), F.xxhash64("z.ns").alias("node"), *(F.col(f"z.t{i + 1}") for i in range(DEPTH)))


def _wide(lines: DataFrame, sizes: DataFrame, *key: str) -> DataFrame:
    """(site, key...) that hold enough lines of their site, as a table."""
    n = lines.groupBy("site", *key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_DOCS)
    return checked_broadcast(cut_lineage(n.join(sizes, "site").filter(F.col("n") * MIN_SHARE >= F.col("site_docs")).select("site", *key)))


def _step(lines: DataFrame, level: int, kept: DataFrame) -> DataFrame:
    """Each line's node one level deeper: the child by its token if that was kept, else the wildcard child."""
    child = lines.withColumn("child", F.xxhash64("node", f"t{level}"))
    marked = child.join(kept.select("site", F.col("child"), F.lit(True).alias("kept")), ["site", "child"], "left")
    return marked.withColumn("node", F.when(F.col("kept"), F.col("child")).otherwise(F.xxhash64("node", F.lit(WILD)))).drop("child", "kept")


def site_trees(docs: DataFrame) -> tuple[DataFrame, DataFrame, list[DataFrame], DataFrame]:
    """For docs (id, site, text): the lines (id, site, line_no, h, node) of leaves that hold enough lines, node being the leaf; the
    sites' sizes; the kept nodes of each level; the kept leaves. A document without a host belongs to no site."""
    signed = cut_lineage(_signed(docs))
    sizes = cut_lineage(signed.groupBy("site").agg(F.count(F.lit(1)).alias("site_docs")))
    lines, kept = _lines(signed), []
    for level in range(1, DEPTH + 1):
        nodes = _wide(lines.withColumn("child", F.xxhash64("node", f"t{level}")), sizes, "child")
        kept.append(nodes)
        lines = _step(lines, level, nodes)
    leaves = _wide(lines, sizes, "node")
    return lines.join(leaves, ["site", "node"], "left_semi").select("id", "site", "line_no", "h", "node"), sizes, kept, leaves


def _docs(spark, d: str) -> DataFrame:
    return table(spark, d, "extracted_content").select(F.col("extract_id").alias("id"), site_of(F.col("url")).alias("site"), "text")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(id, line_no) of each line that is exactly repeated within its site (TESTDATA.md), found through templates.

    Repeated rows of docs count as documents of their own only by id; null and empty texts hold no line."""
    lines, sizes, _, _ = site_trees(docs)
    often = _wide(lines, sizes, "node", "h")
    # a line given twice in one document counts once
    held = lines.join(often, ["site", "node", "h"], "left_semi")
    n = held.select("id", "site", "h").distinct().groupBy("site", "h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_DOCS)
    hot = checked_broadcast(cut_lineage(n.join(sizes, "site").filter(F.col("n") * MIN_SHARE >= F.col("site_docs")).select("site", "h")))
    return held.join(hot, ["site", "h"], "left_semi").select("id", F.col("line_no").cast("long").alias("line_no"))


def site_templates(docs: DataFrame) -> DataFrame:
    """(site, template, n_lines, n_docs, site_docs) of the templates that cover enough documents of their site."""
    lines, sizes, _, _ = site_trees(docs)
    cover = lines.groupBy("site", "node").agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("id").alias("n_docs"))
    cover = cut_lineage(cover.join(sizes, "site").filter((F.col("n_docs") >= MIN_DOCS) & (F.col("n_docs") * MIN_SHARE >= F.col("site_docs"))))
    # distinct lines of these leaves, then each slot: constant if its least and greatest token agree
    held = cut_lineage(lines.join(checked_broadcast(cover.select("site", "node")), ["site", "node"], "left_semi").select("site", "node", "h").distinct())
    text = _tokens(docs).select("site", F.explode(F.arrays_zip("keys", "toks")).alias("z")).select("site", F.xxhash64("z.keys").alias("h"), F.col("z.toks").alias("toks"))
    slots = text.join(checked_broadcast(held), ["site", "h"]).select("site", "node", F.posexplode("toks").alias("pos", "tok"))
    slots = slots.groupBy("site", "node", "pos").agg(F.min("tok").alias("lo"), F.max("tok").alias("hi"))
    slot = F.when((F.col("lo") == F.col("hi")) & ~F.col("lo").contains("0"), F.col("lo")).otherwise(F.lit(WILD))
    made = slots.groupBy("site", "node").agg(F.sort_array(F.collect_list(F.struct("pos", slot.alias("s")))).alias("l"))
    return made.join(cover, ["site", "node"]).select("site", F.array_join(F.transform("l", lambda x: x["s"]), " ").alias("template"), "n_lines", "n_docs", "site_docs")


def p3_found(spark, d: str) -> DataFrame:
    return repeated_lines(_docs(spark, d)).withColumnRenamed("id", "extract_id")


def p3_templates(spark, d: str) -> DataFrame:
    """Line templates that cover many documents of a site."""
    return site_templates(_docs(spark, d))


def p3_cleaned(spark, d: str) -> DataFrame:
    """Each record's text without the lines repeated in its site. A join by record; no line text is shuffled twice."""
    docs = _docs(spark, d)
    gone = repeated_lines(docs).groupBy("id").agg(F.collect_set(F.col("line_no").cast("int")).alias("gone"))
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.coalesce(F.array_contains("gone", i), F.lit(False)))
    return docs.join(gone, "id", "left").select(F.col("id").alias("extract_id"), F.array_join(kept, "\n").alias("text"))


QUERIES = {"p3_found": p3_found, "p3_templates": p3_templates, "p3_cleaned": p3_cleaned}

_BASE = r"""
with r as (select extract_id, regexp_replace(lower(regexp_extract(trim(coalesce(url, '')), '^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^(www|m)\.', '') as site, string_split(text, chr(10)) as ls from extracted_content),
l as (select extract_id, site, unnest(range(len(ls))) as line_no, unnest(ls) as line from r where site <> ''),
k as (select extract_id, site, line_no, regexp_replace(trim(regexp_replace(lower(line), '[\s\x{A0}\x{85}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')), '[0-9]+', '0', 'g') as key from l),
n as (select site, count(*) as site_docs from r group by site),
c as (select site, key, count(distinct extract_id) as docs from k where key <> '' group by site, key),
hot as (select c.site, c.key from c join n on c.site = n.site where docs >= 4 and docs * 5 >= site_docs)
"""

ORACLE = {
    "p3_found": _BASE + "select k.extract_id, cast(k.line_no as bigint) as line_no from k join hot on k.site = hot.site and k.key = hot.key",
    "p3_cleaned": _BASE + r""", g as (select k.extract_id, k.line_no from k join hot on k.site = hot.site and k.key = hot.key)
select extract_id, coalesce(string_agg(line, chr(10) order by line_no) filter (where not gone), '') as text from
 (select l.extract_id, l.line_no, l.line, g.line_no is not null as gone from l left join g on l.extract_id = g.extract_id and l.line_no = g.line_no) group by extract_id""",
}
