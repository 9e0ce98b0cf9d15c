"""Problem 1: the main body of a page without the boilerplate around and inside it.

Site style tree: the pages of one host are merged node by node. A node is the path of branches from the body to a text block,
the kind of branch that holds it, the element it sits in and whether most of it is a link. A node's importance is one minus the mean entropy of its
content features over the pages that have the node: lines that stand on every page have entropy 1, lines of one page 0.
Nodes of few pages are smoothed by the same presentation on all hosts. A block that is at least half link text has no importance of
its own. Blocks of nodes below THRESHOLD are removed; what remains is the main body.

Lines of ``extracted_content.text`` take the decision of the equal block of their page. Lines without such a block
(truncated or failed pages) take what blocks of the same template got on all pages, else follow from the lines around.

Scale: pages are parsed where they are read and leave as hashes; entropies come from counts with map-side combine; the
page of a record joins on request_id as hashes, never as text; nothing is collected.
"""

from __future__ import annotations

import gzip
import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.canon import site_of
from millrace.plans import checked_broadcast
from millrace.session import cut_lineage
from millrace.sources import table

THRESHOLD = 0.55
#: A branch whose leaves have less importance than this on average, by length of text, goes as a whole.
BRANCH = 0.4
#: Blocks of weight that the pooled importance of a presentation has against a host's own blocks.
PRIOR = 30.0
#: A template's own record: at least so many blocks on all pages, and share of them that was removed (or kept).
SEEN, SURE = 3, 0.8
LONG_LINE = 80

# Elements that begin a block; of these, those that are text elements rather than branches; void elements.
BLOCK = frozenset("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt pre font blockquote figcaption summary ul ol dl option title".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())

_DROP = re.compile(r"<(script|style|noscript|template|svg)\b[^>]*>.*?(?:</\1\s*>|$)|<!--.*?(?:-->|$)|<![^>]*>", re.I | re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)[^>]*>")
_CHARSET = re.compile(rb"charset=[\"']?([\w-]+)", re.I)


def decode(content: bytes, content_type: str | None) -> str:
    """UTF-8 if it fits, else the declared charsets, else Windows-1252; an undone gzip layer is undone here."""
    if content[:2] == b"\x1f\x8b":
        try:
            content = gzip.decompress(content)
        except (OSError, EOFError):
            pass
    named = [m.group(1).decode("ascii", "replace") for m in (_CHARSET.search((content_type or "").encode()), _CHARSET.search(content[:2048])) if m]
    for enc in ("utf-8", *named):
        try:
            return content.decode(enc)
        except (UnicodeDecodeError, LookupError):
            continue
    cut = content.decode("utf-8", "replace")
    return cut if cut.count("�") <= 2 else content.decode("cp1252", "replace")


def page_blocks(page: str) -> list[tuple[str, str, bool, str]]:
    """(path of branches from the body, nearest branch, leaf, at least half of it a link, text) of each text block of a page in order."""
    page = _DROP.sub(" ", page)
    # an open element: [tag, parent index, has block children, has h1, has paragraphs]
    nodes: list[list] = [["body", -1, False, False, False]]
    stack = [0]
    out: list[tuple[int, str, bool]] = []
    buf: list[str] = []
    links = 0
    linked = plain = 0

    def flush():
        nonlocal linked, plain
        if buf:
            raw = "".join(buf)
            if "&" in raw:
                raw = html.unescape(raw)
            node = stack[-1]
            parts = raw.split("\n") if nodes[node][0] == "pre" else (raw,)
            for part in parts:
                text = " ".join(part.split())
                if text:
                    out.append((node, text, linked > 0 and linked >= plain))
            buf.clear()
            linked = plain = 0

    at = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            t = page[at : m.start()]
            buf.append(t)
            if not t.isspace():
                if links:
                    linked += len(t)
                else:
                    plain += len(t)
        at = m.end()
        tag = m.group(2).lower()
        if tag not in BLOCK:
            if tag == "a":
                # directly in a branch, a link on a line of its own in the source is a block of its own
                alone = nodes[stack[-1]][0] not in TEXTUAL
                if m.group(1):
                    links = max(0, links - 1)
                    if alone and page[at : at + 1] in ("\n", "\r"):
                        flush()
                else:
                    if alone and buf and buf[-1][-1:] == "\n":
                        flush()
                    links += 1
            continue
        flush()
        if tag in VOID or tag in ("html", "body"):
            continue
        if m.group(1):
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]][0] == tag:
                    del stack[k:]
                    break
            continue
        links = 0
        top = nodes[stack[-1]][0]
        if top in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "font", "dt", "dd") and not (top == "font" and tag == "font"):
            stack.pop()
        if tag in ("li", "td", "tr", "th"):
            for k in range(len(stack) - 1, 0, -1):
                up = nodes[stack[k]][0]
                if up == tag:
                    del stack[k:]
                    break
                if up in ("ul", "ol", "table") or (up in ("td", "div") and tag == "li"):
                    break
        parent = stack[-1]
        nodes[parent][2] = True
        k = parent
        while nodes[k][0] in TEXTUAL and nodes[k][1] >= 0:
            k = nodes[k][1]
        if tag == "h1":
            nodes[k][3] = True
        elif tag == "p":
            nodes[k][4] = True
        nodes.append([tag, parent, False, False, False])
        stack.append(len(nodes) - 1)
    if at < len(page):
        t = page[at:]
        buf.append(t if "<" not in t else t[: t.index("<")])
        plain += len(t)
    flush()
    for node, text, link in out:  # bare text of paragraph length makes its branch a holder of paragraphs
        if not link and nodes[node][0] not in TEXTUAL and nodes[node][2] and len(text) >= LONG_LINE:
            nodes[node][4] = True
    blocks = []
    for node, text, link in out:
        tag, parent, inner = nodes[node][:3]
        if tag == "title":
            continue
        leaf = tag if tag in TEXTUAL or not inner else "#text"
        branch = node if leaf == "#text" else parent
        while branch > 0 and nodes[branch][0] in TEXTUAL:
            branch = nodes[branch][1]
        b = nodes[branch] if branch >= 0 else nodes[0]
        form = b[0] + ("+h1" if b[3] else "") + ("+p" if b[4] else "")
        path, up = [], b[1]
        while up > 0:  # the branches above, from the body
            if nodes[up][0] not in TEXTUAL:
                path.append(nodes[up][0])
            up = nodes[up][1]
        blocks.append(("/".join([*reversed(path), form]), form, leaf, link, text))
    return blocks


_DIGITS = re.compile(r"\d+")
_NAMES = re.compile(r"(?<![^\W\d_])[^\W\d_a-zЀ-ӿ֐-￿][^\W\d_]*(?:[ '’-][^\W\d_a-zЀ-ӿ֐-￿][^\W\d_]*)*|[А-ЯЁ][а-яё]+(?: [А-ЯЁ][а-яё]+)*")


def template(text: str) -> str:
    """Digits and runs of capitalised words as wildcards: what lines that differ in names and numbers have in common."""
    return _NAMES.sub("N", _DIGITS.sub("0", text))


def _hash(text: str) -> int:
    import xxhash

    h = xxhash.xxh3_64_intdigest(text)
    return h - (1 << 64) if h >= 1 << 63 else h


#: Distinct blocks and lines whose hashes a worker keeps; beyond, it starts a new store (a cache only).
STORE = 200_000


class _Hashes:
    """Hashes of texts (exact, digits masked, template), worked out once for each distinct text, as most boilerplate comes again."""

    def __init__(self):
        self.known: dict[str, tuple[int, int, int]] = {}

    def __call__(self, text: str) -> tuple[int, int, int]:
        got = self.known.get(text)
        if got is None:
            if len(self.known) > STORE:
                self.known = {}
            got = self.known[text] = (_hash(text), _hash(_DIGITS.sub("0", text.lower())), _hash(template(text)))
        return got


def _parse_pages(batches):
    of, names = _Hashes(), {}

    def name(text):
        if text not in names:
            names[text] = _hash(text)
        return names[text]

    for b in batches:
        ids, sites, types, bodies = (c for c in b.columns)
        rows: dict[str, list] = {k: [] for k in ("keys", "forms", "branches", "lens", "links", "hs", "ms", "ts")}
        for body, kind in zip(bodies, types.to_pylist(), strict=True):
            got = page_blocks(decode(body.as_py() or b"", kind))
            rows["keys"].append([name(f"{x[0]}|{x[2]}|{x[3]}") for x in got])
            rows["forms"].append([name(f"{x[1]}|{x[2]}|{x[3]}") for x in got])
            rows["branches"].append([name(x[0]) for x in got])
            rows["lens"].append([len(x[4]) for x in got])
            rows["links"].append([x[3] for x in got])
            for k, values in zip(("hs", "ms", "ts"), zip(*(of(x[4]) for x in got), strict=True) if got else ((), (), ()), strict=True):
                rows[k].append(list(values))
        yield pa.RecordBatch.from_arrays([ids, sites, *(pa.array(rows[k], pa.list_({"links": pa.bool_(), "lens": pa.int32()}.get(k, pa.int64()))) for k in rows)], ["request_id", "site", *rows])


def _parse_texts(batches):
    """Per record its lines as hashes; a blank line has hash 0. ``shape``: length with the sign of a final mark; title lines 0."""
    mark = re.compile(r"[.!?。！？।؟…:;»”\"')\]）」]\s*$")
    of = _Hashes()
    for b in batches:
        ids, reqs, titles, texts = b.columns
        hs, ts, shape = [], [], []
        for text, title in zip(texts.to_pylist(), titles.to_pylist(), strict=True):
            ls = [" ".join(x.split()) for x in (text or "").split("\n")]
            name = " ".join((title or "").split())
            both = [of(x) if x else (0, 0, 0) for x in ls]
            hs.append([x[0] for x in both])
            ts.append([x[2] for x in both])
            shape.append([0 if x and x == name else len(x) if mark.search(x) else -len(x) for x in ls])
        yield pa.RecordBatch.from_arrays([ids, reqs, pa.array(hs, pa.list_(pa.int64())), pa.array(ts, pa.list_(pa.int64())), pa.array(shape, pa.list_(pa.int32()))], ["id", "request_id", "hs", "ts", "shape"])


def style_importance(pages: DataFrame) -> DataFrame:
    """(site, key, imp): importance of each node of each host's style tree, 0 in branches that go as a whole.

    ``pages``: site, keys (nodes), forms (their presentation), branches, lens, links, ms (one item per block)."""
    pair = pages.select("site", F.explode(F.array_distinct(F.arrays_zip(F.col("keys").alias("key"), F.col("forms").alias("form"), F.col("ms").alias("m")))).alias("z")).groupBy("site", "z.key", "z.form", "z.m").agg(F.count(F.lit(1)).alias("k"))
    have = pages.select("site", F.explode(F.array_distinct("keys")).alias("key")).groupBy("site", "key").agg(F.count(F.lit(1)).alias("pages"))
    node = pair.groupBy("site", "key", "form").agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.log(F.col("k").cast("double"))).alias("klogk")).join(have, ["site", "key"])
    node = node.withColumn("ent", F.when(F.col("pages") > 1, F.col("klogk") / F.log(F.col("pages").cast("double"))).otherwise(F.lit(0.0))).withColumn("w", F.when(F.col("pages") > 1, F.col("n")).otherwise(F.lit(0)))
    node = cut_lineage(node.select("site", "key", "form", "ent", "w", "pages"))
    # the same presentation on all hosts with enough pages to tell
    pool = node.filter("pages >= 8").groupBy("form").agg((F.sum("ent") / F.sum("w")).alias("prior"))
    own = node.join(pool, "form", "left").select("site", "key", (1 - (F.col("ent") + PRIOR * F.coalesce("prior", F.lit(0.4))) / (F.col("w") + PRIOR)).alias("imp"))
    # composite importance of a branch: that of its leaves by their text, links counting nothing
    mass = pages.select("site", F.explode(F.arrays_zip("keys", "branches", "links", "lens")).alias("z")).groupBy("site", F.col("z.keys").alias("key"), F.col("z.branches").alias("branch"), F.col("z.links").alias("link")).agg(F.sum("z.lens").alias("mass"))
    leaf = mass.join(own, ["site", "key"]).withColumn("imp", F.when(F.col("link"), F.lit(0.0)).otherwise(F.col("imp")))
    w = Window.partitionBy("site", "branch")
    return leaf.select("site", "key", F.when(F.sum(F.col("imp") * F.col("mass")).over(w) >= BRANCH * F.sum("mass").over(w), F.col("imp")).otherwise(F.lit(0.0)).alias("imp"))


def judged_pages(pages: DataFrame) -> DataFrame:
    """Parsed pages with ``keep``: for each block whether its node is important and it is no link."""
    imp = style_importance(pages).groupBy("site").agg(F.map_from_entries(F.collect_list(F.struct("key", "imp"))).alias("imp"))
    with_imp = pages.join(checked_broadcast(cut_lineage(imp), 20_000), "site", "left")
    keep = F.transform(F.arrays_zip("keys", "links"), lambda z: ~z["links"] & (F.coalesce(F.try_element_at("imp", z["keys"]), F.lit(0.0)) >= THRESHOLD))
    return with_imp.select("request_id", "site", "hs", "ts", keep.alias("keep"))


def _decide(batches):
    """mapInArrow: 1 for lines of the main body, 0 for boilerplate, null for blank lines."""
    for b in batches:
        ids = b.column(0)
        out = []
        for hs, shape, ph, keep, told in zip(*(b.column(i).to_pylist() for i in range(1, 6)), strict=True):
            of_page: dict[int, bool] = {}
            for h, k in zip(ph or (), keep or (), strict=True):
                of_page[h] = of_page.get(h, False) or k
            told_of = {x["t"]: x["keep"] for x in told or ()}
            lab: list = []
            for i, h in enumerate(hs):
                lab.append(None if not h else True if shape[i] == 0 else of_page.get(h, told_of.get(i)))
            known = [i for i, x in enumerate(lab) if x is not None]
            solid = [i for i, h in enumerate(hs) if h and ((lab[i] is True) or (lab[i] is None and shape[i] >= LONG_LINE))]
            first, last = (solid[0], solid[-1]) if solid else (len(hs), -1)
            res = []
            for i, h in enumerate(hs):
                if not h:
                    res.append(None)
                elif lab[i] is not None:
                    res.append(lab[i])
                elif abs(shape[i]) >= LONG_LINE:
                    res.append(True)
                else:
                    before = next((lab[j] for j in reversed([j for j in known if j < i])), True)
                    after = next((lab[j] for j in known if j > i), False)
                    res.append(first < i < last and (before or after))
            out.append(res)
        yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.list_(pa.bool_()))], ["id", "body"])


def body_lines(crawl: DataFrame, extracted: DataFrame) -> DataFrame:
    """(id, body array<boolean>): for each line of a record's text whether it is of the main body, null for blank lines.

    ``crawl``: request_id, url, final_url, status_code, content_type, content. ``extracted``: id, request_id, title, text.
    Of several deliveries the one with most blocks is used (a truncated one has fewer). Null or empty pages and texts,
    records without a page and repeated rows are allowed; a null text has one blank line."""
    ok = crawl.filter(F.col("content").isNotNull() & (F.length("content") > 0) & F.col("status_code").between(200, 299))
    raw = ok.select("request_id", site_of(F.coalesce("final_url", "url")).alias("site"), "content_type", "content")
    pages = cut_lineage(raw.mapInArrow(_parse_pages, "request_id string, site string, keys array<long>, forms array<long>, branches array<long>, lens array<int>, links array<boolean>, hs array<long>, ms array<long>, ts array<long>"))
    # one delivery of each page, so that a page sent again does not make its lines look shared; ids are stable as pages are a checkpoint
    pages = pages.withColumn("uid", F.monotonically_increasing_id())
    chosen = pages.groupBy("request_id").agg(F.max(F.struct(F.size("hs").alias("n"), "uid")).alias("z")).select(F.col("z.uid").alias("uid"))
    pages = pages.join(checked_broadcast(cut_lineage(chosen)), "uid", "left_semi").drop("uid")
    judged = cut_lineage(judged_pages(pages))
    templates = judged.select(F.explode(F.arrays_zip("ts", "keep")).alias("z")).groupBy(F.col("z.ts").alias("t")).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("z.keep").cast("double")).alias("share"))
    telling = templates.filter((F.col("n") >= SEEN) & ((F.col("share") <= 1 - SURE) | (F.col("share") >= SURE))).select("t", (F.col("share") >= SURE).alias("keep"))
    best = judged.select("request_id", F.col("hs").alias("ph"), "keep")
    lines = extracted.select("id", "request_id", "title", "text").mapInArrow(_parse_texts, "id long, request_id string, hs array<long>, ts array<long>, shape array<int>")
    joined = cut_lineage(lines.join(best, "request_id", "left"))
    lost = joined.select("id", F.posexplode(F.zip_with("hs", "ts", lambda h, t: F.when((h != 0) & ~F.coalesce(F.array_contains("ph", h), F.lit(False)), t)))).filter("col IS NOT NULL").select("id", "pos", F.col("col").alias("t"))
    told = lost.join(telling, "t").groupBy("id").agg(F.collect_list(F.struct(F.col("pos").alias("t"), "keep")).alias("told"))
    return joined.join(told, "id", "left").select("id", "hs", "shape", "ph", "keep", "told").mapInArrow(_decide, "id long, body array<boolean>")


def extracted_body(spark, d: str) -> DataFrame:
    """``body_lines`` over the tables of a data directory."""
    e = table(spark, d, "extracted_content").select(F.col("extract_id").alias("id"), "request_id", "title", "text")
    return body_lines(table(spark, d, "crawl_results"), e)


def p1_found(spark, d: str) -> DataFrame:
    from .p07_residue import p7_found

    body = extracted_body(spark, d)
    noise = body.select(F.col("id").alias("extract_id"), F.posexplode("body").alias("line_no", "main")).filter("NOT main")
    return noise.join(p7_found(spark, d), "extract_id", "left_anti").select("extract_id", F.col("line_no").cast("long").alias("line_no"))


def p1_main_text(spark, d: str) -> DataFrame:
    """The main body of each record as text."""
    e = table(spark, d, "extracted_content").select("extract_id", F.split(F.coalesce("text", F.lit("")), "\n").alias("ls"))
    j = e.join(extracted_body(spark, d).withColumnRenamed("id", "extract_id"), "extract_id")
    return j.select("extract_id", F.array_join(F.filter(F.zip_with("ls", "body", lambda x, m: F.when(m, x)), lambda x: x.isNotNull()), "\n").alias("text"))


QUERIES = {"p1_found": p1_found, "p1_main_text": p1_main_text}
ORACLE: dict[str, str] = {}
