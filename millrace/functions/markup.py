"""Markup: decoding, a small document tree, extraction strategies, tables, code blocks, images, links and tree measures.

No SQL expression can parse tag soup, so pages are parsed where they are read, once, in Arrow batches; what leaves is a row of
plain columns for each page or item. A page that cannot be parsed gives an error column, never a failed task.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import table

# Elements without content, and those that an opening tag of the same kind closes.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BLOCKS = ("table", "ul", "ol", "dl", "div", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "figure", "section", "article", "blockquote", "header", "footer", "nav", "aside", "main", "form", "hr")
SCOPE = ("table", "ul", "ol", "dl", "select", "body", "html", "article", "section", "div", "main", "nav", "aside", "footer", "header")
# What the plain strategy removes, and where it looks for the main content, in order.
DROP_TAGS = ("script", "style", "nav", "header", "footer", "aside", "noscript")
DROP_CLASSES = ("nav", "navigation", "menu", "sidebar", "ad", "advertisement", "footer", "header")
MAIN = ("main", "article", ".content", "#content", ".post", ".entry", ".article-body", "[role=main]", ".main-content", ".post-content", ".entry-content")
# Class and id parts by which the scored strategy prefers or avoids a branch.
POSITIVE = ("article", "body", "content", "entry", "hentry", "main", "page", "post", "text", "blog", "story")
NEGATIVE = ("combx", "comment", "com-", "contact", "foot", "footer", "footnote", "masthead", "media", "meta", "outbrain", "promo", "related", "scroll", "shoutbox", "sidebar", "sponsor", "shopping", "tags", "tool", "widget")
# Patterns of program languages, counted without regard to case.
CODE_PATTERNS = {
    "python": (r"\bdef\s+", r"\bclass\s+", r"\bimport\s+", r"\bfrom\s+.*import", r"print\s*\(", r"if\s+__name__\s*==\s*[\"']__main__[\"']"),
    "javascript": (r"\bfunction\s+", r"\bvar\s+", r"\blet\s+", r"\bconst\s+", r"console\.log\s*\(", r"document\.", r"window\."),
    "java": (r"\bpublic\s+class\s+", r"\bpublic\s+static\s+void\s+main", r"\bSystem\.out\.", r"\bprivate\s+", r"\bprotected\s+"),
    "c": (r"#include\s*<", r"\bint\s+main\s*\(", r"\bprintf\s*\(", r"\bmalloc\s*\(", r"\bfree\s*\("),
    "sql": (r"\bSELECT\s+", r"\bFROM\s+", r"\bWHERE\s+", r"\bINSERT\s+", r"\bUPDATE\s+", r"\bDELETE\s+", r"\bCREATE\s+TABLE"),
    "html": (r"<html[^>]*>", r"<head[^>]*>", r"<body[^>]*>", r"<div[^>]*>", r"<script[^>]*>", r"<style[^>]*>"),
    "css": (r"\.[a-zA-Z][a-zA-Z0-9_-]*\s*\{", r"#[a-zA-Z][a-zA-Z0-9_-]*\s*\{", r"@media\s+", r"@import\s+"),
}
# Signs of functions, imports, variables and comments in code.
FUNCTIONS = (r"\bdef\s+\w+\s*\(", r"\bfunction\s+\w+\s*\(", r"\bpublic\s+\w+\s+\w+\s*\(", r"\bfunc\s+\w+\s*\(")
IMPORTS = (r"\bimport\s+", r"\bfrom\s+\w+\s+import", r"\brequire\s*\(", r"#include\s*<")
VARIABLES = (r"\bvar\s+\w+", r"\blet\s+\w+", r"\bconst\s+\w+", r"\bint\s+\w+")
COMMENTS = (r"//.*$", r"/\*.*?\*/", r"#.*$", r"<!--.*?-->")
# Elements with a meaning of their own, and those without visible text.
SEMANTIC = ("header", "nav", "main", "article", "section", "aside", "footer", "figure", "figcaption", "time", "mark", "details", "summary")
UNSEEN = ("script", "style", "noscript", "template", "meta", "link", "title", "head")
ENCODINGS = ("utf-8", "latin-1")
MAX_PAGE = 10_000_000


class Node:
    """An element: tag, attributes, parent, and children that are elements or text."""

    __slots__ = ("attrs", "kids", "parent", "tag")

    def __init__(self, tag: str, attrs: dict, parent):
        self.tag, self.attrs, self.parent, self.kids = tag, attrs, parent, []

    def walk(self):
        """The element itself and all below it, in document order."""
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(k for k in reversed(n.kids) if isinstance(k, Node))

    def find(self, *tags: str):
        return (n for n in self.walk() if n is not self and n.tag in tags)

    def strings(self, skip: tuple = ("script", "style")):
        stack = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                yield n
            elif n.tag not in skip or n is self:
                stack.extend(reversed(n.kids))

    def text(self, joiner: str = " ", skip: tuple = ("script", "style")) -> str:
        """Stripped pieces of text, joined."""
        return joiner.join(p for s in self.strings(skip) if (p := s.strip()))

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def drop(self) -> None:
        if self.parent:
            self.parent.kids = [k for k in self.parent.kids if k is not self]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]", {}, None)
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        closes, to = ("p",) if tag in BLOCKS else CLOSES.get(tag, ()), 0
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in closes:
                to = k
            elif self.open[k].tag in SCOPE:
                break
        if to:
            del self.open[to:]
        node = Node(tag, {k: v or "" for k, v in attrs}, self.open[-1])
        self.open[-1].kids.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                break

    def handle_data(self, data):
        self.open[-1].kids.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html[:MAX_PAGE])
    b.close()
    return b.root


def decode(content: bytes) -> str:
    """Bytes as the first of ENCODINGS that fits; the last always does."""
    for e in ENCODINGS:
        try:
            return content.decode(e)
        except UnicodeDecodeError:
            continue
    return ""


def first_match(root: Node, selector: str) -> Node | None:
    """The first element by tag, .class, #id or [attribute=value]."""
    for n in root.walk():
        if selector[0] == ".":
            hit = selector[1:] in n.classes()
        elif selector[0] == "#":
            hit = n.attrs.get("id") == selector[1:]
        elif selector[0] == "[":
            k, v = selector[1:-1].split("=")
            hit = n.attrs.get(k) == v
        else:
            hit = n.tag == selector
        if hit:
            return n
    return None


def _title(root: Node) -> str:
    t = first_match(root, "title")
    return t.text() if t else ""


def absolute(base: str, ref: str) -> str:
    """A reference resolved against its page; one that cannot be resolved stays."""
    try:
        return "https:" + ref if ref.startswith("//") else urljoin(base, ref)
    except ValueError:
        return ref


def canonical_text(html: str) -> str:
    """All text without scripts and styles, white space collapsed."""
    return " ".join(" ".join(parse(html).strings()).split())


def plain(html: str, url: str) -> dict:
    """Boilerplate tags and classes removed, then the first main selector, else the body."""
    root = parse(html)
    title = _title(root)
    for n in [n for n in root.walk() if n.tag in DROP_TAGS or set(n.classes()) & set(DROP_CLASSES)]:
        n.drop()
    main = next((m for s in MAIN if (m := first_match(root, s))), None) or first_match(root, "body") or root
    return {"text": main.text(), "title": title, "images": [absolute(url, n.attrs["src"]) for n in main.find("img") if n.attrs.get("src")], "score": 0.5}


def _link_share(n: Node) -> float:
    return sum(len(a.text()) for a in n.find("a")) / max(1, len(n.text()))


def scored(html: str, url: str) -> dict:
    """The branch whose paragraphs weigh most: length and commas, class and id words for or against, less its share of links."""
    root = parse(html)
    weight: dict[int, float] = {}
    nodes: dict[int, Node] = {}
    for p in root.find("p", "pre", "td", "blockquote"):
        text = p.text()
        if len(text) < 25:
            continue
        points = 1 + text.count(",") + min(len(text) / 100, 3)
        for up, part in ((p.parent, 1.0), (p.parent.parent if p.parent else None, 0.5)):
            if up is not None:
                if id(up) not in weight:
                    names = " ".join((up.attrs.get("class", ""), up.attrs.get("id", ""))).lower()
                    weight[id(up)], nodes[id(up)] = 25.0 * any(w in names for w in POSITIVE) - 25.0 * any(w in names for w in NEGATIVE), up
                weight[id(up)] += points * part
    best = max(weight, key=lambda k: weight[k] * (1 - _link_share(nodes[k])), default=None)
    node = nodes[best] if best is not None else first_match(root, "body") or root
    return {"text": " ".join(node.text().split()), "title": _title(root), "images": [absolute(url, n.attrs["src"]) for n in node.find("img") if n.attrs.get("src")], "score": 0.7}


def dense(html: str, url: str) -> dict:
    """Paragraphs, headings, items and code outside of navigation that are not mostly links, one a line."""
    root = parse(html)
    for n in [n for n in root.walk() if n.tag in (*DROP_TAGS, "form", "button")]:
        n.drop()
    lines, images = [], []
    for n in root.walk():
        if n.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "blockquote") and not any(k.tag in ("p", "li") for k in n.kids if isinstance(k, Node)):
            t = " ".join(n.text().split())
            if t and _link_share(n) < 0.5:
                lines.append(t)
        elif n.tag == "img" and n.attrs.get("src"):
            images.append(absolute(url, n.attrs["src"]))
    return {"text": "\n".join(lines), "title": _title(root), "images": images, "score": 0.8}


def selected(html: str, url: str) -> dict:
    """The first of nine main selectors, else the body; pieces of text joined without a separator."""
    root = parse(html)
    main = next((m for s in MAIN[:9] if (m := first_match(root, s))), None) or first_match(root, "body") or root
    return {"text": main.text(""), "title": _title(root), "images": [], "score": 0.6}


def heuristic(html: str, url: str) -> dict:
    """The body without boilerplate tags, else all text by patterns; more than ten characters or none."""
    root = parse(html)
    body = first_match(root, "body")
    if body:
        title = _title(root)
        for n in list(root.find("script", "style", "nav", "header", "footer", "aside")):
            n.drop()
        text = body.text("")
    else:
        rest = re.sub(r"(?is)<(script|style)[^>]*>.*?</\1>", "", html)
        found = re.search(r"(?is)<title[^>]*>(.*?)</title>", rest)
        title, text = found.group(1).strip() if found else "", " ".join(unescape(re.sub(r"<[^>]+>", " ", rest)).split())
    return {"text": text if len(text.strip()) > 10 else "", "title": title, "images": [], "score": 0.4}


#: Extractors by name: functions of (html, url) that give text, title, images and score. ``register`` adds one.
EXTRACTORS = {"dense": dense, "scored": scored, "plain": plain, "selected": selected, "model": lambda html, url: {"text": "", "title": "", "images": [], "score": 0.0}, "heuristic": heuristic}
CASCADE = ("dense", "selected", "model", "heuristic")


def register(name: str, extract) -> None:
    """Add an extractor; its result needs the keys text, title, images and score."""
    EXTRACTORS[name] = extract


def cascade(html: str, url: str, order: tuple = CASCADE, least: int = 20) -> dict:
    """The first strategy in order whose text has ``least`` characters; a failing strategy counts as without text."""
    for name in order:
        try:
            got = EXTRACTORS[name](html, url)
        except Exception:  # noqa: BLE001 - any failure of a strategy passes the page on
            continue
        if len(got["text"].strip()) >= least:
            return got | {"method": name}
    return {"text": "", "title": "", "images": [], "score": 0.0, "method": "none"}


def _number(value: str | None, default: int = 1) -> int:
    return int(value) if (value or "").strip().isdigit() and len(value) < 7 else default


def tables(root: Node) -> list[dict]:
    """Each table with caption, headers, rows of cells (spans kept), counts; tables without rows and caption are left out."""
    out = []
    for index, t in enumerate(root.find("table")):
        caption, rows = next(t.find("caption"), None), [list(r.find("td", "th")) for r in t.find("tr")]
        heads = [c.text("") for c in rows[0]] if rows else []
        has_header = any(heads)
        body = [[{"text": c.text(""), "colspan": _number(c.attrs.get("colspan")), "rowspan": _number(c.attrs.get("rowspan"))} for c in r] for r in rows[1 if has_header else 0 :] if r]
        caption_text = caption.text("") if caption else ""
        if body or caption_text:
            heads = heads if has_header else []
            out.append({"index": index, "caption": caption_text, "summary": t.attrs.get("summary", ""), "headers": heads, "rows": body, "row_count": len(body), "column_count": len(heads) or max(map(len, body), default=0), "has_header": has_header, "has_footer": next(t.find("tfoot"), None) is not None})
    return out


def table_text(t: dict) -> str:
    """Caption, header line, rule and rows of a table."""
    lines = [f"Table: {t['caption']}", ""] if t["caption"] else []
    if t["headers"]:
        lines += [" | ".join(t["headers"]), "-" * len(" | ".join(t["headers"]))]
    return "\n".join(lines + [" | ".join(c["text"] for c in r) for r in t["rows"]])


def class_language(names: str) -> str | None:
    """The program language that an element's class names, if any."""
    low = names.lower()
    for lang in CODE_PATTERNS:
        if f"language-{lang}" in low or f"lang-{lang}" in low or lang in low.split():
            return lang
    found = re.search(r"highlight-(\w+)", low)
    return found.group(1) if found else None


def pattern_language(code: str) -> tuple[str, float]:
    """The language with most pattern hits per 100 characters, and a tenth of that rate as confidence."""
    rate = {k: sum(len(re.findall(p, code, re.I)) for p in ps) / max(1, len(code) / 100) for k, ps in CODE_PATTERNS.items()}
    best = max(rate, key=rate.get)
    return (best, min(1.0, rate[best] / 10)) if rate[best] > 0 else ("unknown", 0.0)


def code_features(code: str) -> dict:
    has = lambda ps, flags=re.I: any(re.search(p, code, flags) for p in ps)
    lines = code.split("\n")
    spaces, tabs = sum(x.startswith("    ") for x in lines), sum(x.startswith("\t") for x in lines)
    return {"lines": len(lines), "chars": len(code), "has_functions": has(FUNCTIONS), "has_imports": has(IMPORTS), "has_variables": has(VARIABLES), "has_comments": has(COMMENTS, re.M | re.S), "indentation": "spaces" if spaces > tabs else "tabs" if tabs else "unknown"}


def code_blocks(root: Node) -> list[dict]:
    """pre and code elements, and elements of highlighter classes, with ten characters or more; class first, else patterns tell the language."""
    out = []
    kinds = (("pre_code", lambda n: n.tag in ("pre", "code")), ("syntax_highlight", lambda n: bool({"highlight", "code", "codehilite"} & set(n.classes())) or any(c.startswith("language-") for c in n.classes())))
    for kind, wanted in kinds:
        for index, n in enumerate(filter(wanted, root.walk())):
            code = "".join(n.strings(()))
            if len(code.strip()) >= 10:
                named = class_language(n.attrs.get("class", ""))
                lang, sure = (named, 0.8) if named else pattern_language(code)
                out.append({"index": index, "type": kind, "content": code.strip(), "language": lang, "confidence": sure} | code_features(code))
    return out


def _image_kind(src: str, n: Node) -> str:
    try:
        path = urlparse(src.lower()).path
    except ValueError:
        path = src.lower()
    if ".svg" in path:
        return "icon"
    if ".gif" in path:
        return "animation"
    if not any(e in path for e in (".jpg", ".jpeg", ".png", ".webp")):
        return "unknown"
    w, h = (_number(n.attrs.get(k), 0) for k in ("width", "height"))
    return "photo" if not (w and h) else "icon" if w < 50 or h < 50 else "photo" if w > 800 or h > 600 else "graphic"


def images(root: Node, url: str) -> list[dict]:
    """Each image with absolute source, texts, size, caption (figure or caption class), 200 characters around it and its kind."""
    out = []
    for index, n in enumerate(root.find("img")):
        src = n.attrs.get("src")
        if not src:
            continue
        src, up = absolute(url, src), n.parent
        caption = next(up.find("figcaption"), None) if up.tag == "figure" else None
        caption = caption or next((k for k in up.walk() if {"caption", "image-caption", "figure-caption"} & set(k.classes())), None)
        around = up.text("")
        out.append({"index": index, "src": src, **{k: n.attrs.get(k, "") for k in ("alt", "title", "width", "height")}, "caption": caption.text("") if caption else "", "context": around[:200] if len(around) > 20 else "", "kind": _image_kind(src, n)})
    return out


def links(root: Node, url: str) -> list[dict]:
    """Each link with absolute address, text, attributes, whether it leaves the host, and 200 characters around it."""
    host, out = _netloc(url), []
    for index, n in enumerate(root.find("a")):
        href = n.attrs.get("href")
        if not href:
            continue
        href = href if href.startswith(("http://", "https://", "mailto:", "tel:")) else absolute(url, href)
        text = n.text("")
        out.append({"index": index, "href": href, "text": text, **{k: n.attrs.get(k, "") for k in ("title", "rel", "target")}, "external": _netloc(href) != host, "context": (n.parent.text("").replace(text, "") if text else n.parent.text("")).strip()[:200]})
    return out


def _netloc(url: str) -> str:
    try:
        return urlparse(url).netloc
    except ValueError:
        return ""


def proper_headings(levels: list[int]) -> bool:
    """Headings begin with the first level and never skip one."""
    return bool(levels) and levels[0] == 1 and all(b <= a + 1 for a, b in zip(levels, levels[1:]))


def dom(root: Node, html: str) -> dict:
    """Counts, depths, kinds of elements, share of visible text and structural flags of a page."""
    depth, depths, fan, texts = {id(root): 0}, [0], [sum(isinstance(k, Node) for k in root.kids)], 0
    kinds, classes, ids = Counter(), set(), set()
    for n in root.walk():
        texts += sum(isinstance(k, str) and bool(k.strip()) for k in n.kids)
        if n is root:
            continue
        depth[id(n)] = depth[id(n.parent)] + 1
        depths.append(depth[id(n)])
        fan.append(sum(isinstance(k, Node) for k in n.kids))
        kinds[n.tag] += 1
        classes.update(n.classes())
        if n.attrs.get("id"):
            ids.add(n.attrs["id"])
    hrefs = [n.attrs["href"].lower() for n in root.find("a") if n.attrs.get("href")]
    out_links = sum(h.startswith(("http", "//")) for h in hrefs)
    pictures = list(root.find("img"))
    forms = [len(list(f.find("label"))) >= 0.8 * len(list(f.find("input", "select", "textarea"))) for f in root.find("form")]
    visible = sum(len(s) for s in root.strings(UNSEEN))
    return {
        "elements": len(depths), "texts": texts, "classes": len(classes), "ids": len(ids), "max_depth": max(depths), "mean_depth": sum(depths) / len(depths), "branching": sum(fan) / len(fan),
        "semantic": sum(kinds[k] for k in SEMANTIC), "internal_links": len(hrefs) - out_links, "external_links": out_links,
        "images": len(pictures), "videos": kinds["video"], "audio": kinds["audio"], "forms": kinds["form"], "buttons": kinds["button"], "inputs": kinds["input"],
        "text_length": sum(len(s) for s in root.strings(())), "visible_length": visible, "text_ratio": visible / len(html) if html else 0.0,
        "has_semantic": any(kinds[k] for k in SEMANTIC), "has_headings": proper_headings([int(n.tag[1]) for n in root.walk() if n.tag in ("h1", "h2", "h3", "h4", "h5", "h6")]),
        "has_alt": not pictures or sum(bool(n.attrs.get("alt")) for n in pictures) / len(pictures) > 0.8, "has_labels": not forms or sum(forms) / len(forms) > 0.8,
    }


def per_page(pages: DataFrame, work, ddl: str) -> DataFrame:
    """Rows of ``work(html, url)``, a list of dicts for each page, after the columns request_id and ts. pages: request_id, ts, url,
    content binary. A page whose work fails gives no row; null and empty content is an empty page."""
    schema = T.StructType(pages.select("request_id", "ts").schema.fields + T._parse_datatype_string(ddl).fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                try:
                    got = work(decode(r["content"] or b""), r["url"] or "")
                except Exception:  # noqa: BLE001 - one broken page must not fail the task
                    continue
                rows += [{"request_id": r["request_id"], "ts": r["ts"], **g} for g in got]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return pages.select("request_id", "ts", "url", "content").mapInArrow(run, schema)


_CELL = "struct<text: string, colspan: int, rowspan: int>"
TABLE = f"index int, caption string, summary string, headers array<string>, rows array<array<{_CELL}>>, row_count int, column_count int, has_header boolean, has_footer boolean, as_text string"
CODE = "index int, type string, content string, language string, confidence double, lines int, chars int, has_functions boolean, has_imports boolean, has_variables boolean, has_comments boolean, indentation string"
IMAGE = "index int, src string, alt string, title string, width string, height string, caption string, context string, kind string"
LINK = "index int, href string, text string, title string, rel string, target string, external boolean, context string"
DOM = "elements int, texts int, classes int, ids int, max_depth int, mean_depth double, branching double, semantic int, internal_links int, external_links int, images int, videos int, audio int, forms int, buttons int, inputs int, text_length int, visible_length int, text_ratio double, has_semantic boolean, has_headings boolean, has_alt boolean, has_labels boolean"
TEXTS = "texts map<string, string>, titles map<string, string>"


def page_tables(pages: DataFrame) -> DataFrame:
    return per_page(pages, lambda h, u: [t | {"as_text": table_text(t)} for t in tables(parse(h))], TABLE)


def page_code(pages: DataFrame) -> DataFrame:
    return per_page(pages, lambda h, u: code_blocks(parse(h)), CODE)


def page_images(pages: DataFrame) -> DataFrame:
    return per_page(pages, lambda h, u: images(parse(h), u), IMAGE)


def page_links(pages: DataFrame) -> DataFrame:
    """Links with their class (by native rules)."""
    from .links import link_class

    return per_page(pages, lambda h, u: links(parse(h), u), LINK).withColumn("category", link_class(F.col("href"), F.col("text")))


def page_dom(pages: DataFrame) -> DataFrame:
    return per_page(pages, lambda h, u: [dom(parse(h), h)], DOM)


def _bands(c: Column, limits: tuple, values: tuple) -> Column:
    """The value of the first limit that ``c`` does not exceed; the last value beyond all."""
    out = F.lit(values[-1])
    for limit, v in reversed(list(zip(limits, values, strict=False))):
        out = F.when(c <= limit, F.lit(v)).otherwise(out)
    return out


def dom_scores(measures: DataFrame) -> DataFrame:
    """Size, complexity and accessibility scores and impact classes beside the measures of ``page_dom``."""
    e, d, b, r = (F.col(c) for c in ("elements", "max_depth", "branching", "text_ratio"))
    ratio = F.when(r >= 0.3, 1.0).when(r >= 0.2, 0.8).when(r >= 0.1, 0.6).otherwise(0.4)
    x = measures.withColumns({"size_score": _bands(e, (100, 500, 1000, 2000), (1.0, 0.8, 0.6, 0.4, 0.2)), "complexity_score": (_bands(d, (10, 15, 20), (1.0, 0.8, 0.6, 0.4)) + _bands(b, (3, 5, 8), (1.0, 0.8, 0.6, 0.4)) + ratio) / 3})
    x = x.withColumn("accessibility_score", sum(F.col(c).cast("int") for c in ("has_semantic", "has_headings", "has_alt", "has_labels")) / 4)
    c = F.col("complexity_score")
    return x.withColumns({
        "size_impact": _bands(e, (100, 500, 1000, 2000), ("minimal", "low", "moderate", "high", "severe")), "depth_impact": _bands(d, (10, 15, 20), ("minimal", "low", "moderate", "high")),
        "complexity_impact": F.when(c >= 0.8, "minimal").when(c >= 0.6, "low").when(c >= 0.4, "moderate").otherwise("high"), "ratio_impact": F.when(r >= 0.3, "optimal").when(r >= 0.2, "good").when(r >= 0.1, "fair").otherwise("poor"),
        "size_advice": _bands(e, (500, 1000), ("keep", "reduce", "split_or_load_late")), "depth_advice": _bands(d, (15,), ("keep", "flatten")), "complexity_advice": F.when(c >= 0.7, "keep").when(c >= 0.5, "simplify").otherwise("rework"),
        "ratio_advice": F.when(r >= 0.25, "keep").when(r >= 0.15, "minor").otherwise("more_text"),
    })


def page_texts(pages: DataFrame, names: tuple = tuple(EXTRACTORS)) -> DataFrame:
    """Text and title of every page by each of the named extractors, from one pass."""

    def work(html, url):
        got = {}
        for n in names:
            try:
                got[n] = EXTRACTORS[n](html, url)
            except Exception:  # noqa: BLE001
                got[n] = {"text": "", "title": ""}
        return [{"texts": {n: g["text"] for n, g in got.items()}, "titles": {n: g["title"] for n, g in got.items()}}]

    return per_page(pages, work, TEXTS)


def gated(texts: DataFrame, order: tuple, score, threshold: float = 0.6, overrides: DataFrame | None = None, more: tuple = ()) -> DataFrame:
    """texts (map by extractor) with the first extractor in order whose text is not blank and scores ``threshold``: method, text, score.

    ``overrides`` (domain, order array<string>): hosts equal to or below a domain take its order, the longest domain first; the
    table is small configuration, ``netloc`` a column of texts and ``more`` the extractors that only overrides name."""
    names = F.array(*map(F.lit, order))
    if overrides is not None:
        rules = overrides.agg(F.sort_array(F.collect_list(F.struct(F.length("domain").alias("n"), "domain", F.col("order").alias("o"))), asc=False).alias("rules"))
        texts = texts.join(F.broadcast(rules))  # one row
        hit = F.filter("rules", lambda x: (F.col("netloc") == x["domain"]) | F.endswith(F.col("netloc"), F.concat(F.lit("."), x["domain"])))
        names = F.coalesce(F.get(hit, F.lit(0))["o"], names)
    # one column for each extractor, so that its score is worked out by native expressions
    known = list(dict.fromkeys((*order, *more)))
    scored_ = texts.withColumns({f"_s_{n}": score(F.coalesce(F.element_at("texts", n), F.lit(""))) for n in known})
    all_scores = F.create_map(*[x for n in known for x in (F.lit(n), F.col(f"_s_{n}"))])
    ok = F.filter(names, lambda n: (F.trim(F.coalesce(F.element_at("texts", n), F.lit(""))) != "") & (F.element_at(all_scores, n) >= threshold))
    x = scored_.withColumn("method", F.get(ok, F.lit(0)))
    return x.withColumns({"text": F.element_at("texts", F.col("method")), "score": F.element_at(all_scores, F.col("method"))}).drop(*[f"_s_{n}" for n in known])


def has_noindex(html: Column) -> Column:
    """A robots meta tag that forbids indexing, in either order of its attributes."""
    return html.rlike(r"(?is)<meta[^>]+name\s*=\s*[\"']?robots[\"']?[^>]+noindex") | html.rlike(r"(?is)<meta[^>]+noindex[^>]+name\s*=\s*[\"']?robots")


def sniff(content: Column) -> Column:
    """Kind of content by its first 1000 bytes: html, json, xml, pdf or text."""
    head = F.lower(F.decode(F.coalesce(F.substring(content, 1, 1000), F.lit(b"")), "ISO-8859-1"))
    return F.when(head.contains("<html") | head.contains("<!doctype html"), "html").when(F.trim(head).rlike(r"^[\{\[]"), "json").when(head.contains("<?xml"), "xml").when(head.startswith("pdf"), "pdf").otherwise("text")


def encoding(content: Column) -> Column:
    """The encoding that ``decode`` takes."""
    return F.when(F.is_valid_utf8(F.coalesce(content, F.lit(b"")).cast("string")), "utf-8").otherwise("latin-1")


def html_text(content: Column) -> Column:
    """Content as text by ``encoding``, natively."""
    c = F.coalesce(content, F.lit(b""))
    return F.when(F.is_valid_utf8(c.cast("string")), c.cast("string")).otherwise(F.decode(c, "ISO-8859-1"))


def canonical_html(html: Column) -> Column:
    """``canonical_text`` of a column of markup."""

    @F.pandas_udf(T.StringType())
    def run(s):
        return s.map(lambda x: canonical_text(x) if x else "")

    return run(html)


def _pages(spark, d):
    return table(spark, d, "crawl_results").select("request_id", "ts", F.coalesce("final_url", "url").alias("url"), "content")


_SHORT = lambda df, *cols: df.select("request_id", "ts", *cols)


def markup_tables(spark, d):
    return page_tables(_pages(spark, d)).drop("rows")


def markup_code(spark, d):
    return page_code(_pages(spark, d))


def markup_images(spark, d):
    return page_images(_pages(spark, d))


def markup_links(spark, d):
    return page_links(_pages(spark, d))


def markup_dom(spark, d):
    return dom_scores(page_dom(_pages(spark, d)))


def markup_cascade(spark, d):
    """Text and title of each page by the first strategy that succeeds."""
    return per_page(_pages(spark, d), lambda h, u: [{k: v for k, v in cascade(h, u).items() if k != "images"}], "text string, title string, score double, method string")


def markup_gated(spark, d):
    """The first extractor whose text passes the quality gate, by page."""
    from millrace.operators.quality import wired_score

    from .links import netloc

    got = page_texts(_pages(spark, d), ("dense", "scored", "plain")).join(_pages(spark, d).select("request_id", "ts", netloc(F.col("url")).alias("netloc")).distinct(), ["request_id", "ts"])
    return gated(got, ("dense", "scored", "plain"), wired_score).select("request_id", "ts", "method", F.round("score", 6).alias("score"), F.length("text").alias("chars"))


def page_sniff(spark, d):
    """Kind and encoding of each delivery and whether it forbids indexing."""
    t = table(spark, d, "crawl_results").select("request_id", "ts", "content")
    return t.select("request_id", "ts", sniff(F.col("content")).alias("kind"), encoding(F.col("content")).alias("encoding"), has_noindex(html_text(F.col("content"))).alias("noindex"))


QUERIES = {f.__name__: f for f in (markup_tables, markup_code, markup_images, markup_links, markup_dom, markup_cascade, markup_gated, page_sniff)}

ORACLE: dict[str, str] = {}
