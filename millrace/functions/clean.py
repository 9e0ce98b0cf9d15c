"""Cleaning, structure, sanitising and names as native expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.sources import table

# Words from which on a line is boilerplate.
BOILERPLATE = (
    "home|about|contact|menu|navigation|nav|sidebar", "login|register|sign up|sign in|logout", "previous|next|back|forward|continue", "advertisement|sponsored|ads?|promotion", "click here|read more|learn more|view all",
    r"copyright|©|\(c\)|privacy|terms|conditions|policy", "all rights reserved|disclaimer|legal", "share|tweet|like|follow|subscribe", "facebook|twitter|instagram|linkedin|youtube", "loading|please wait|error|404|not found", "javascript|cookies?|enable|disable",
)
# Structure of plain text.
LIST_ITEM, NUMBERED, HEADER, QUOTE = r"^[-•*]\s+(.+)$", r"^\d+\.\s+(.+)$", r"^#{1,6}\s+(.+)$", r"^>\s+(.+)$"
# Markup and statements that must not reach a store.
THREATS = (r"<script[^>]*>.*?</script>", r"javascript:", r"on\w+\s*=", r"<iframe[^>]*>", r"\b(?:SELECT|INSERT|UPDATE|DELETE|DROP|UNION|CREATE|ALTER)\b\s+\w+\s+(?:FROM|INTO|TABLE|SET)\b", r"\bOR\b\s*\d+\s*=\s*\d+", r"\bAND\b\s*\d+\s*=\s*\d+")
RESERVED = ("con", "prn", "aux", "nul", "com1", "com2", "com3", "com4", "com5", "com6", "com7", "com8", "com9", "lpt1", "lpt2", "lpt3", "lpt4", "lpt5", "lpt6", "lpt7", "lpt8", "lpt9")


def drop_boilerplate(text: Column) -> Column:
    """From a boilerplate word to the end of its line removed, the line break with it."""
    return reduce(lambda c, p: F.regexp_replace(c, rf"(?i)\b(?:{p})\b[^\n]*(?:\n|$)", ""), BOILERPLATE, F.coalesce(text, F.lit("")))


def clean_text(text: Column) -> Column:
    """Boilerplate removed, white space inside lines collapsed, three or more line breaks made two, trimmed."""
    lines = F.array_join(F.transform(F.split(drop_boilerplate(text), "\n"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), "\n")
    return F.regexp_replace(F.regexp_replace(lines, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def sanitize(text: Column) -> tuple[Column, Column]:
    """(text with threats blocked, number of kinds found)."""
    t = F.coalesce(text, F.lit(""))
    n = sum((t.rlike(f"(?is){p}").cast("int") for p in THREATS), F.lit(0))
    return reduce(lambda c, p: F.regexp_replace(c, f"(?is){p}", "[BLOCKED]"), THREATS, t), n


def escape_html(text: Column, longest: int = 10_000) -> Column:
    t = F.regexp_replace(F.substring(F.coalesce(text, F.lit("")), 1, longest), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")), t)


def slugify(name: Column, longest: int = 255) -> Column:
    """A safe file name: unsafe characters and spaces to one dash, lower case, reserved names marked; 'untitled' if nothing is left."""
    s = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"[^a-z0-9._-]+", "-"), r"-{2,}", "-")
    s = F.substring(F.regexp_replace(s, r"^[-.]+|[-.]+$", ""), 1, longest)
    return F.when(s == "", F.lit("untitled")).when(F.substring_index(s, ".", 1).isin(*RESERVED), F.concat(F.lit("_"), s)).otherwise(s)


def clean_boilerplate(spark, d):
    return table(spark, d, "extracted_content").select("extract_id", clean_text(F.col("text")).alias("clean"))


def structured_text(spark, d):
    """Headers, list items, numbered items, quotes and paragraphs over 20 characters, counted per document."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.trim(x))
    n = lambda p: F.size(F.filter(lines, lambda x: x.rlike(p))).cast("long")
    paras = F.filter(F.split("text", "\n\n"), lambda p: F.length(F.trim(p)) > 20)
    return table(spark, d, "documents").select("doc_id", n(HEADER).alias("headers"), n(LIST_ITEM).alias("list_items"), n(NUMBERED).alias("numbered"), n(QUOTE).alias("quotes"), F.size(paras).cast("long").alias("paragraphs"))


def sanitize_text(spark, d):
    text, n = sanitize(F.col("text"))
    return table(spark, d, "extracted_content").select("extract_id", F.sha2(text, 256).alias("text_sha"), n.cast("long").alias("threats"), F.round(F.greatest(F.lit(0.0), 1 - 0.1 * n), 6).alias("confidence"))


def sanitize_string(spark, d):
    return table(spark, d, "extracted_content").select("extract_id", escape_html(F.col("title")).alias("escaped"))


def slugs(spark, d):
    return table(spark, d, "extracted_content").select("extract_id", slugify(F.col("title")).alias("slug"))


QUERIES = {f.__name__: f for f in (clean_boilerplate, structured_text, sanitize_text, sanitize_string, slugs)}

_chain = lambda inner, pats, to, opts: reduce(lambda c, p: f"regexp_replace({c}, '{p}', '{to}', '{opts}')", pats, inner)
_BP = [rf"(?:^|\b)(?:{p})\b[^\n]*(?:\n|$)".replace(r"(?:^|\b)", r"\b") for p in BOILERPLATE]
_LINES = "list_transform(string_split({}, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g')))"
ORACLE = {
    "clean_boilerplate": "select extract_id, regexp_replace(regexp_replace(array_to_string(" + _LINES.format(_chain("text", _BP, "", "gi")) + r", chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') as clean from extracted_content",
    "structured_text": "with l as (select doc_id, text, list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')) as l from documents) select doc_id, " + ", ".join(f"cast(len(list_filter(l, lambda x: regexp_matches(x, '{p}'))) as bigint) as {n}" for p, n in ((HEADER, "headers"), (LIST_ITEM, "list_items"), (NUMBERED, "numbered"), (QUOTE, "quotes"))) + ", cast(len(list_filter(string_split(text, chr(10) || chr(10)), lambda x: length(trim(x, ' ')) > 20)) as bigint) as paragraphs from l",
    "sanitize_text": "select extract_id, sha256(" + _chain("text", THREATS, "[BLOCKED]", "gis") + ") as text_sha, n as threats, round(greatest(0, 1 - 0.1::double * n), 6) as confidence from (select *, cast(" + " + ".join(f"regexp_matches(text, '{p}', 'is')::int" for p in THREATS) + " as bigint) as n from extracted_content)",
    "sanitize_string": r"select extract_id, replace(replace(replace(replace(replace(regexp_replace(substring(coalesce(title, ''), 1, 10000), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g'), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '" + '"' + "', '&quot;'), chr(39), '&#x27;') as escaped from extracted_content",
    "slugs": "select extract_id, case when s = '' then 'untitled' when split_part(s, '.', 1) in (" + ", ".join(f"'{r}'" for r in RESERVED) + ") then '_' || s else s end as slug from (select extract_id, substring(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9._-]+', '-', 'g'), '-{2,}', '-', 'g'), '^[-.]+|[-.]+$', '', 'g'), 1, 255) as s from extracted_content)",
}
