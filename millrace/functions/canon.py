"""Canonical forms of texts, hosts and domains as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_text(c: Column) -> Column:
    """Lower case, each run of white space one space, trimmed. Null stays null."""
    return F.trim(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))


def site_of(url: Column) -> Column:
    """Host of a url in lower case, without user, port and a leading ``www.`` or ``m.``; null or hostless: ''."""
    host = F.regexp_extract(F.trim(F.coalesce(url, F.lit(""))), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(F.lower(host), r"^(?:www|m)\.", "")


def clean_domain(domain: Column) -> Column:
    """Trimmed, lower case, without leading ``www.``, port and final dot; null: ''."""
    d = F.lower(F.trim(F.coalesce(domain, F.lit(""))))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(d, r"^www\.", ""), r":\d*$", ""), r"\.$", "")
