import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import markup as m
from millrace.functions import metadata as md
from millrace.operators.quality import wired_score

PAGE = """<html><head><title>On Harbours</title><meta name="author" content="Dr. Jane Smith"><meta property="og:title" content="Harbours"><meta name="description" content="About harbours">
<meta property="article:published_time" content="2023-12-01T10:00:00Z"><link rel="canonical" href="/h"><script type="application/ld+json">{"@type": "Article", "headline": "LD title", "author": {"name": "Jane Smith"}, "datePublished": "2023-12-01",
"interactionStatistic": {"interactionType": {"@type": "LikeAction"}, "userInteractionCount": 7}}</script><script type="application/ld+json">{broken</script></head>
<body><nav class="nav"><a href="/x">Home</a></nav><article itemscope itemtype="http://schema.org/Article"><h1 itemprop="name">On Harbours</h1><span class="author">Dr. Jane Smith</span><time datetime="2023-12-01">December 1</time>
<p>Harbours are places, sheltered from the sea, where ships may lie safely.<p>They have quays, cranes and sheds. See <a href="https://github.com/x/y">the code</a>.
<table><caption>Ports</caption><tr><th>Name<th>Age<th>City<tr><td>A<td>30<td>X<tr><td>B<td>40<td>Y</table><pre><code class="language-python">def f(x):
    import os
    return 1</code></pre><figure><img src="/a.jpg" alt="quay" width="1000" height="700"><figcaption>A quay</figcaption></figure></article><footer>All rights reserved</footer></body></html>"""
URL = "http://s.test/2023/12/01/h"


@pytest.fixture(scope="module")
def pages(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", t, URL, bytearray(PAGE.encode())), ("b", t, None, None), ("c", t, "x", bytearray(b"")), ("d", t, "http://[bad", bytearray("<p>café</p> <a href='http://[x'>l</a>".encode("latin-1"))), ("a", t, URL, bytearray(PAGE.encode()))]
    return spark.createDataFrame(rows, "request_id string, ts timestamp_ntz, url string, content binary")


def test_table_code_image_and_link(pages):
    t = m.page_tables(pages).filter("request_id = 'a'").first()
    assert t.headers == ["Name", "Age", "City"] and t.has_header and t.row_count == 2 and t.caption == "Ports"
    assert t.as_text.splitlines()[2:] == ["Name | Age | City", "-" * 17, "A | 30 | X", "B | 40 | Y"]
    code = m.page_code(pages).filter("type = 'pre_code'").collect()
    assert {c.language for c in code} == {"python"} and code[0].has_functions and code[0].indentation == "spaces"
    image = m.page_images(pages).first()
    assert (image.src, image.caption, image.kind) == ("http://s.test/a.jpg", "A quay", "photo")
    got = {r.href: (r.category, r.external) for r in m.page_links(pages).filter("request_id = 'a'").collect()}
    assert got["https://github.com/x/y"] == ("source_code", True) and got["http://s.test/x"][1] is False


def test_strategies_keep_the_article(pages):
    for name in ("dense", "scored", "plain", "selected", "heuristic"):
        text = m.EXTRACTORS[name](PAGE, URL)["text"]
        assert "sheltered from the sea" in text and "All rights" not in text and "datePublished" not in text
    got = {r.request_id: r for r in m.gated(m.page_texts(pages), ("scored", "plain"), lambda t: F.when(F.length(t) > 50, 1.0).otherwise(0.0)).collect()}
    assert got["a"].method == "scored" and got["b"].method is None
    assert m.cascade("", "")["method"] == "none" and m.cascade(PAGE, URL)["method"] == "dense"
    rules = pages.sparkSession.createDataFrame([("s.test", ["plain"]), ("test", ["scored"])], "domain string, order array<string>")
    x = m.gated(m.page_texts(pages).withColumn("netloc", F.lit("www.s.test")), ("scored",), wired_score, 0.0, rules, ("plain",))
    assert x.filter("request_id = 'a'").first().method == "plain"


def test_measures_of_the_tree(pages):
    r = m.dom_scores(m.page_dom(pages)).filter("request_id = 'a'").first()
    assert r.has_headings and r.has_semantic and r.has_alt and r.size_score == 1.0 and r.accessibility_score == 1.0 and r.images == 1
    assert not m.proper_headings([2, 3]) and not m.proper_headings([1, 3]) and m.proper_headings([1, 2, 1])


def test_sniffing(spark):
    rows = [(b"<!DOCTYPE html><p>",), (b' {"a": 1}',), (b"<?xml version",), (b"plain caf\xe9",), (None,)]
    got = spark.createDataFrame([(bytearray(x) if x else None,) for (x,) in rows], "c binary").select(m.sniff(F.col("c")).alias("k"), m.encoding(F.col("c")).alias("e"), m.html_text(F.col("c")).alias("t")).collect()
    assert [r.k for r in got] == ["html", "json", "xml", "text", "text"] and got[3].e == "latin-1" and got[3].t == "plain café"
    assert spark.sql("select '<META content=\"noindex\" name=\"robots\">' as h").select(m.has_noindex(F.col("h")).alias("n")).first().n


def test_metadata_record(pages):
    r = md.page_record(md.page_metadata_parts(pages), F.lit("2024-06-01").cast("timestamp_ntz")).filter("request_id = 'a'").first()
    assert (r.title, r.description, r.published_date.date(), r.canonical_url, r.schema_type) == ("Harbours", "About harbours", dt.date(2023, 12, 1), "http://s.test/h", "Article")
    assert "Jane Smith" in r.author and r.n_json_ld == 1 and r.date_confidence == 0.95
    parts = md.page_metadata_parts(pages).filter("request_id = 'a'").first()
    assert parts.ld_likes == 7 and parts.micro["http://schema.org/Article"]["name"] == "On Harbours"
    assert {a.key for a in parts.authors} >= {"jane smith"}


def test_dates_and_names():
    assert md.parse_date("1 December 2023") == md.parse_date("Dec 1, 2023") == md.parse_date("2023-12-01") == dt.datetime(2023, 12, 1)
    assert md.parse_date("20 hours") is None and md.parse_date("2023-12-01T02:00:00+02:00") == dt.datetime(2023, 12, 1)
    assert md.name_key("By Dr. Jane Smith, PhD") == md.name_key("jane smith") or md.name_key("Dr. Jane Smith, PhD") == "jane smith"
    assert md.valid_name("Lena Hart") and not any(map(md.valid_name, ("admin", "2023", "https://x", "May 5", "x")))
    assert md.author_details(m.parse('<div class="bio">Jane Smith writes about the sea.</div><a href="https://twitter.com/js">Jane Smith</a> js@x.org'), "Jane Smith js@x.org", "Jane Smith")["confidence"] == 1.0


def test_social_counts(spark):
    df = spark.createDataFrame([('<div class="share" data-x="facebook-share-count" data-n="12"></div> #Sea #12 @port',), (None,)], "html string").select(*[c.alias(k) for k, c in md.social(F.col("html")).items()])
    r = md.social_report(df).collect()
    assert (r[0].facebook_shares, r[0].has_sharing, r[0].hashtags, r[0].level) == (12, True, ["sea"], "moderate") and r[1].engagement == 0
