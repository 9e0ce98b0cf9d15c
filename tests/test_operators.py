import pytest
from pyspark.sql import functions as F

from millrace import queries
from millrace.functions.canon import canonical_text, clean_domain, site_of
from millrace.functions.clean import clean_text, slugify
from millrace.functions.links import link_class, url_verdict
from millrace.operators.dataset import chunk_tokens
from millrace.operators.dedup import all_pairs, fuzzy_pairs, hybrid_verdicts, knn, lsh_pairs, mark_exact, shingles, similar_sets, tokens
from millrace.operators.ops import replay_breaker
from millrace.operators.quality import length_score, wired_score


def test_a_missing_module_fails(monkeypatch):
    monkeypatch.setattr(queries, "MODULES", (*queries.MODULES, "functions.none"))
    with pytest.raises(ModuleNotFoundError):
        queries.queries()


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first().r


def test_canonical_forms(spark):
    assert one(spark, "  A\u00a0 b\n\tC ", canonical_text) == "a b c"
    assert one(spark, None, canonical_text) is None
    assert one(spark, "https://u:p@WWW.Site.test:443/x", site_of) == "site.test"
    assert one(spark, None, site_of) == ""
    assert one(spark, " www.Shop.example.:80", clean_domain) == "shop.example"


def test_length_and_wired_scores(spark):
    assert one(spark, "x" * 400, length_score) == 0.0
    assert one(spark, "x" * 401, length_score) == 1.0
    assert one(spark, "", wired_score) == 0.0
    text = "The cat sat on the mat and looked at the birds in the garden with great interest. " * 6
    assert abs(one(spark, text, wired_score) - 0.925) < 1e-9


def test_cleaning_and_names(spark):
    got = one(spark, "Home | About\nThe body of the text.\nCopyright 2024 Example", clean_text)
    assert "body of the text" in got and "Copyright" not in got and "Home" not in got
    assert one(spark, "  My file: (1)?.txt ", slugify) == "my-file-1-.txt"
    assert one(spark, None, slugify) == "untitled"


def test_links(spark):
    df = spark.createDataFrame([("https://github.com/x", "code"), ("/about", "About"), ("https://facebook.com/x", ""), ("/docs/manual.pdf", "Manual"), ("#top", "")], "h string, t string")
    assert [r.c for r in df.select(link_class(F.col("h"), F.col("t")).alias("c")).collect()] == ["source_code", "navigation", "social", "download", "anchor"]
    assert one(spark, "http://192.168.0.1/x", url_verdict) == "private_address"


def test_exact_duplicates_in_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, None)], "ord int, text string")
    got = {r.ord: r.is_duplicate for r in mark_exact(df, F.sha2(F.coalesce("text", F.lit("")), 256), "ord").collect()}
    assert got == {1: False, 2: False, 3: True, 4: False, 5: True}


def test_lsh_finds_near_copies(spark):
    base = " ".join(f"word{i}" for i in range(200))
    df = spark.createDataFrame([(1, base), (2, base + " extra"), (3, "something else entirely here"), (4, ""), (5, base)], "ord int, text string")
    assert {(r.a, r.b) for r in lsh_pairs(df, tokens(F.col("text"))).collect()} == {(1, 2)}
    assert {(r.a, r.b) for r in lsh_pairs(df, shingles(F.col("text")), 0.85).collect()} == {(1, 2)}


def test_copies_and_pairs_at_the_threshold_are_found(spark):
    rows = [(i, " ".join(f"w{i // 2}x{k + (i % 2) * 11}" for k in range(100))) for i in range(80)] + [(100, "A text in capitals and small letters."), (101, "a text in Capitals and small letters.")]
    df = spark.createDataFrame(rows, "ord int, text string")
    got = {(r.a, r.b) for r in all_pairs(*similar_sets(df, tokens(F.col("text")), 0.8)).collect()}
    assert got == {(i, i + 1) for i in range(0, 80, 2)} | {(100, 101)}
    assert {r.ord: r.verdict for r in hybrid_verdicts(df).filter("ord >= 100").collect()} == {100: "unique", 101: "near"}


def test_fuzzy_pairs_with_an_edit_at_the_front(spark):
    rows = [(1, "frozen attic at the back entrance"), (2, "frozen selfie at the back entrance"), (3, "rozen attic at the back entrance"), (4, "other words"), (5, "a"), (6, "b")]
    assert {(r.a, r.b) for r in fuzzy_pairs(spark.createDataFrame(rows, "id long, t string")).collect()} == {(1, 2), (1, 3)}


def test_knn_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    v = rng.normal(size=(60, 8))
    df = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v)], "id long, embedding array<double>")
    got = {(r.q, r.id) for r in knn(df, df.filter("id % 10 = 0"), 3, -9.0).collect()}
    s = v @ v.T
    want = {(q, int(j)) for q in range(0, 60, 10) for j in sorted((j for j in range(60) if j != q), key=lambda j: (-s[q, j], j))[:3]}
    assert got == want


def test_chunks(spark):
    f = lambda w: F.transform(chunk_tokens(w, 4, 1), lambda c: F.array_join(c, " "))
    assert one(spark, list("abcdefg"), f, "array<string>") == ["a b c d", "d e f g", "g"]
    assert one(spark, list("abc"), f, "array<string>") == ["a b c"]
    assert one(spark, [], f, "array<string>") == []


def test_breaker_opens_and_recovers(spark):
    rows = [(1, i, float(i), False) for i in range(5)] + [(1, 5, 10.0, True), (1, 6, 70.0, True), (1, 7, 71.0, True), (1, 8, 72.0, True)]
    got = [r.state for r in replay_breaker(spark.createDataFrame(rows, "key long, seq long, ts_s double, ok boolean")).orderBy("seq").collect()]
    assert got == ["closed"] * 4 + ["open", "open", "half_open", "half_open", "closed"]
