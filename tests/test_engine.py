"""Similarity, state, store and dataset operators on small fixtures, with nulls, ties, repeated rows and empty tables."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import facts
from millrace.operators import build, confidence, health, similar, tiers
from millrace.operators.dataset import DatasetConfig


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("r")).first().r


def test_ratios_and_overlaps(spark):
    assert similar.ratio("kitten", "sitting") == pytest.approx(8 / 13) and similar.ratio("", "") == 1.0
    assert similar.partial_ratio("abc", "xxabcxx") == similar.token_sort_ratio("b a", "a b") == similar.token_set_ratio("a b", "a b c") == 1.0
    assert similar.band_choice(0.85) == (8, 16) and similar.band_choice(0.5) == (25, 5)
    df = spark.createDataFrame([("ab c", "c ab"), (None, "")], "a string, b string")
    assert [r.s for r in df.select(similar.string_similarity(F.col("a"), F.col("b"), "token_sort_ratio").alias("s")).collect()] == [1.0, 1.0]
    with pytest.raises(ValueError):
        similar.string_similarity(F.col("a"), F.col("b"), "none")
    part = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "before " + part + " after"), (2, "nothing shared"), (3, None)], "id long, text string")
    got = similar.partial_overlaps(docs, spark.createDataFrame([(9, "xx " + part)], "q long, text string")).collect()
    assert [(r.q, r.id) for r in got] == [(9, 1)] and got[0].end - got[0].start >= len(part)


def test_levels_and_clusters(spark):
    base = " ".join(f"word{i}" for i in range(60))
    rows = [(1, base, "general"), (2, base, "general"), (3, base + " more", "general"), (4, "the quick brown fox jumps over it", "general"), (5, "the quick brown fix jumps over it", "general"), (6, "entirely other words", "legal"), (7, None, None), (8, "", "general")]
    df = spark.createDataFrame(rows, "ord long, text string, kind string")
    got = {r.ord: r.level for r in similar.multi_level(df).collect()}
    assert (got[1], got[2], got[3], got[5], got[6]) == ("none", "exact", "fuzzy", "fuzzy", "none") and len(got) == 8
    assert similar.legacy_verdict(similar.multi_level(df)).filter("is_duplicate").count() == sum(v != "none" for v in got.values())
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101)], "a long, b long")
    assert {r.id: r.cluster for r in similar.components(links).collect()} == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}
    assert similar.components(links.limit(0)).count() == 0


def test_bloom_has_no_false_negatives(spark):
    h = np.random.default_rng(0).integers(-(1 << 62), 1 << 62, 20000)
    f = similar.BloomFilter(10_000, 0.01).add(h[:10000])
    assert f.has(h[:10000]).all() and f.has(h[10000:]).mean() < 0.03
    bits = similar.build_bloom(spark.createDataFrame([(int(x),) for x in h[:500]], "h long"), 1000)
    assert similar.BloomFilter(1000, 0.001, bits).has(h[:500]).all()


def test_replays(spark):
    rows = [(1, i, float(i), i not in (0, 1, 2), float(i)) for i in range(4)] + [(1, 9, 200.0, True, None), (2, 0, 0.0, False, 1.0)]
    e = spark.createDataFrame(rows, "key long, seq long, ts_s double, ok boolean, value double")
    got = {(r.key, r.seq): (r.blocked, r.failures) for r in health.replay_cooldown(e).collect()}
    assert got[1, 2] == (False, 3) and got[1, 3] == (True, 0) and got[1, 9] == (False, 0) and got[2, 0] == (False, 1)
    lim = health.replay_limiter(spark.createDataFrame([(1, i, float(i), True) for i in range(12)], "key long, seq long, ts_s double, ok boolean")).orderBy("seq").collect()
    assert [r.allowed for r in lim][:5] == [True] * 5 and not lim[5].allowed
    assert health.replay_rate(e.limit(0)).count() == 0
    assert {r.seq: r.mean for r in health.replay_mean(e.filter("key = 1")).collect()}[9] == pytest.approx(0.9 * (0.9 * (0.9 * 0 + 0.1) + 0.2) + 0.3)


def test_letters_and_actions(spark):
    t = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([("u", "s", 1, t, t, "a")], "url string, stage string, n long, first_ts timestamp, last_ts timestamp, error string")
    new = spark.createDataFrame([("u", "s", 1, t + dt.timedelta(1), t + dt.timedelta(1), "b"), ("v", "s", 1, t, t, None)], old.schema)
    got = {r.url: (r.n, r.error) for r in health.merge_letters(old, new, ["url", "stage"]).collect()}
    assert got == {"u": (2, "b"), "v": (1, None)}
    assert one(spark, "CUDA out of memory", health.action_of) == "halve_batch" and one(spark, None, health.action_of) == "log"
    assert spark.range(1).select(health.retry_eligible(F.lit(1), F.lit(t), F.lit("critical"), F.lit(True), F.lit(t)).alias("r")).first().r is False


def test_store_round_trip(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", "x", "http://s/1", "www.S.test", 0.9, t), ("b", None, "http://s/2", None, None, t + dt.timedelta(1)), ("a", "x", "http://s/1", "s.test", 0.9, t)]
    df = spark.createDataFrame(rows, "content_id string, text string, url string, domain string, quality_score double, processed_at timestamp")
    tiers.store_contents(df, str(tmp_path / "s"))
    meta, text = spark.read.parquet(str(tmp_path / "s/meta")), spark.read.parquet(str(tmp_path / "s/text"))
    assert [r.content_id for r in tiers.query_contents(meta, text, "s.test", 0.5).collect()] == ["a", "a"]
    assert tiers.remove_ids(meta, df.filter("content_id = 'a'"), "content_id").count() == 1
    tiers.compact(spark, str(tmp_path / "s/text"), str(tmp_path / "b"), 1)
    assert spark.read.parquet(str(tmp_path / "b")).count() == 3
    c = tiers.Checkpoint("job/1", remaining=["u"])
    assert tiers.Checkpoint.load(c.save(str(tmp_path / "c"))) == c
    audit = spark.createDataFrame([(t, "u", "read", "r", {"api_key": "abcdefgh", "n": "1"})], tiers.AUDIT)
    tiers.append_audit(audit, str(tmp_path / "audit"))
    assert tiers.user_activity(spark, str(tmp_path / "audit"), "u", "2024-01-01", "2024-01-02").first().details == {"api_key": "ab***gh", "n": "1"}
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n{broken\n\n')
    v = tiers.validate_files(tiers.read_lines(spark, str(tmp_path / "l.jsonl"))).first()
    assert (v.records, v.bad) == (2, 1)


def test_gates_and_agents(spark):
    u = spark.createDataFrame([(f"https://s/{i}", "s") for i in range(300)] + [("http://t/private/x", "t")], "url string, netloc string")
    rules = spark.createDataFrame([("t", ["/private"]), ("s", [""])], "netloc string, disallow array<string>")
    assert [r.url for r in tiers.robots_allow(u, rules).filter("NOT allowed").collect()] == ["http://t/private/x"]
    a = tiers.assign_agent(u, {"chrome": ["c1", "c2"], "other": ["o"]}, {"chrome": 0.7, "none": 0.2, "other": 0.1})
    n = {r.agent: r["count"] for r in a.groupBy("agent").count().collect()}
    assert set(n) == {"c1", "c2", "o"} and n["o"] < 90
    assert tiers.assign_proxy(u, ["http://p1", "https://p2"]).filter("proxy = 'https://p2'").count() == 300


def test_samples_and_orders(spark):
    d = spark.createDataFrame([(i, "a" if i < 90 else "b", i / 100) for i in range(100)], "id long, stratum string, score double")
    s = build.rejection_sample(d, {"a": 0.5, "b": 0.5}, 40)
    n = {r.stratum: (r["count"], r.m) for r in s.groupBy("stratum").agg(F.count("*").alias("count"), F.avg("score").alias("m")).collect()}
    assert n["a"][0] == 20 and n["b"][0] == 10 and n["a"][1] > 0.445
    order = [r.id for r in build.curriculum(s).orderBy("position").collect()]
    assert order == sorted(order) and build.rejection_sample(d.limit(0), None, 10).count() == 0
    with pytest.raises(ValueError):
        build.training_rows(d, "none")
    docs = spark.createDataFrame([(1, "w " * 700, "en", "g", 700, 0.9), (2, None, "en", "g", 0, 0.9)], "id long, text string, lang string, domain string, words int, score double")
    x = build.create_dataset(docs, DatasetConfig(), "instruction")
    assert x.count() == 2 and '"documents": 1' in build.report(x) and "empty" in build.report(x.limit(0))


def test_run_and_resume(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    body = "The harbour is a place with many ships and the people of the town like to walk there in the evening when the lights are on. " * 5
    rows = [("a", t, "http://s/1", bytearray(f"<p>{body}</p>".encode())), ("a", t + dt.timedelta(1), "http://s/1", bytearray(f"<p>{body}</p>".encode())), ("b", t, "http://s/2", bytearray(f"<p>{body}</p>".encode())), ("c", t, None, None)]
    pages = spark.createDataFrame(rows, "request_id string, ts timestamp_ntz, url string, content binary")
    got = build.process(pages, build.RunConfig()).collect()
    assert len(got) == 3 and {r.request_id: r.rejected_by for r in got}["c"] == "extraction" and sum(r.rejected_by == "deduplication" for r in got) == 1
    assert build.process(pages, build.RunConfig(near_dedup=False), pages.filter("request_id != 'b'")).count() == 1
    (tmp_path / "c.json").write_text('{"min_quality": 0.5, "order": ["plain"]}')
    assert build.RunConfig.load(str(tmp_path / "c.json")).order == ("plain",)
    (tmp_path / "d.json").write_text('{"other": 1}')
    with pytest.raises(ValueError):
        build.RunConfig.load(str(tmp_path / "d.json"))


def test_facts_of_texts(spark):
    assert one(spark, "Roe v. Wade, 410 U.S. 113 (1973) and 42 U.S.C. § 1983", facts.citations).statutes[0].section == "1983"
    assert one(spark, "4.5 stars, 2 reviews and 12 reviews", facts.reviews).reviews == 12 and one(spark, None, facts.reviews).mean is None
    assert one(spark, "Only 3 left in stock", facts.stock).quantity == 3
    assert one(spark, "Weight: 5 kg, Color: red; Color: blue", facts.specifications) == {"weight": "5 kg", "color": "blue"}
    assert one(spark, "GET /a/b with Bearer Token", facts.interfaces).endpoints == ["GET /a/b"]
    assert one(spark, '<p onclick="x()">a</p><script>b</script>', facts.sanitize_html) == "<p>a</p>"
    assert one(spark, "de", facts.language_name) == "German" and one(spark, "xx", facts.language_name) == "XX"
    assert one(spark, None, facts.topics) == [] and confidence.updated_weights({"a": 0.5, "b": 0.5}, {"a": 1.5}) == {"a": 0.75, "b": 0.25}
