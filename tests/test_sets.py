"""The packed joins against brute force, and what they keep on disk."""

import numpy as np
from pyspark.sql import functions as F

from millrace.operators import dedup, edits, sets


def test_pairs_of_all_levels_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for size in (1, 2, 5, 40, 220, 255, 270, 900, 1100, 4200):
        for _ in range(2):
            base = rng.integers(0, 1 << 40, size)
            for cut in (0, 0.05, 0.1, 0.18, 0.25):
                k = int(size * cut)
                rows.append((len(rows), [int(x) for x in base[k:]] + [int(x) for x in rng.integers(0, 1 << 40, k // 3)]))
    df = spark.createDataFrame(rows, "ord long, w array<long>")
    for threshold in (0.8, 0.85):
        member, links = dedup.similar_sets(df, F.array_distinct("w"), threshold)
        got = {(r.a, r.b) for r in dedup.all_pairs(member, links).collect()}
        s = [set(w) for _, w in rows]
        want = {(i, j) for j in range(len(s)) for i in range(j) if len(s[i] & s[j]) / len(s[i] | s[j]) >= threshold}
        assert got == want and len(want) > 40


def test_no_checkpoint_has_a_row_for_each_part(spark, monkeypatch):
    most, cut = [], dedup.cut_lineage
    for m in (dedup, sets):
        monkeypatch.setattr(m, "cut_lineage", lambda df: [d := cut(df), most.append(d.count())][0])
    df = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(60)) + " and some more words in common") for i in range(100)], "ord long, text string")
    assert dedup.hybrid_verdicts(df).filter("verdict = 'unique'").count() == 100
    assert dedup.all_pairs(*dedup.similar_sets(df, dedup.tokens(F.col("text")), 0.8)).count() == 0
    assert max(most) <= 100 + 16 * spark.sparkContext.defaultParallelism


def test_strings_against_brute_force_and_without_rows_of_grams(spark, monkeypatch):
    rng = np.random.default_rng(6)
    most, cut = [], dedup.cut_lineage
    monkeypatch.setattr(dedup, "cut_lineage", lambda df: [d := cut(df), most.append(d.count())][0])
    texts = ["", "a", "b", "ab", "一二三四五六七", "一二三四五六八"]
    for k in range(60):
        base = "".join(rng.choice(list("abcdefgh "), int(rng.integers(8, 90))))
        for _ in range(4):
            t = list(base)
            for _ in range(int(rng.integers(0, len(t) // 4))):
                at = int(rng.integers(0, len(t)))
                t[at] = ("", "x", t[at] + "y")[int(rng.integers(0, 3))]
            texts.append("".join(t))
    df = spark.createDataFrame(list(enumerate(dict.fromkeys(texts))), "id long, t string")
    monkeypatch.setattr(edits, "BLOCK", 50)
    for threshold in (0.75, 0.85):
        x, y = (df.select(F.col("id").alias(s), F.col("t").alias(f"t{s}")) for s in ("a", "b"))
        sim = 1 - F.levenshtein("ta", "tb") / F.greatest(F.length("ta"), F.length("tb"))
        want = {(r.a, r.b) for r in x.crossJoin(y).filter((F.col("a") < F.col("b")) & (sim >= threshold)).collect()}
        assert {(r.a, r.b) for r in dedup.fuzzy_pairs(df, threshold).collect()} == want and len(want) > 40
    assert max(most, default=0) <= df.count()
