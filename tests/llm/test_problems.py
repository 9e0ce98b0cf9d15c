import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm.p01_boilerplate import body_lines, page_blocks
from millrace.llm.p02_neardup import near_classes
from millrace.llm.p03_sitelines import repeated_lines, site_templates
from millrace.llm.p04_cap import cap_contributors
from millrace.llm.p05_increment import HistoryIndex, find_repeats
from millrace.llm.p06_language import LANGS, Scorer, Unigrams, assign, fit_from, scored_lines
from millrace.llm.p07_residue import is_residue, residue_records
from millrace.llm.p08_packing import Bm25, pack, pack_documents
from millrace.llm.p09_mixing import draw, fit_budget
from millrace.llm.p10_sentences import sentences
from millrace.llm.windows import canonical, similarity, window_set

SF = "/root/testdata/sf0.001"


def words(seed, n):
    r = random.Random(seed)
    return [f"{r.choice('bcdfglmnprstv')}{r.choice('aeiou')}{r.choice('bcdfglmnprstv')}{r.choice('aeiou')}{r.randint(0, 99)}" for _ in range(n)]


def variants():
    texts = {}
    for f in range(6):
        base = words(f, 120)
        texts[10 * f] = " ".join(base)
        texts[10 * f + 1] = " ".join(base[:60] + ["inserted"] + base[60:])
        texts[10 * f + 2] = " ".join(base[5:])
        texts[10 * f + 3] = "  " + " ".join(base).upper()
        texts[10 * f + 4] = " ".join(base[:50] + words(100 + f, 70))
    return texts


def test_main_body_follows_the_site_style(spark):
    page = "<html><body><nav><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></nav><div><h1>{t}</h1><div>By the news desk, 3:1{i}</div><p>{p}<p>{q}</div><footer><div>All rights reserved</div></footer></body></html>"
    rows, ext = [], []
    for i in range(12):
        t, p, q = f"Title number {words(i, 2)}", " ".join(words(i + 50, 30)) + ".", " ".join(words(i + 90, 30)) + "."
        rows.append((str(i), f"http://www.s.test/{i}", None, 200, "text/html", bytearray(page.format(t=t, p=p, q=q, i=i).encode())))
        ext.append((i, str(i), t, f"Home\nNews\n{t}\nBy the news desk, 3:1{i}\n{p}\n\n{q}\nAll rights reserved"))
    ext += [(90, "none", None, None), (91, None, "x", "")]
    crawl = spark.createDataFrame([*rows, ("bad", None, None, 500, None, None)], "request_id string, url string, final_url string, status_code int, content_type string, content binary")
    got = {r.id: r.body for r in body_lines(crawl, spark.createDataFrame(ext, "id long, request_id string, title string, text string")).collect()}
    assert got[3] == [False, False, True, False, True, None, True, False]
    assert got[90] == [None] and got[91] == [None]


def test_blocks_of_broken_markup():
    got = page_blocks("<body><p>one<p>two <a>link</a> x<ul><li><a>only</a><li>plain</ul><script>var a='<p>no</p>'</script><div>tail")
    assert [(b[2], b[3], b[4]) for b in got] == [("p", False, "one"), ("p", False, "two link x"), ("li", True, "only"), ("li", False, "plain"), ("div", False, "tail")]
    assert page_blocks("") == []
    nested = page_blocks("<body><main><div><h1>t</h1><p>x</p></div></main><div><p>y</p></div></body>")
    assert [b[0] for b in nested] == ["main/div+h1+p", "main/div+h1+p", "div+p"]


def test_near_duplicates_equal_brute_force(spark):
    texts = variants() | {900: None, 901: "", 902: "short"}
    member, links = near_classes(spark.createDataFrame(list(texts.items()), "id long, text string"))
    rep = {r.id: r.rep for r in member.collect()}
    sets = {i: window_set(canonical(t)) for i, t in texts.items() if len(canonical(t)) >= 300}
    assert set(rep) == set(sets)
    reps = sorted(set(rep.values()))
    want = {(a, b) for a in reps for b in reps if a < b and (lambda x: x[0] * 10 >= x[1] * 7)(similarity(sets[a], sets[b]))}
    assert {(r.a, r.b) for r in links.collect()} == want and want
    assert rep[3] == 0


def test_scattered_edits_at_the_threshold_are_candidates(spark):
    r, rows, sets = random.Random(5), [], {}
    for f in range(120):
        base = [r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1000)]
        edited = list(base)
        for at in range(10, 1000, 48):
            edited[at] = "0"
        for i, t in ((2 * f, "".join(base)), (2 * f + 1, "".join(edited))):
            rows.append((i, t))
            sets[i] = window_set(canonical(t))
    want = {(a, a + 1) for a in range(0, 240, 2) if (lambda x: x[0] * 10 >= x[1] * 7)(similarity(sets[a], sets[a + 1]))}
    assert len(want) > 100
    got = near_classes(spark.createDataFrame(rows, "id long, text string"))[1]
    assert {(x.a, x.b) for x in got.collect()} == want


def test_a_larger_index_has_the_same_candidates(spark, monkeypatch):
    from millrace.llm import windows as w
    from millrace.llm.p02_neardup import similar_candidates

    r, rows = random.Random(8), []
    phrases = [" ".join(words(f, 3)) for f in range(300)]
    for i in range(120):
        t = r.sample(phrases, 60)
        rows += [(2 * i, " ".join(t)), (2 * i + 1, " ".join([*t[:50], *r.sample(phrases, 3), *t[53:]]))]
    sets = {i: window_set(canonical(t)) for i, t in rows}
    want = {(a, b) for a in sets for b in sets if a < b and (lambda x: x[0] * 10 >= x[1] * 7)(similarity(sets[a], sets[b]))}
    docs = spark.createDataFrame([(i, 0, t) for i, t in rows], "id long, seq long, text string").repartition(6)
    monkeypatch.setattr(w, "LEAST_PARTS", 8)
    monkeypatch.setattr(w, "MOST_PARTS", 8)
    whole = {(x.a, x.b) for x in similar_candidates(docs).collect()}
    monkeypatch.setattr(w, "SLOT", 2000)
    parted = {(x.a, x.b) for x in similar_candidates(docs).collect()}
    assert want <= parted and parted == whole and len(want) > 100


def test_windows_are_ordered_by_counts_of_all_texts(spark):
    from millrace.llm import windows as w

    texts = [*variants().values(), None, "", "ab", " ".join(words(1, 4000)), " ".join(words(2, 4000)[2:]), " ".join(words(2, 4000))]
    n = np.zeros(1 << w.TABLE_BITS, np.int64)
    for t in texts:
        np.add.at(n, (w.window_hashes(canonical(t)) >> np.uint64(64 - w.TABLE_BITS)).astype(np.int64), 1)
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(5)
    assert (np.frombuffer(w.window_order(docs), np.uint8) == np.clip(np.floor(2 * np.log2(np.maximum(n, 1))), 0, 15)).all() and n.max() > 1


def test_slots_that_lie_apart_are_met_by_a_task_each(spark):
    from millrace.llm import windows as w

    docs = spark.createDataFrame([(i, 0, t) for i, t in variants().items()], "id long, seq long, text string")
    index = w.build_index(docs, spark.sparkContext.broadcast(bytes(1 << w.TABLE_BITS)), 8).cache()
    sc = spark.sparkContext
    sc.setJobGroup("slots apart", "")
    got = {(r.a, r.b) for r in w.candidates_of_slots([index.filter(F.col("slot") == k) for k in range(8)]).collect()}
    stages = [x for j in sc.statusTracker().getJobIdsForGroup("slots apart") for x in sc.statusTracker().getJobInfo(j).stageIds]
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert max(x.numTasks for x in map(sc.statusTracker().getStageInfo, stages) if x) >= 8
    assert got == {(r.a, r.b) for r in w.candidates(index, 8).collect()} and got


def test_a_text_given_twice_in_one_record_is_similar(spark):
    t = variants()
    got = near_classes(spark.createDataFrame([(1, t[0]), (2, f"{t[0]} {t[0]}"), (3, t[10])], "id long, text string"))[1]
    assert {(x.a, x.b) for x in got.collect()} == {(1, 2)}


def test_repeated_lines(spark):
    docs = [(i, "s.test", f"Menu {i}\nown {' '.join(w.rstrip('0123456789') for w in words(i, 5))}\n\nShare this page") for i in range(6)] + [(10 + i, "t.test", f"other {words(i, 4)}") for i in range(6)] + [(99, "", "Share this page"), (98, "s.test", None)]
    got = {(r.id, r.line_no) for r in repeated_lines(spark.createDataFrame(docs, "id long, site string, text string")).collect()}
    assert got == {(i, n) for i in range(6) for n in (0, 3)}


def test_cap_keeps_the_best(spark):
    rows = [(i, "big", None if i % 7 == 0 else (i * 37 % 11) / 10) for i in range(400)] + [(1000 + i, None, 0.5) for i in range(3)]
    df = spark.createDataFrame(rows, "id long, who string, q double")
    got = {r.id for r in cap_contributors(df, F.col("who"), "q", "id", 50).collect()}
    order = sorted((r for r in rows if r[1] == "big"), key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
    assert got == {r[0] for r in order[50:]}
    assert cap_contributors(df.limit(0), F.col("who"), "q", "id", 50).count() == 0


def test_stratified_cap_splits_by_largest_remainder(spark):
    rows = [(i, "a", "x" if i < 60 else "y" if i < 90 else "z", float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, who string, topic string, q double")
    kept = {r[0] for r in rows} - {r.id for r in cap_contributors(df, F.col("who"), "q", "id", 15, stratum=F.col("topic")).collect()}
    # 9, 4.5 and 1.5 of 15: of the equal remainders the first stratum in order gets the slot
    assert len(kept) == 15 and [sum(1 for i in kept if lo <= i < hi) for lo, hi in ((0, 60), (60, 90), (90, 100))] in ([9, 5, 1], [9, 4, 2])


def test_new_batches_against_history(spark):
    t = variants()
    hist = [(1 << 40, -1, t[0]), ((1 << 40) + 1, -1, "tiny text"), ((1 << 40) + 2, -1, "")]
    items = [(1, 1, t[1]), (2, 2, t[10]), (3, 3, t[12]), (4, 4, t[13]), (5, 5, "TINY  text"), (6, 6, None), (7, 7, t[20]), (8, 8, " ")]
    schema = "id long, seq long, text string"
    got = {r.id: r.of for r in find_repeats(spark.createDataFrame(hist, schema), spark.createDataFrame(items, schema)).collect()}
    assert got == {1: 1 << 40, 3: 2, 4: 2, 5: (1 << 40) + 1, 8: (1 << 40) + 2}


def test_two_deliveries_equal_one(spark, tmp_path):
    t = variants()
    schema = "id long, seq long, text string"
    hist = spark.createDataFrame([(1 << 40, -1, t[0]), ((1 << 40) + 1, -1, t[0]), ((1 << 40) + 2, -1, "")], schema)
    rows = [(k, k, t[x]) for k, x in enumerate((1, 10, 12, 20, 13, 22, 30, 4, 2, 30), 1)] + [(11, 11, None), (12, 12, "tiny"), (13, 13, "TINY")]
    whole = {r.id: r.of for r in find_repeats(hist, spark.createDataFrame(rows, schema)).collect()}
    index, got, accepted = HistoryIndex.create(str(tmp_path / "i"), hist), {}, hist.select("id", "text")
    for part in (rows[:4], rows[4:6], rows[6:]):
        items = spark.createDataFrame(part, schema)
        got |= {r.id: r.of for r in HistoryIndex(spark, index.folder).settle(items, accepted).collect()}
        accepted = accepted.unionByName(items.filter(~items.id.isin(*got)).select("id", "text"))
    assert got == whole and len(whole) >= 6


def test_languages_held_out(spark):
    rows = spark.read.parquet(f"{SF}/lang_samples.parquet").orderBy("sample_id").collect()
    texts = {}
    for i, r in enumerate(rows):
        if i % 4:
            texts.setdefault(r.lang, []).append(r.text)
    model = fit_from(spark, SF)
    model = Unigrams(list(model.index)).fit(texts)
    held = [r for i, r in enumerate(rows) if i % 4 == 0]
    score, _ = Scorer(model).lines([r.text for r in held])
    assert np.mean([LANGS[k] == r.lang for k, r in zip(score.argmax(axis=1), held, strict=True)]) >= 0.97


def test_a_long_run_is_scored_whole(spark):
    score, letters = Scorer(fit_from(spark, SF)).lines(["ภาษาไทย" * 60 + "これはにほんごのぶんしょうです" * 100])
    assert LANGS[score[0].argmax()] == "ja" and letters[0] > 1800


@pytest.mark.parametrize(("line", "bad"), [
    ("Hello {{ first_name }}, welcome", True), ("In the template the tag {{ name }} is replaced.", False), ("render('a', {{ b }})", False), ("A shell expands ${HOME} before anyone sees it.", False), ("港__first_name__口", True),
    ("Please enable JavaScript to view this page.", True), ("404 - Page not found", True), ("Readers often ask what a 404 reply means.", False), ("Lorem ipsum dolor sit amet, tempor magna", True), ("The harbour is quiet.", False), ("", False),
])
def test_residue_lines(line, bad):
    assert is_residue(line) is bad


def test_residue_spreads_to_near_copies(spark):
    seed = "Our servers are under maintenance, please come back in 5 minutes. We are sorry for the trouble that this causes you today"
    docs = [(1, seed, "t", None), (2, "Fine text.\nAll of it.", "t", None), (3, None, None, None), (4, "x = {{ y }}", "t", ["x = {{ y }}"]), (5, seed.replace("5", "61"), "t", [])]
    got = {r.id for r in residue_records(spark.createDataFrame(docs, "id long, text string, title string, code array<string>")).collect()}
    assert got == {1, 5}


def test_residue_variants_and_long_lines(spark):
    seed = "Our servers are under maintenance, please come back in 5 minutes. We are sorry for the trouble that this causes you today"
    far = "Your servers are under maintenance, please come back in 5 minutes. We are sorry for the trouble that this causes you today"
    long = "The harbour is quiet in the morning and the boats lie at their places. " * 5
    docs = [(1, seed, "t", None), (2, far, "t", None), (3, long + "Page not found.", "t", None), (4, long, "t", None), (5, "", "Sample page", None)]
    got = {r.id for r in residue_records(spark.createDataFrame(docs, "id long, text string, title string, code array<string>")).collect()}
    assert got == {1, 2, 3, 5}


def test_languages_of_texts_without_letters(spark):
    docs = spark.createDataFrame([(1, "12 345", None), (2, "", []), (3, None, None), (4, "The harbour is quiet and the boats are small today", None)], "id long, text string, code array<string>")
    body = spark.createDataFrame([(i, [True]) for i in range(1, 5)], "id long, body array<boolean>")
    got = {r.id: (r.main, r.conf) for r in assign(scored_lines(spark, docs, fit_from(spark, SF)), body).collect()}
    assert got[1] == got[2] == got[3] == (None, None) and LANGS[got[4][0]] == "en" and got[4][1] == 1.0


def test_long_documents_take_linear_time(spark):
    import time

    text = "One short line. And a second one here.\n\n" * 30_000
    began = time.time()
    assert sentences(spark.createDataFrame([(1, text)], "doc_id long, text string")).count() == 60_000
    assert time.time() - began < 60


def test_one_leaf_with_many_lines(spark):
    rows = [(i, "s.test", f"Alpha beta gamma {' '.join(w.rstrip('0123456789') for w in words(i, 3))}\nAlpha beta gamma same words here") for i in range(3000)]
    docs = spark.createDataFrame(rows, "id long, site string, text string")
    assert {(r.id, r.line_no) for r in repeated_lines(docs).collect()} == {(i, 1) for i in range(3000)}
    assert "alpha beta gamma <*> <*> <*>" in {r.template for r in site_templates(docs).collect()}


def test_every_query_of_the_problems_runs(spark):
    from millrace.llm import queries

    for name, query in queries.queries().items():
        assert query(spark, SF).count() >= 0, name


def test_packing_places_everything_once(spark):
    rng = np.random.default_rng(1)
    sizes = np.concatenate([rng.integers(1, 900, 300), [0, 512, 1024, 5000]])
    terms = [rng.integers(0, 400, 20).tolist() for _ in sizes]
    got = pack(sizes, Bm25(terms, [[1] * 20 for _ in sizes]), 512)
    placed = {}
    for c in got:
        assert sum(x[3] for x in c) <= 512
        for k, _, start, n in c:
            placed.setdefault(k, []).append((start, n))
    assert set(placed) == set(range(len(sizes)))
    for k, parts in placed.items():
        assert sum(n for _, n in parts) == sizes[k] and (len(parts) == 1 or sizes[k] > 512)
    assert sizes.sum() / (512 * len(got)) > 0.97
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "")], "id long, text string")
    assert pack_documents(docs, [(1, 8)]).count() == 3


def test_budgets_equal_brute_force():
    r = random.Random(3)
    for _ in range(100):
        lengths = r.sample(range(1, 40), r.randint(1, 5))
        counts = [r.randint(1, 3) for _ in lengths]
        total = sum(n * c for n, c in zip(lengths, counts, strict=True))
        budget = r.randint(0, total + 3)
        sums = {0}
        for n, c in zip(lengths, counts, strict=True):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        got = fit_budget(lengths, counts, budget)
        assert sum(n * k for n, k in zip(lengths, got, strict=True)) == max(s for s in sums if s <= budget) and all(k <= c for k, c in zip(got, counts, strict=True))


def test_index_shapes_lose_no_pair():
    import pyarrow as pa

    from millrace.llm import windows as w

    t = list(variants().values()) + ["ab", ""]
    t += [" ".join(words(f, 12)) for f in range(3)] + [" ".join([*words(f, 12), "x"]) for f in range(3)]
    sets = [window_set(canonical(x)) for x in t]
    want = {(i, j) for i in range(len(t)) for j in range(i + 1, len(t)) if (lambda x: x[1] and x[0] * 10 >= x[1] * 7)(similarity(sets[i], sets[j]))}
    order = type("B", (), {"value": bytes(1 << w.TABLE_BITS)})
    for parts, splits in ((8, 1), (8, 3), (40, 2)):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(t))), pa.array([0] * len(t)), pa.array(t)], ["id", "seq", "text"])
        slots = {}
        for b in w._pack(order, parts, splits)([batch]):
            row = [c.to_pylist()[0] for c in b.columns]
            slots.setdefault(row[0], []).append(row)
        got = {(min(a, b), max(a, b)) for rows in slots.values() for x, y in w._meet(rows, splits) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
        assert want <= got and want


def test_budgets_and_repeats(spark):
    assert fit_budget([5, 7], [2, 2], 17) in ([2, 1], [1, 1]) and sum(n * t for n, t in zip([5, 7], fit_budget([5, 7], [2, 2], 17), strict=True)) == 17
    docs = spark.createDataFrame([(i, "a" if i < 50 else "b", 10 + i % 13) for i in range(60)], "id long, source string, n_tokens long")
    targets = spark.createDataFrame([(1, "a", 0.7, 1), (1, "b", 0.3, 3), (1, "none", 0.1, 2)], "plan_id int, source string, target_share double, max_repeats int")
    rows = draw(docs, targets)[0].collect()
    assert all(r.repeats <= (1 if r.source == "a" else 3) for r in rows)
    tok = {s: sum(r.n_tokens * r.repeats for r in rows if r.source == s) for s in "ab"}
    assert abs(tok["a"] / (tok["a"] + tok["b"]) - 0.7) < 0.02


@pytest.mark.parametrize(("text", "units"), [
    ("Dr. Smith paid 3.50 in Jan. 2008. He left!", ["Dr. Smith paid 3.50 in Jan. 2008.", "He left!"]),
    ('He asked, "Why now?" and left. (It was late.) Then "We waited. No one came," said Ann.', ['He asked, "Why now?" and left.', "(It was late.)", 'Then "We waited. No one came," said Ann.']),
    ("为什么？“为什么现在？”他问道。他说：“走吧。没有人来。”走了。", ["为什么？", "“为什么现在？”他问道。", "他说：“走吧。没有人来。”", "走了。"]),
    ("Heading here\n\n1. First item\n2. Second item\n\nText that\nis wrapped.", ["Heading here", "1. First item", "2. Second item", "Text that\nis wrapped."]),
    ("क्या वह आएगा? डॉ. बाला ने कहा।", ["क्या वह आएगा?", "डॉ. बाला ने कहा।"]),
    ("Done.[3] Next one.Last one", ["Done.[3]", "Next one.", "Last one"]), ("   \n ", []), (None, []),
])
def test_sentences(spark, text, units):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = sorted((r.start_pos, r.end_pos) for r in sentences(df).collect())
    assert [text[a:b] for a, b in got] == units
