"""Problem 6: the language of each document and of each line of a mixed document, with a confidence.

Segmentation-marginalised unigrams: each language has probabilities over the pieces of a fixed public vocabulary. The
probability of a word is the sum over all its segmentations into pieces, by a forward algorithm over character
positions; piece probabilities are fitted by expectation maximisation (forward-backward expected counts) to the clean
reference texts, a fixed table of 480 rows that alone is collected. A line's score adds the words outside quotations.

Scale: scoring is one map over the texts, in which each distinct word of a batch stream is scored once; only a code and
a margin per line leave it. The main body comes from the site style tree (p01) as flags joined by id, never as text.
"""

from __future__ import annotations

import math
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources import table

VOCABULARY = os.path.join(os.environ.get("MILLRACE_TOKENIZERS", "/opt/tokenizers"), "piece_bpe_32k.model")
ROUNDS = 3
SMOOTH = 0.01
MIN_LINE = 30
#: A line is of another language than its document's only by more than so many nats.
MARGIN = 6.0
MAX_PIECE = 16
#: Distinct words whose scores a worker keeps; beyond, it starts a new store (a cache only).
STORE = 200_000

# The languages and the three-letter codes and English names by which labels may name them.
LANGS = ("en", "de", "fr", "es", "pt", "it", "ru", "zh", "ja", "ar", "hi", "th")
THREE = "eng deu fra spa por ita rus zho jpn ara hin tha".split()
THREE_OLD = {"ger": "de", "fre": "fr", "chi": "zh", "cmn": "zh"}
NAMES = "english german french spanish portuguese italian russian chinese japanese arabic hindi thai".split()

_WORD = re.compile(r"[^\s\d!-/:-@\[-`{-~¡¿§©«»“”„‘’…–—·•。，、！？：；（）「」『』《》।؟،؛]+")
_QUOTED = re.compile(r"“[^“”]*”|«[^«»]*»|„[^„“”]*[“”]|\"[^\"]*\"|「[^「」]*」|『[^『』]*』|《[^《》]*》")


def label_code(label: Column) -> Column:
    """The code that a label names in any form (case, region, three letters, English name); '' for none of ours."""
    base = F.regexp_extract(F.lower(F.trim(F.coalesce(label, F.lit("")))), r"^([a-z]+)", 1)
    pairs = {**{x: x for x in LANGS}, **dict(zip(THREE, LANGS, strict=True)), **dict(zip(NAMES, LANGS, strict=True)), **THREE_OLD}
    known = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return F.coalesce(F.try_element_at(known, base), F.lit(""))


def load_vocabulary(path: str = VOCABULARY) -> list[str]:
    """The pieces of a sentencepiece model, without its control and byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]


def words_of(line: str) -> list[str]:
    """Lower-case letter runs outside of quotations, unless the quotations are most of the line."""
    rest = _QUOTED.sub(" ", line)
    return _WORD.findall((rest if 2 * len(rest) >= len(line) else line).lower())


class Unigrams:
    """Per-language piece probabilities and the forward algorithm over all segmentations of a word."""

    def __init__(self, pieces: list[str]):
        self.index: dict[str, int] = {}
        for p in pieces:
            p = p.lower()
            if len(p) <= MAX_PIECE:
                self.index.setdefault(p, len(self.index))
        self.prob = np.full((len(self.index), len(LANGS)), 1.0 / len(self.index))
        self.other = np.full(len(LANGS), 1.0 / len(self.index))  # a character that no piece holds

    def _edges(self, w: str) -> list[list[tuple[int, int]]]:
        """For each end position the pieces that end there, as (start, piece); -1 is a character without a piece."""
        get = self.index.get
        out: list[list[tuple[int, int]]] = [[]]
        for j in range(1, len(w) + 1):
            e = [(i, p) for i in range(max(0, j - MAX_PIECE), j) if (p := get(w[i:j])) is not None]
            if not any(i == j - 1 for i, _ in e):
                e.append((j - 1, -1))
            out.append(e)
        return out

    def words(self, ws: list[str]) -> np.ndarray:
        """log P(word) in each language, the sum over all segmentations; words of one length are worked on together."""
        out = np.empty((len(ws), len(LANGS)))
        rows = np.vstack([self.prob, self.other, np.zeros(len(LANGS))])
        other, none = len(self.prob), len(self.prob) + 1
        get = self.index.get
        by_len: dict[int, list[int]] = {}
        for k, w in enumerate(ws):
            by_len.setdefault(len(w) + 1, []).append(k)
        for m, which in by_len.items():
            most = max(1, 100_000 // m)  # bounds the table of sums
            for at in range(0, len(which), most):
                part = which[at : at + most]
                texts = ["▁" + ws[k] for k in part]
                alpha = np.zeros((m + 1, len(part), len(LANGS)))
                alpha[0] = 1.0
                logs = np.zeros((len(part), len(LANGS)))
                for j in range(1, m + 1):
                    for size in range(1, min(MAX_PIECE, j) + 1):
                        ids = [get(t[j - size : j], none) for t in texts]
                        if size == 1:
                            ids = [other if x == none else x for x in ids]
                        elif ids.count(none) == len(ids):
                            continue
                        alpha[j] += alpha[j - size] * rows[ids]
                    if j % 16 == 0:  # keep the last window in range
                        scale = alpha[j].copy()
                        logs += np.log(scale)
                        alpha[max(0, j - MAX_PIECE) : j + 1] /= scale
                out[part] = logs + np.log(alpha[m])
        return out

    def fit(self, texts: dict[str, list[str]], rounds: int = ROUNDS) -> Unigrams:
        counts = {k: {} for k in range(len(LANGS))}
        for k, lang in enumerate(LANGS):
            for t in texts.get(lang, ()):
                for w in _WORD.findall(t.lower()):
                    counts[k][w] = counts[k].get(w, 0) + 1
        edges = {w: self._edges("▁" + w) for c in counts.values() for w in c}
        v = len(self.index)
        for _ in range(rounds):
            new = np.full((v, len(LANGS)), 0.0)
            unk = np.zeros(len(LANGS))
            for k in range(len(LANGS)):
                p, o = self.prob[:, k], self.other[k]
                for w, n in counts[k].items():
                    e = edges[w]
                    m = len(e)
                    f = [0.0] * m
                    f[0] = 1.0
                    for j in range(1, m):
                        f[j] = sum(f[i] * (p[q] if q >= 0 else o) for i, q in e[j])
                    b = [0.0] * m
                    b[-1] = 1.0
                    for j in range(m - 1, 0, -1):
                        for i, q in e[j]:
                            b[i] += b[j] * (p[q] if q >= 0 else o)
                    if f[-1] <= 0:
                        continue
                    for j in range(1, m):
                        for i, q in e[j]:
                            x = n * f[i] * (p[q] if q >= 0 else o) * b[j] / f[-1]
                            if q >= 0:
                                new[q, k] += x
                            else:
                                unk[k] += x
            total = new.sum(axis=0) + unk + SMOOTH * (v + 1)
            self.prob = (new + SMOOTH) / total
            self.other = np.minimum((unk + SMOOTH) / total, 1.0 / 50) / 50  # shared by characters outside the vocabulary
        return self


def fit_from(spark, d: str, path: str = VOCABULARY) -> Unigrams:
    rows = table(spark, d, "lang_samples").select("lang", "text").collect()  # a fixed table of 480 rows
    texts: dict[str, list[str]] = {}
    for r in rows:
        texts.setdefault(r.lang, []).append(r.text or "")
    return Unigrams(load_vocabulary(path)).fit(texts)


class Scorer:
    """Scores lines; keeps the scores of the distinct words met so far."""

    def __init__(self, model: Unigrams):
        self.model, self.ids, self.rows, self.n = model, {}, np.empty((1024, len(LANGS)), np.float32), 0

    def lines(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities (lines x languages) and numbers of letters."""
        if self.n > STORE:
            self.ids, self.n = {}, 0
        split = [words_of(x) for x in lines]
        known = self.ids
        new = [w for w in dict.fromkeys(w for ws in split for w in ws) if w not in known]
        if new:
            got = self.model.words(new)
            while self.n + len(new) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
            self.rows[self.n : self.n + len(new)] = got
            known.update(zip(new, range(self.n, self.n + len(new)), strict=True))
            self.n += len(new)
        ids = [known[w] for ws in split for w in ws]
        ends = np.cumsum([len(ws) for ws in split]).tolist()
        letters = [sum(map(len, ws)) for ws in split]
        s = np.zeros((len(ids) + 1, len(LANGS)))
        np.cumsum(self.rows[ids], axis=0, dtype=np.float64, out=s[1:]) if ids else None
        ends_a = np.array(ends)
        return s[ends_a] - s[np.concatenate([[0], ends_a[:-1]])] if ends else s[:0], np.array(letters)


def _score(shared):
    """mapInArrow: per record and line the best and second language, their margin in nats, the letters; code lines are -1."""

    def run(batches):
        # the broadcast holds plain arrays and a list, so that it can be read where only this function, by value, is known
        model = Unigrams.__new__(Unigrams)
        pieces, model.prob, model.other = shared.value
        model.index = {p: k for k, p in enumerate(pieces)}
        scorer = Scorer(model)
        # few records at a time: the words of a batch are held as strings while they are scored
        for b in (whole.slice(at, 200) for whole in batches for at in range(0, whole.num_rows, 200)):
            texts = [(t or "").split("\n") for t in b.column(1).to_pylist()]
            flat = [x for lines in texts for x in lines]
            score, letters = scorer.lines(flat)
            order = np.argsort(-score, axis=1)[:, :2]
            rows = np.arange(len(flat))
            margin = (score[rows, order[:, 0]] - score[rows, order[:, 1]]).astype(np.float32)
            best = np.where(letters > 0, order[:, 0], -2)
            cols: list[list] = [[], [], [], []]
            at = 0
            for lines, code in zip(texts, b.column(2).to_pylist(), strict=True):
                to = at + len(lines)
                shown = {x.strip() for c in code or () for x in (c or "").split("\n")} - {""}
                mine = best[at:to].tolist()
                cols[0].append([-1 if x.strip() in shown else k for x, k in zip(lines, mine, strict=True)] if shown else mine)
                cols[1].append(order[at:to, 1].tolist())
                cols[2].append(margin[at:to].tolist())
                cols[3].append([len(x.strip()) for x in lines])
                at = to
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.list_(t)) for c, t in zip(cols, (pa.int8(), pa.int8(), pa.float32(), pa.int32()), strict=True))], ["id", "best", "second", "margin", "size"])

    return run


def scored_lines(spark, docs: DataFrame, model: Unigrams) -> DataFrame:
    """docs (id, text, code array<string>) -> (id, lines array<struct<best, second, margin, size>>)."""
    shared = spark.sparkContext.broadcast((list(model.index), model.prob, model.other))  # vocabulary x languages, fixed size
    got = docs.select("id", "text", "code").mapInArrow(_score(shared), "id long, best array<byte>, second array<byte>, margin array<float>, size array<int>")
    return got.select("id", F.arrays_zip("best", "second", "margin", "size").alias("lines"))


def assign(lines: DataFrame, body: DataFrame) -> DataFrame:
    """(id, main, conf, lines array<struct<no, lang, conf, size>>): the language most of the main body is written in, by letters of
    whole lines, and the language of each main-body line except code; languages as positions in LANGS, main and conf null without
    letters (null, empty and blank texts, digits only)."""
    j = lines.join(body, "id")
    used = F.filter(F.transform("lines", lambda x, i: F.struct(i.alias("no"), x["best"].alias("best"), x["second"].alias("second"), x["margin"].alias("margin"), x["size"].alias("size"), F.coalesce(F.get("body", i), F.lit(False)).alias("in"))), lambda x: x["in"] & (x["best"] >= 0))
    j = j.select("id", used.alias("u"))
    weight = lambda k: F.aggregate("u", F.lit(0.0), lambda a, x: a + F.when(x["best"] == k, x["size"] * F.when(x["size"] >= MIN_LINE, 1.0).otherwise(0.25)).otherwise(0.0))
    per = F.array(*[F.struct(weight(k).alias("w"), F.lit(-k).alias("k")) for k in range(len(LANGS))])
    j = j.select("id", "u", per.alias("per")).withColumn("top", F.array_max("per"))
    j = j.withColumn("main", F.when(F.col("top.w") > 0, -F.col("top.k"))).withColumn("conf", F.try_divide(F.col("top.w"), F.aggregate("per", F.lit(0.0), lambda a, x: a + x["w"])))
    sure = lambda m: 1 / (1 + F.exp(-m / 4))
    lang = F.transform("u", lambda x: F.struct(x["no"].alias("no"), F.when((x["second"] == F.col("main")) & (x["margin"] < MARGIN), F.col("main")).otherwise(x["best"].cast("int")).alias("lang"), sure(x["margin"].cast("double")).alias("conf"), x["size"].alias("size")))
    return j.select("id", "main", "conf", lang.alias("lines"))


def _code_of(k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in LANGS]), k + 1)


def _assigned(spark, d: str) -> DataFrame:
    from .p01_boilerplate import extracted_body

    docs = table(spark, d, "extracted_content").select(F.col("extract_id").alias("id"), "text", F.col("code_blocks.content").alias("code"))
    return assign(scored_lines(spark, docs, fit_from(spark, d)), extracted_body(spark, d))


def _long(lines: Column) -> Column:
    return F.filter(lines, lambda x: x["size"] >= MIN_LINE)


def p6_found(spark, d: str) -> DataFrame:
    from .p07_residue import p7_found

    a = _assigned(spark, d).withColumnRenamed("id", "extract_id").filter("main IS NOT NULL")
    label = table(spark, d, "extracted_content").select("extract_id", label_code(F.col("language")).alias("label"))
    a = a.join(label, "extract_id").join(p7_found(spark, d), "extract_id", "left_anti")
    whole = F.struct(F.lit(-1).alias("no"), F.col("main").alias("lang"))
    parts = F.transform(_long(F.col("lines")), lambda x: F.struct(x["no"].alias("no"), x["lang"].alias("lang")))
    mixed = F.size(F.array_distinct(F.transform(parts, lambda x: x["lang"]))) > 1
    cases = F.concat(F.when(F.col("label") != _code_of(F.col("main")), F.array(whole)).otherwise(F.array().cast("array<struct<no:int,lang:int>>")), F.when(mixed, parts).otherwise(F.array().cast("array<struct<no:int,lang:int>>")))
    return a.select("extract_id", F.explode(cases).alias("c")).select("extract_id", F.col("c.no").cast("long").alias("line_no"), _code_of(F.col("c.lang")).alias("lang"))


def p6_languages(spark, d: str) -> DataFrame:
    """Each record's language with a confidence, the share of its main body in that language."""
    return _assigned(spark, d).select(F.col("id").alias("extract_id"), _code_of(F.col("main")).alias("lang"), F.round("conf", 6).alias("confidence"))


def p6_segments(spark, d: str) -> DataFrame:
    """Each main-body line of a mixed record with its language and confidence."""
    a = _assigned(spark, d)
    mixed = F.size(F.array_distinct(F.transform(_long(F.col("lines")), lambda x: x["lang"]))) > 1
    x = a.filter(mixed).select("id", F.explode("lines").alias("x"))
    return x.select(F.col("id").alias("extract_id"), F.col("x.no").cast("long").alias("line_no"), _code_of(F.col("x.lang")).alias("lang"), F.round("x.conf", 6).alias("confidence"))


QUERIES = {"p6_found": p6_found, "p6_languages": p6_languages, "p6_segments": p6_segments}
ORACLE: dict[str, str] = {}
