"""Strings within an edit distance: blocks of strings laid against each other, with bounds that lose no pair.

An edit changes the counts of at most two characters, and one insertion or deletion changes one; so two strings d edits apart, of n
and m characters, differ by at most 2 d - |n - m| in the counts of their characters, and by at most 4 d in those of their 2-grams.
Counts are compared as bits (a count as that many bits, up to four; a 2-gram turns one bit), then characters in full, before any
pair leaves its task. Strings are dealt to blocks by hash; each pair of blocks is one task's work, and no pair is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Strings of one block about, most blocks (each string is copied to as many tasks), buckets of characters, words of 2-grams, pairs looked at together.
BLOCK, MOST_BLOCKS, BUCKETS, GRAMS, HELD = 2_000, 16, 32, 4, 150_000


class _Block:
    """Strings by length, with the counts of their characters and the bits of those and of their 2-grams."""

    def __init__(self, ids: list, texts: list):
        order = sorted(range(len(ids)), key=lambda k: len(texts[k]))
        texts = [texts[k] for k in order]
        self.ids, self.texts, self.n = np.array(ids, np.int64)[order], pa.array(texts, pa.string()), np.array([len(t) for t in texts], np.int64)
        cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        own, m = np.repeat(np.arange(len(texts)), self.n), len(texts)
        self.counts = np.bincount(own * BUCKETS + cp % BUCKETS, minlength=m * BUCKETS).reshape(m, BUCKETS).astype(np.int32)
        self.chars = np.packbits((self.counts[:, :, None] > np.arange(4)).reshape(m, -1), axis=1).view(np.uint64).T.copy()
        inside = own[1:] == own[:-1]
        bit = ((cp[:-1] * 0x9E3779B1 + cp[1:] * 0x85EBCA6B) >> 7) % (64 * GRAMS)
        odd = np.bincount((own[1:] * (64 * GRAMS) + bit)[inside], minlength=m * 64 * GRAMS) & 1
        self.grams = np.packbits(odd.astype(np.uint8).reshape(m, -1), axis=1).view(np.uint64)


def _near(x: _Block, y: _Block, threshold: float):
    """(i, j, most edits) arrays of strings of the blocks that the bounds allow to be similar; within one block i comes before j."""
    at = 0
    while at < len(x.n):
        size = x.n[at]
        last = int(np.searchsorted(x.n, size, "right"))
        lo = at if x is y else int(np.searchsorted(y.n, np.ceil(size * threshold - 1e-9)))
        hi = int(np.searchsorted(y.n, np.floor(size / threshold + 1e-9), "right"))
        if hi <= lo:
            at = last
            continue
        edits = np.floor((1 - threshold) * np.maximum(size, y.n[lo:hi]) + 1e-9).astype(np.int64)
        most = 2 * edits - np.abs(y.n[lo:hi] - size)
        bits = np.clip(most, -1, 255).astype(np.int16)
        while at < last:
            to = min(last, at + max(1, HELD // (hi - lo)))
            apart = np.zeros((to - at, hi - lo), np.uint8)
            for w, v in zip(x.chars, y.chars, strict=True):
                apart += np.bitwise_count(w[at:to, None] ^ v[None, lo:hi])
            i, j = np.divmod(np.flatnonzero(apart <= bits), hi - lo)
            k, i, j = j, i + at, j + lo
            at = to
            ok = np.abs(x.counts[i] - y.counts[j]).sum(axis=1) <= most[k]
            i, j, k = i[ok], j[ok], k[ok]
            ok = np.bitwise_count(x.grams[i] ^ y.grams[j]).sum(axis=1, dtype=np.int64) <= 4 * edits[k]
            if x is y:
                ok &= i < j
            yield i[ok], j[ok], edits[k[ok]]


def _meet(threshold: float):
    def flush(rows):
        sides = [[r for r in rows if r[1] == s] for s in (False, True)]
        if not rows[0][4] and not all(sides):
            return
        x, *other = (_Block([r[2] for r in side], [r[3] for r in side]) for side in sides if side)
        y = other[0] if other else x
        for i, j, edits in _near(x, y, threshold):
            a, b, ta, tb = x.ids[i], y.ids[j], x.texts.take(pa.array(i)), y.texts.take(pa.array(j))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), ta, tb, pa.array(edits.astype(np.int32))], ["x", "y", "tx", "ty", "most"])

    def run(batches):
        key, rows = None, []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[0] != key:
                    if rows:
                        yield from flush(rows)
                    key, rows = r[0], []
                rows.append(r)
        if rows:
            yield from flush(rows)

    return run


def near_strings(strings: DataFrame, threshold: float) -> DataFrame:
    """(x, y, tx, ty, most edits) of distinct strings (id, t): among them is each pair whose Levenshtein similarity reaches ``threshold``, once."""
    blocks = min(MOST_BLOCKS, -(-strings.count() // BLOCK)) or 1
    k = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    s = strings.select(F.col("id").cast("long").alias("id"), "t", k.alias("k"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("o"))
    i, j = F.least("k", "o"), F.greatest("k", "o")
    rows = s.select((j * (j + 1) / 2 + i).cast("int").alias("pair"), (F.col("k") > F.col("o")).alias("second"), "id", "t", (i == j).alias("own"))
    return rows.repartitionById(blocks * (blocks + 1) // 2, F.col("pair")).sortWithinPartitions("pair").mapInArrow(_meet(threshold), "x long, y long, tx string, ty string, most int")
