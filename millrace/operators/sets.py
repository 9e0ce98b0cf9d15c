"""Exact similarity join of sets, packed: no row of a set's parts is ever shuffled by itself.

A pair is looked for at the level of its larger set's size; the larger, the more parts the sets are dealt to by hash. A pair that
reaches the threshold reaches it in at least one part (a ratio of sums is at most the largest ratio), so each part is joined by
itself. In a part two similar sets share one of the first n - ceil(threshold n) + 1 elements of each, of the smaller even one of its
first n - ceil(2 threshold / (1 + threshold) n) + 1 (early ones), whatever the order; rare ones come first, by how often their hash
bucket is met in all sets, for speed only.
What meets is looked at by size and by a bitmap of the set in the part, in which each element turns one bit: two sets differ in
at least as many elements as their bitmaps differ in bits. What passes is verified on the sets themselves.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans import checked_broadcast
from millrace.session import cut_lineage

#: Bits of the table of hash buckets that keeps how often they are met, and bits of the blocks in which tables are added up.
TABLE_BITS, BLOCK_BITS = 22, 18
#: Sizes up to which a level goes, each with four times the parts of the one before; words of a bitmap; listed elements of one
#: slot about, and meetings looked at together.
LEVELS, WORDS, SLOT, HELD = (256, 1024, 4096, 1 << 40), 3, 2_000_000, 150_000
#: Least length of a list whose sets are laid against each other as a matrix, and sets of one group that are verified together.
LONG, GROUP = 256, 64


def packed(v: bytes) -> np.ndarray:
    """The set of a value that is kept packed."""
    return np.frombuffer(v, np.uint64)


def _hashed(values: list) -> list[np.ndarray]:
    return [np.unique(np.asarray(v, np.int64).view(np.uint64)) for v in values]


def _sign(make: Callable, keep: bool):
    def run(batches):
        table = np.zeros(1 << TABLE_BITS, np.uint32)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):  # bounds what is held at once
                b = whole.slice(at, 500)
                sets = make(b.column(2).to_pylist())
                np.add.at(table, (np.concatenate(sets) >> np.uint64(64 - TABLE_BITS)).astype(np.int64), np.uint32(1))
                digests = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
                none = pa.nulls(len(sets), pa.binary())
                kept = pa.array([s.tobytes() for s in sets], pa.binary()) if keep else none
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(digests, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), kept, pa.nulls(len(sets), pa.int32()), none], _SIGNED)
        k = table.size >> BLOCK_BITS
        blocks = [zlib.compress(x.tobytes(), 1) for x in table.reshape(k, -1)]
        yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.string()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.array(range(k), pa.int32()), pa.array(blocks, pa.binary())], _SIGNED)

    return run


_SIGNED = ["ord", "key", "digest", "n", "v", "block", "table"]


def signed(docs: DataFrame, make: Callable | None = None) -> DataFrame:
    """docs (ord, key, v) in one pass: of each its digest and size (n 0 and no digest: an empty set), and rows (block, table) of how
    often hash buckets are met. ``make`` gives the sorted hashes of a list of values; without it v is an array of hashes, and the
    sets are kept packed. A table is made for each core."""
    d = docs.select(F.col("ord").cast("long").alias("ord"), F.col("key").cast("string").alias("key"), "v").coalesce(max(1, docs.sparkSession.sparkContext.defaultParallelism))
    return cut_lineage(d.mapInArrow(_sign(make or _hashed, make is None), "ord long, key string, digest binary, n long, v binary, block int, table binary"))


def _classes(base: int):
    def run(batches):
        total: dict = {}
        for b in batches:
            for k, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(zlib.decompress(x), np.uint32).astype(np.int64)
        for k, x in total.items():
            classes = np.clip(np.floor(4 * np.log2(np.maximum(x, 1))) - base, 0, 63).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([classes.tobytes()], pa.binary())], ["block", "table"])

    return run


def _order(signs: DataFrame, n: int) -> bytes:
    """For each bucket its class, 0 to 63, of how often it is met: quarter steps of the logarithm, the last one from a fifth of the sets on."""
    base = max(0, int(4 * np.log2(max(1, n / 5))) - 63)
    blocks = dict(tuple(r) for r in signs.filter("block IS NOT NULL").select("block", "table").repartition("block").mapInArrow(_classes(base), "block int, table binary").collect())  # the table
    return b"".join(bytes(blocks[k]) for k in sorted(blocks))


def _listed(n: np.ndarray, threshold: float) -> np.ndarray:
    return np.where(n > 0, n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1, 0)


#: One row for each slot (part of a level, or split of one by hash) and some sets: 31 bits of each listed element and whether it is
#: early, set by set, and of each set how many are listed, its size and bitmap in the part, and its id.
_PACKED = "slot int, tokens binary, listed binary, sizes binary, maps binary, ids binary"


def _pack(order, make: Callable, threshold: float, splits: list[int]):
    def rows(ids, sets, parts, splits, slots):
        table = np.frombuffer(order.value, np.uint8)
        m, h = len(sets), np.concatenate(sets)
        own = ((h >> np.uint64(4)) % np.uint64(parts)) * np.uint64(m) + np.repeat(np.arange(m, dtype=np.uint64), [len(s) for s in sets])
        # part and set, class, and 42 bits of the hash in one number: one sort gives the order
        key = (own << np.uint64(48)) | (table[(h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(42)) | (h & np.uint64((1 << 42) - 1))
        key.sort()
        own = (key >> np.uint64(48)).astype(np.int64)
        n = np.bincount(own, minlength=parts * m)
        bit = ((key >> np.uint64(32)) & np.uint64(1023)).astype(np.int64) % (64 * WORDS)
        odd = np.bincount(own * (64 * WORDS) + bit, minlength=parts * m * 64 * WORDS) & 1
        maps = np.packbits(odd.astype(np.uint8).reshape(parts * m, -1), axis=1)
        k, early = _listed(n, threshold), _listed(n, 2 * threshold / (1 + threshold))
        nth = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        at = np.repeat(np.cumsum(n) - n, k) + nth
        own, key = own[at], key[at]
        slot = own // m * splits + ((key >> np.uint64(20)) & np.uint64(4095)).astype(np.int64) % splits
        entry = (slot.astype(np.uint64) << np.uint64(48)) | (own.astype(np.uint64) << np.uint64(32)) | (key & np.uint64(0xFFFFFFFE)) | (nth < early[own]).astype(np.uint64)
        entry.sort()
        slot, own, tok = (entry >> np.uint64(48)).astype(np.int64), ((entry >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.int64), entry.astype(np.uint32)
        ends = np.searchsorted(slot, np.arange(parts * splits + 1))
        for s in range(parts * splits):
            x = own[ends[s] : ends[s + 1]]
            if len(x):
                u, c = np.unique(x, return_counts=True)
                cols = (tok[ends[s] : ends[s + 1]], c.astype(np.int32), n[u].astype(np.int32), maps[u], ids[u % m])
                yield pa.RecordBatch.from_arrays([pa.array([slots + s], pa.int32()), *(pa.array([y.tobytes()], pa.binary()) for y in cols)], [c.split()[0] for c in _PACKED.split(", ")])

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):  # bounds what is held at once
                b = whole.slice(at, 1000)
                ids, sets, slots = np.array(b.column(0).to_pylist(), np.int64), make(b.column(1).to_pylist()), 0
                n = np.array([len(s) for s in sets])
                for k, most in enumerate(LEVELS):
                    # the level of a pair is that of its larger set, so the smaller may lie a little below it
                    has = np.flatnonzero((n > 0) & (n <= most) & (n >= threshold * LEVELS[k - 1] if k else True))
                    if len(has):
                        yield from rows(ids[has], [sets[i] for i in has], 4**k, splits[k], slots)
                    slots += 4**k * splits[k]

    return run


def _near(token, lo, to, maps, mine, most):
    """(i, j) arrays: of asks i the entries j after ``lo`` and before ``to`` whose bitmaps differ in no more than ``most`` bits.

    Asks of one long list are laid against it as a matrix, those of short lists are spread out together."""
    if not len(token):
        return
    starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    ends = np.concatenate((starts[1:], [len(token)]))
    wide = to[ends - 1] - lo[starts] > LONG  # sets of a list come by size, so the last one's partners end last
    long = np.zeros(len(token), bool)
    for s, e in zip(starts[wide], ends[wide], strict=True):
        long[s:e] = True
        while s < e:
            r = min(e, s + max(1, HELD // int(to[e - 1] - lo[s])))
            at, end = int(lo[s]) + 1, int(to[r - 1])
            i, j = np.divmod(np.flatnonzero(sum(np.bitwise_count(w[s:r, None] ^ v[None, at:end]) for w, v in zip(mine, maps, strict=True)) <= most[s:r, None]), end - at)
            i, j = i + s, j + at
            ok = (j > lo[i]) & (j < to[i])
            yield i[ok], j[ok]
            s = r
    asks = np.flatnonzero(~long)
    c = (to - lo - 1)[asks]
    work, at = np.cumsum(c), 0
    while at < len(asks):
        end = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + HELD, "right")))
        i, cc = asks[at:end], c[at:end]
        j = np.arange(cc.sum()) + np.repeat(lo[i] + 1 - (np.cumsum(cc) - cc), cc)
        ok = np.flatnonzero(sum(np.bitwise_count(np.repeat(w[i], cc) ^ v[j]) for w, v in zip(mine, maps, strict=True)) <= np.repeat(most[i], cc))
        yield i[np.searchsorted(np.cumsum(cc), ok, "right")], j[ok]
        at = end


def _meet(rows: list, threshold: float):
    """(a, b) arrays of the sets of one slot, a < b, that share a listed element and may be similar in the part."""
    tok, listed, n, maps, ids = (np.concatenate([np.frombuffer(r[k], t) for r in rows]) for k, t in ((1, np.uint32), (2, np.int32), (3, np.int32), (4, np.uint64), (5, np.int64)))
    turn = np.argsort(n, kind="stable")
    place = np.empty(len(n), np.uint64)
    place[turn] = np.arange(len(n), dtype=np.uint64)
    # a list entry in one number: element, set by size, early or not
    key = (tok.astype(np.uint64) >> np.uint64(1) << np.uint64(33)) | (np.repeat(place, listed) << np.uint64(1)) | (tok & np.uint32(1))
    key.sort()
    n, ids, maps = n[turn].astype(np.int64), ids[turn], np.ascontiguousarray(maps.reshape(-1, WORDS)[turn].T)
    x = ((key >> np.uint64(1)) & np.uint64(0xFFFFFFFF)).astype(np.int32)
    asks = np.flatnonzero(key & np.uint64(1))
    far = np.searchsorted(n, np.floor(n / threshold + 1e-9), "right").astype(np.uint64) << np.uint64(1)
    # a list is met from the next set up to the last one whose size fits
    c = np.maximum(np.searchsorted(key, (key[asks] >> np.uint64(33) << np.uint64(33)) | far[x[asks]]) - asks - 1, 0)
    asks, c = asks[c > 0], c[c > 0]
    own = x[asks]
    # no pair differs in more than this, whatever the larger size is
    most = np.minimum(np.floor(n[own] * (1 - threshold) / threshold + 1e-9), 255).astype(np.uint8)
    for i, j in _near(key[asks] >> np.uint64(33), asks, asks + 1 + c, maps[:, x], maps[:, own], most):
        a, b = own[i], x[j]
        both = n[a] + n[b]
        left = both - 2 * np.ceil(threshold / (1 + threshold) * both - 1e-9).astype(np.int64)
        for w in maps:
            left = left - np.bitwise_count(w[a] ^ w[b])
        a, b = a[left >= 0], b[left >= 0]
        if len(a):
            pair = np.unique((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64))
            a, b = ids[(pair >> np.uint64(32)).astype(np.int64)], ids[(pair & np.uint64(0xFFFFFFFF)).astype(np.int64)]
            yield np.minimum(a, b), np.maximum(a, b)


def _meet_slots(threshold: float):
    def flush(rows):
        for a, b in _meet(rows, threshold):
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def run(batches):
        slot, rows = None, []
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[0] != slot:
                    if rows:
                        yield from flush(rows)
                    slot, rows = r[0], []
                rows.append(r)
        if rows:
            yield from flush(rows)

    return run


def _shared(sets: list) -> Callable:
    """A function of a set's place and others' that gives the sizes of their intersections: by bits of what occurs in two sets or more,
    or one by one where these would be many."""
    flat = np.sort(np.concatenate(sets))
    more = flat[1:][flat[1:] == flat[:-1]]
    more = more[np.concatenate(([True], more[1:] != more[:-1]))] if len(more) else more
    if len(sets) < 4 or len(sets) * len(more) > 1 << 26:
        return lambda k, others: [len(np.intersect1d(sets[k], sets[p], assume_unique=True)) for p in others]
    bits = np.zeros((len(sets), -(-len(more) // 64) * 64), bool)
    for k, s in enumerate(sets):
        p = np.searchsorted(more, s)
        bits[k, p[more[np.minimum(p, len(more) - 1)] == s] if len(more) else p[:0]] = True
    words = np.packbits(bits, axis=1).view(np.uint64)
    return lambda k, others: np.bitwise_count(words[k] & words[others]).sum(axis=1) if others else []


def _verify(make: Callable, threshold: float):
    """Over rows (g, i, j, ord, v, partners) sorted by group: similar pairs. A set is made once for each group it is in."""

    def answers(rows):
        sets, at = make([r[4] for r in rows]), {r[3]: k for k, r in enumerate(rows)}
        both = _shared(sets)
        got = []
        for k, r in enumerate(rows):
            others = [at[p] for p in r[5] or ()]
            for p, n in zip(others, both(k, others), strict=True):
                share = int(n) / (len(sets[k]) + len(sets[p]) - int(n))
                if share >= threshold:
                    got.append((r[3], rows[p][3], share))
        cols = list(zip(*got, strict=True)) if got else [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(k, t) for k, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["a", "b", "jaccard"])

    def run(batches):
        key, rows = None, []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[:3] != key:
                    if rows:
                        yield answers(rows)
                    key, rows = r[:3], []
                rows.append(r)
        if rows:
            yield answers(rows)

    return run


def _verified(pairs: DataFrame, values: DataFrame, make: Callable, threshold: float) -> DataFrame:
    """Of candidate pairs those that reach the threshold. Pairs are gathered around the smallest set that one is linked to, so that a
    set travels once to each group it has candidates in; a large group is split into blocks of record pairs."""
    both = pairs.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(pairs.select(F.col("b").alias("x"), F.col("a").alias("y")))
    lead = both.groupBy("x").agg(F.least(F.min("x"), F.min("y")).alias("lead"))
    led = pairs.join(lead.select(F.col("x").alias("a"), F.col("lead").alias("la")), "a").join(lead.select(F.col("x").alias("b"), F.col("lead").alias("lb")), "b").select("a", "b", F.least("la", "lb").alias("g"))
    led = led.join(led.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "g").withColumn("parts", F.ceil(F.sqrt(F.col("n") * 2.0) / GROUP).cast("int"))
    led = led.select("g", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("i"), F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("j"), "a", "b")
    role = F.array(F.struct(F.col("a").alias("ord"), F.col("b").alias("p")), F.struct(F.col("b").alias("ord"), F.lit(None).cast("long").alias("p")))
    member = cut_lineage(led.select("g", "i", "j", F.explode(role).alias("r")).groupBy("g", "i", "j", "r.ord").agg(F.collect_list("r.p").alias("partners")))
    rows = values.join(checked_broadcast(member), "ord").select("g", "i", "j", F.col("ord").cast("long").alias("ord"), "v", "partners")
    return rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j").mapInArrow(_verify(make, threshold), "a long, b long, jaccard double")


def _unpacked(values: list) -> list[np.ndarray]:
    return [packed(v) for v in values]


def set_links(signs: DataFrame, reps: DataFrame, values: DataFrame | None, make: Callable | None, threshold: float) -> DataFrame:
    """All pairs (a, b, jaccard), a < b, of the sets of ``reps`` (ord, n) that reach the threshold. ``signs``: what ``signed`` gave;
    ``values`` (ord, v) where the sets are not kept in it."""
    values, make = (values, make) if make else (signs.filter("block IS NULL").select("ord", "v"), _unpacked)
    sc = signs.sparkSession.sparkContext
    n = F.col("n")
    at = [(n <= most) & (n >= (threshold * LEVELS[k - 1] if k else 1)) for k, most in enumerate(LEVELS)]
    count, *totals = reps.agg(F.count(F.lit(1)), *(F.coalesce(F.sum(F.when(x, n * (1 - threshold) + 4**k)), F.lit(0.0)) for k, x in enumerate(at))).first()
    splits = [max(1, math.ceil(x / (4**k * SLOT)), math.ceil(3 * sc.defaultParallelism * x / (4**k * max(1, sum(totals))))) for k, x in enumerate(totals)]
    slots = sum(4**k * x for k, x in enumerate(splits))
    order = sc.broadcast(_order(signs, count))
    mine = values.join(checked_broadcast(reps.select("ord")), "ord", "left_semi").select(F.col("ord").cast("long").alias("ord"), "v")
    index = mine.mapInArrow(_pack(order, make, threshold, splits), _PACKED)
    pairs = cut_lineage(index.repartitionById(slots, F.col("slot")).sortWithinPartitions("slot").mapInArrow(_meet_slots(threshold), "a long, b long").distinct())
    return _verified(pairs, values, make, threshold)
