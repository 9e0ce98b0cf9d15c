"""Sets of 8-character windows: hashes, exact candidate pairs by rare-first prefixes of the whole sets, digests.

Two texts are similar by the Jaccard index of their sets of distinct 8-character windows of the canonical text, at least
NUM / DEN. Candidates lose no similar pair. All possible windows are dealt to parts by hash; a pair that reaches the
threshold reaches it in at least one part (a ratio of sums is at most the largest ratio), so each part is joined by
itself. In a part the windows of a text are put into one global order, and of two sets of n and m windows that share at
least o = NUM (n + m) / (NUM + DEN) the first n - o + l and m - o + l share at least l, whatever the order is. The order is
for speed only: windows come by how often their hash bucket is met in all texts, rare first.
Sizes are numbers of distinct windows, so repeated text counts once. What passes is verified on all windows.

Scale: one task joins one slot, which is a part. Parts grow with the index up to MOST_PARTS, and no further than leaves a text
of usual length THIN windows in each, as the l that is asked for shrinks with them. Of a slot beyond SLOT listed windows the texts
are put into blocks in a temporary file, and two blocks at a time are met: all windows of a text in the part stay together, so what
a pair must share is the same at any size. The meetings of one part are worked on in blocks of HELD.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 8
#: The similarity two texts need, as a fraction of integers so that the bound itself is exact.
NUM, DEN = 7, 10
#: Bits of the table of hash buckets that keeps how often they are met, and bits of the blocks in which tables are added up.
TABLE_BITS, BLOCK_BITS = 22, 18
#: Least and most parts of the windows, windows of a usual text in one part at least, listed windows of one slot that are held at once, and meetings of them looked at together.
LEAST_PARTS, MOST_PARTS, THIN = 8, 32, 24
SLOT = 5_000_000
HELD = 3_000_000

_M1, _M2, _M4 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xA0761D6478BD642F)


def canonical(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def window_hashes(canon: str) -> np.ndarray:
    """64-bit hash of each 8-character window of a canonical text, in order; empty below 8 characters. A sum of the characters by
    fixed odd factors, made by doubling the width three times, then mixed."""
    h = np.frombuffer(canon.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if len(h) < WIDTH:
        return np.zeros(0, np.uint64)
    h = h[:-1] * _M1 + h[1:]
    h = h[:-2] * _M2 + h[2:]
    h = h[:-4] * _M4 + h[4:]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(27))


def _distinct(h: np.ndarray) -> np.ndarray:
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else h


def window_set(canon: str) -> np.ndarray:
    return _distinct(window_hashes(canon))


def similarity(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(intersection, union) of two window sets."""
    if len(a) > len(b):
        a, b = b, a
    i = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()) if len(a) else 0
    return i, len(a) + len(b) - i


def _shared(n):
    """The number l of shared listed windows that a pair needs whose smaller set has n windows in the part."""
    return np.where(n < 6, 1, 2 + n // 16)


def _listed(n):
    """How many windows of a set of n are listed: enough for any similar set."""
    return np.where(n > 0, n - -(-NUM * n // DEN) + _shared(n), 0)


def _early(n):
    """How many of them count where the set is the smaller of a pair: it must share 2 NUM / (NUM + DEN) of its windows at least."""
    return n + _shared(n) - -(-2 * NUM * n // (NUM + DEN))


def _count(batches):
    """The table of how often each bucket is met in the texts of a partition, in compressed blocks."""
    table = np.zeros(1 << TABLE_BITS, np.uint32)
    for b in batches:
        for at in range(0, b.num_rows, 200):  # bounds what is held at once
            canon = [canonical(t) for t in b.column(0).slice(at, 200).to_pylist()]
            h = window_hashes("\0".join(canon))
            inside = np.ones(len(h), bool)
            between = np.cumsum([len(c) + 1 for c in canon])[:-1, None] - 1 - np.arange(WIDTH)
            inside[between[(between >= 0) & (between < len(h))]] = False
            np.add.at(table, (h[inside] >> np.uint64(64 - TABLE_BITS)).astype(np.int64), np.uint32(1))
    for k, x in enumerate(table.reshape(-1, 1 << BLOCK_BITS)):
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(x.tobytes(), 1)], pa.binary())], ["block", "table"])


def _classes(base: int):
    def run(batches):
        total: dict = {}
        for b in batches:
            for k, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(zlib.decompress(x), np.uint32).astype(np.int64)
        for k, x in total.items():
            classes = np.clip(np.floor(2 * np.log2(np.maximum(x, 1))) - base, 0, 15).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([classes.tobytes()], pa.binary())], ["block", "table"])

    return run


def window_order(texts: DataFrame) -> bytes:
    """For each bucket of the hashes' leading TABLE_BITS bits the class, 0 to 15, of how often its windows are met in all texts (text):
    half steps of the logarithm, the last one from about a hundredth of the texts on. A table of fixed size; one is shuffled for each core."""
    base = max(0, int(2 * np.log2(max(1, texts.count() / 100))) - 15)
    schema = "block int, table binary"
    counted = texts.select("text").coalesce(max(1, texts.sparkSession.sparkContext.defaultParallelism)).mapInArrow(_count, schema)
    blocks = dict(tuple(r) for r in counted.repartition("block").mapInArrow(_classes(base), schema).collect())  # the table
    empty = bytes(1 << BLOCK_BITS)
    return b"".join(bytes(blocks.get(k, empty)) for k in range(1 << (TABLE_BITS - BLOCK_BITS)))


def prefixes(canon: str, table: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a text the listed windows by part and order, and for each part how many are listed and how many there are.

    A window is kept as part (8 bits), class of its bucket (4) and its hash (52) in one number, so that one sort gives parts and order."""
    h = window_hashes(canon)
    key = _distinct((h % np.uint64(parts) << np.uint64(56)) | (table[(h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(52)) | (h >> np.uint64(12)))
    n = np.diff(np.concatenate((np.searchsorted(key, np.arange(parts, dtype=np.uint64) << np.uint64(56)), [len(key)])))
    k = _listed(n)
    at = np.repeat(np.cumsum(n) - n - (np.cumsum(k) - k), k) + np.arange(k.sum())
    return key[at], k, n


def _sign(least: int):
    def run(batches):
        for b in batches:
            ids, seqs, digests = [], [], []
            for i, q, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                c = canonical(text)
                if len(c) >= least:
                    ids.append(i)
                    seqs.append(q)
                    digests.append(hashlib.md5(c.encode("utf-8", "surrogatepass")).digest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(seqs, pa.int64()), pa.array(digests, pa.binary())], ["id", "seq", "digest"])

    return run


def sign(docs: DataFrame, least: int = 1) -> DataFrame:
    """docs (id, seq, text) with canonical texts of at least ``least`` characters -> (id, seq, digest); one pass, no shuffle."""
    return docs.select("id", "seq", "text").mapInArrow(_sign(least), "id long, seq long, digest binary")


#: One row for each slot (part, or split of one) and some texts: 32 bits of each listed window, text by text in their order, and of
#: each text how many are listed and how many of them are early, the number of its windows in the part, its id and its order.
PACKED = "slot int, tokens binary, listed binary, early binary, sizes binary, ids binary, seqs binary"
_NAMES = [c.split()[0] for c in PACKED.split(", ")]


def _pack(order, parts: int, splits: int = 1):
    slots = parts * splits

    def rows(ids, seqs, texts, table):
        got = [prefixes(canonical(t), table, parts) for t in texts]
        key, listed, sizes = np.concatenate([g[0] for g in got]), np.stack([g[1] for g in got]), np.stack([g[2] for g in got])
        n = len(got)
        part = (key >> np.uint64(56)).astype(np.int64)
        flat = listed.ravel()
        early = np.arange(len(key)) - np.repeat(np.cumsum(flat) - flat, flat) < np.repeat(np.where(sizes > 0, _early(sizes), 0).ravel(), flat)
        slot = part * splits + ((key >> np.uint64(32)) & np.uint64(0xFFFFF)).astype(np.int64) % splits
        own = slot * n + np.repeat(np.arange(n), listed.sum(axis=1))
        per, per_early = (np.bincount(x, minlength=slots * n).reshape(slots, n).astype(np.int32) for x in (own, own[early]))
        o = np.argsort(slot, kind="stable")
        tok = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)[o]
        ends = np.concatenate(([0], np.cumsum(per.sum(axis=1))))
        for s in range(slots):
            has = per[s] > 0
            if has.any():
                row = (tok[ends[s] : ends[s + 1]], per[s][has], per_early[s][has], sizes[has, s // splits].astype(np.int32), ids[has], seqs[has])
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in row)], _NAMES)

    def run(batches):
        table = np.frombuffer(order.value, np.uint8)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):  # bounds what is held at once
                b = whole.slice(at, 1000)
                yield from rows(*(np.array(b.column(k).to_pylist(), np.int64) for k in (0, 1)), b.column(2).to_pylist(), table)

    return run


def build_index(texts: DataFrame, order, parts: int) -> DataFrame:
    """PACKED listed windows of texts (id, seq, text). ``order``: a broadcast of a ``window_order`` as bytes; it and the number of
    ``parts`` stay with an index."""
    return texts.select("id", "seq", "text").mapInArrow(_pack(order, parts), PACKED)


def index_parts(texts: DataFrame) -> int:
    """Parts of an index over texts (text), so that a slot holds about SLOT listed windows, or more where parts would become too thin."""
    chars, n = texts.agg(F.sum(F.length("text")), F.count("text")).first()
    slots = -(-(chars or 0) * (DEN - NUM) // (DEN * SLOT))
    return max(LEAST_PARTS, min(MOST_PARTS, slots, (chars or 0) // max(1, n) // THIN))


def _cuts(work: np.ndarray, most: int = HELD) -> list[tuple[int, int]]:
    """Ranges of items with about ``most`` units of work each, at least one item each."""
    total, out, at = np.cumsum(work), [], 0
    while at < len(work):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        out.append((at, to))
        at = to
    return out


def _meet(rows: list, splits: int = 1, others: list | None = None):
    """(a, b) arrays of the texts of one slot, or of one in ``rows`` and one in ``others``, that share enough listed windows; a is
    the earlier by (seq, id), and not both are history (seq below 0). In a split of a part less can be asked for; ``candidates``
    has whole parts only."""
    mine, rows = sum(len(r[2]) for r in rows) // 4, rows + (others or [])
    tok, listed, early, n, ids, seqs = (np.concatenate([np.frombuffer(r[k], t) for r in rows]) for k, t in ((1, np.uint32), (2, np.int32), (3, np.int32), (4, np.int32), (5, np.int64), (6, np.int64)))
    n = n.astype(np.int64)
    start = np.cumsum(listed) - listed
    # texts by size and id, so that of a pair the same one always comes first in a list
    turn = np.lexsort((ids, n))
    place = np.empty(len(ids), np.uint64)
    place[turn] = np.arange(len(ids), dtype=np.uint64)
    first = np.arange(len(tok)) - np.repeat(start, listed) < np.repeat(early, listed)
    # a list entry in one number: window, text, early or not
    key = (tok.astype(np.uint64) << np.uint64(32)) | (np.repeat(place, listed) << np.uint64(1)) | first
    key.sort()
    n, ids, seqs, start, listed, left = n[turn], ids[turn], seqs[turn], start[turn], listed[turn], turn < mine
    # a list is met up to the last text whose size fits
    far = np.searchsorted(n, n * DEN // NUM, "right").astype(np.uint64)
    need = -(-_shared(n) // splits)
    text_of = lambda k: ((k >> np.uint64(1)) & np.uint64(0x7FFFFFFF)).astype(np.int64)
    is_early = (key & np.uint64(1)).astype(bool)
    if others is None:
        is_new = (seqs >= 0)[text_of(key)]
        asks = [(key[is_early], key)] if is_new.all() else [(key[is_new & is_early], key), (key[~is_new & is_early], key[is_new])]
    else:
        is_left = left[text_of(key)]
        asks = [(key[is_left & is_early], key[~is_left]), (key[~is_left & is_early], key[is_left])]
    entries = key >> np.uint64(1)

    def enough_listed(a, b):
        """Of all listed windows, beyond the early ones, a pair of such sizes must share so many."""
        least = np.minimum(listed[a] - n[a], listed[b] - n[b]) - (-NUM * (n[a] + n[b]) // (NUM + DEN))
        k = listed[a]
        own = tok[np.repeat(start[a] - (np.cumsum(k) - k), k) + np.arange(k.sum())].astype(np.uint64)
        want = (own << np.uint64(31)) | np.repeat(b, k).astype(np.uint64)
        met = entries[np.minimum(np.searchsorted(entries, want), len(entries) - 1)] == want
        return np.bincount(np.repeat(np.arange(len(a)), k), met, minlength=len(a)) >= least

    for ask, lists in asks:
        x = text_of(ask)
        window = ask >> np.uint64(32) << np.uint64(32)
        lo = np.searchsorted(lists, ask | np.uint64(1), "right")
        c = np.maximum(np.searchsorted(lists, window | (far[x] << np.uint64(1))) - lo, 0)
        o = np.argsort(x, kind="stable")
        x, lo, c = x[o], lo[o], c[o]
        work = np.cumsum(c)
        last = np.flatnonzero(np.concatenate((x[1:] != x[:-1], [True]))) if len(x) else x  # a text's entries stay together
        partners = ((lists >> np.uint64(1)) & np.uint64(0x7FFFFFFF)).astype(np.uint32)
        at = 0
        while at < len(x):
            to = last[min(len(last) - 1, np.searchsorted(work[last], (work[at - 1] if at else 0) + HELD))] + 1
            cc = c[at:to]
            j = np.repeat(lo[at:to] - (np.cumsum(cc) - cc), cc) + np.arange(cc.sum())
            pair = (np.repeat(x[at:to].astype(np.uint64), cc) << np.uint64(32)) | partners[j]
            at = to
            if not len(pair):
                continue
            pair.sort()
            run = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
            hits = np.diff(np.concatenate((run, [len(pair)])))
            pair = pair[run]
            a, b = (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
            enough = (hits >= need[a]) & (a != b) & ((seqs[a] >= 0) | (seqs[b] >= 0))
            a, b = a[enough], b[enough]
            if splits == 1 and len(a):
                enough = np.concatenate([enough_listed(a[k:m], b[k:m]) for k, m in _cuts(listed[a])])
                a, b = a[enough], b[enough]
            swap = (seqs[a] > seqs[b]) | ((seqs[a] == seqs[b]) & (ids[a] > ids[b]))
            yield ids[np.where(swap, b, a)], ids[np.where(swap, a, b)]


class _Slot:
    """The rows of one slot: in memory up to ``most`` listed windows, beyond that in blocks of half as many in a temporary file."""

    def __init__(self, most: int):
        self.most, self.rows, self.held, self.file, self.blocks = most, [], 0, None, []

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        self.held += len(row[1]) // 4
        if self.held > self.most:
            self._store()

    def _store(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for old in (True, False):  # history is not met with itself
            rows = [r for r in self.rows if (np.frombuffer(r[6], np.int64) < 0).all() == old]
            for lo, hi in _cuts(np.array([len(r[1]) // 4 for r in rows], np.int64), self.most // 2):
                self.blocks.append((self.file.seek(0, 2), old))
                pickle.dump(rows[lo:hi], self.file, pickle.HIGHEST_PROTOCOL)
        self.rows, self.held = [], 0

    def _load(self, k: int) -> list:
        self.file.seek(self.blocks[k][0])
        return pickle.load(self.file)

    def met(self):
        if not self.blocks:
            yield from _meet(self.rows)
            return
        self._store()
        for i, (_, old) in enumerate(self.blocks):
            own = self._load(i)
            if not old:
                yield from _meet(own)
            for j in range(i + 1, len(self.blocks)):
                if not (old and self.blocks[j][1]):
                    yield from _meet(own, others=self._load(j))
        self.file.close()


def _meet_slots(most: int):
    def flush(held):
        for a, b in held.met():
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def run(batches):
        slot, held = None, None
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[0] != slot:
                    if held:
                        yield from flush(held)
                    slot, held = r[0], _Slot(most)
                held.add(r)
        if held:
            yield from flush(held)

    return run


def candidates(index: DataFrame, parts: int) -> DataFrame:
    """Distinct pairs (a, b), a the earlier by (seq, id) and b of seq 0 or more: every similar pair is among them. One task a slot."""
    return index.repartitionById(parts, F.col("slot")).sortWithinPartitions("slot").mapInArrow(_meet_slots(SLOT), "a long, b long").distinct()


def candidates_of_slots(slots: list[DataFrame]) -> DataFrame:
    """As ``candidates``, for an index whose slots (PACKED) lie apart: each is read by one task where it lies, and nothing is shuffled but pairs."""
    met = [x.coalesce(1).mapInArrow(_meet_slots(SLOT), "a long, b long") for x in slots]
    # a union of single partitions alone is one partition, and one task would read all slots in turn
    none = slots[0].sparkSession.range(0, 0, 1, 2).select(F.col("id").alias("a"), F.col("id").alias("b"))
    return reduce(DataFrame.unionByName, met, none).distinct()
