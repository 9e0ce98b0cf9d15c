"""Problem 8: documents into containers of fixed capacity with little room left.

Lexical retrieval packing: the collection is sharded by lexical likeness; each shard has a BM25 inverted index over its
documents' tokens, weighted by the document frequencies and mean length of the whole collection. The longest unused document
seeds a container, its unused neighbours by BM25 fill the window greedily, and the last gap is filled by the largest unused
documents that fit. A document longer than the capacity is cut: its full pieces fill containers of their own, its last piece
is packed like a document.

Shards are the leaves of a tree of median cuts along main directions of BM25-weighted token vectors (seeded projections to DIM
numbers), so that they are alike in content and equal in size. The tree is fitted on a sample of at most 2 SAMPLE documents;
every document is placed by it. A seed finds neighbours in its own shard only; the recall against the whole collection is
measured in the README.

Scale: texts are tokenised where they are read; token ids and counts are written once and shuffled once. A shard holds about
SHARD documents, whatever the corpus, so its index and its containers are one bounded task; a shard leaves one or two
containers open, which at SHARD documents is below one in a hundred of its room. Document frequencies are a table as long as
the vocabulary, the tree is as long as the sample; both are of fixed size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage
from millrace.sources import table

from .tokens import token_counts

SHARD = 1500
K1, B = 1.2, 0.75
#: Neighbours are sought for a seed that leaves at least SEEK of the window open, and taken while at least OPEN is.
SEEK, OPEN = 0.35, 0.15
#: Numbers of a projected document, documents sampled for the tree, and sampled documents that a leaf needs at least.
DIM, SAMPLE, LEAF = 32, 4000, 8

PLACED = "capacity_id int, container long, place int, doc_id long, part int, start_token long, n_tokens long"


def bm25_weights(tf: np.ndarray, length: float, df: np.ndarray, n: int, mean: float) -> np.ndarray:
    return np.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


class Collection:
    """Document frequencies by token id, the number of documents and their mean length, of the whole collection."""

    def __init__(self, df: np.ndarray, n: int, mean: float):
        self.df, self.n, self.mean = df, n, max(1.0, mean)

    def vector(self, terms, tfs, directions: np.ndarray) -> np.ndarray:
        """A document as DIM numbers of length 1; zeros without tokens."""
        if not len(terms):
            return np.zeros(DIM, np.float32)
        t, tf = np.asarray(terms, np.int64), np.asarray(tfs, np.float64)
        v = bm25_weights(tf, tf.sum(), self.df[t], self.n, self.mean) @ directions[t]
        return (v / max(1e-12, np.linalg.norm(v))).astype(np.float32)


def directions(vocabulary: int) -> np.ndarray:
    """A seeded direction for each token id."""
    return np.random.default_rng(8).standard_normal((vocabulary, DIM)).astype(np.float32)


def fit_tree(sample: np.ndarray, depth: int) -> list[tuple[np.ndarray, float]]:
    """Cuts (direction, median) of a full binary tree in heap order, each along the main direction of the sample below it."""
    cuts: list = []
    below = [sample]
    for _ in range(depth):
        nxt = []
        for x in below:
            if len(x) > 1:
                c = x - x.mean(axis=0)
                d = np.linalg.svd(c, full_matrices=False)[2][0] if len(x) < 4 * DIM else np.linalg.eigh(c.T @ c)[1][:, -1]
                cut = float(np.median(x @ d))
            else:
                d, cut = np.zeros(DIM, np.float32), 0.0
            cuts.append((d.astype(np.float32), cut))
            side = x @ d.astype(np.float32) > cut
            nxt += [x[~side], x[side]]
        below = nxt
    return cuts


def _shards(shared, vocabulary: int, depth: int, spread: int):
    """mapInArrow: the shard of each document by the tree; beyond the tree's depth ``spread`` parts by hash."""

    def run(batches):
        df, n, mean, d, cut = shared.value
        cuts = (np.frombuffer(d, np.float32).reshape(-1, DIM), np.frombuffer(cut, np.float64))
        whole, dirs = Collection(np.frombuffer(df, np.float64), n, mean), directions(vocabulary)
        for b in batches:
            ids = b.column(0).to_pylist()
            v = np.stack([whole.vector(t or (), f or (), dirs) for t, f in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]) if ids else np.zeros((0, DIM), np.float32)
            node = np.zeros(len(v), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + ((v * cuts[0][node]).sum(axis=1) > cuts[1][node])
            leaf = node - ((1 << depth) - 1)
            shard = leaf * spread + np.array([(i * 0x9E3779B97F4A7C15 >> 40) % spread for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), *b.columns], ["shard", "id", "n_tokens", "terms", "tfs"])

    return run


class Bm25:
    """Inverted index of one shard; a query scores all documents by the seed's distinct tokens."""

    def __init__(self, terms: list, tfs: list, whole: Collection | None = None):
        """Without the whole collection's figures those of the shard are used."""
        n = len(terms)
        lens = np.array([sum(t) for t in tfs], dtype=np.float64)
        doc = np.repeat(np.arange(n), [len(t) for t in terms])
        term = np.concatenate([np.asarray(t, np.int64) for t in terms]) if n else np.zeros(0, np.int64)
        tf = np.concatenate([np.asarray(t, np.float64) for t in tfs]) if n else np.zeros(0)
        self.vocab, inv, df = np.unique(term, return_inverse=True, return_counts=True)
        if whole is None:
            weight = bm25_weights(tf, lens[doc], df[inv], n, max(1.0, lens.mean() if n else 1.0))
        else:
            weight = bm25_weights(tf, lens[doc], whole.df[term], whole.n, whole.mean)
        order = np.argsort(inv, kind="stable")
        self.docs, self.weights, self.at = doc[order], weight[order], np.concatenate([[0], np.cumsum(df)])
        first = np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype(np.int64)
        self.of = [inv[first[k] : first[k + 1]] for k in range(n)]
        self.n = n

    def scores(self, seed: int) -> np.ndarray:
        rows = self.of[seed]
        if not len(rows):
            return np.zeros(self.n)
        lo, hi = self.at[rows], self.at[rows + 1]
        size = hi - lo
        pick = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        return np.bincount(self.docs[pick], weights=self.weights[pick], minlength=self.n)


class _BySize:
    """Unused documents by size: the largest that fits a gap."""

    def __init__(self, sizes: np.ndarray):
        self.order = np.argsort(sizes, kind="stable")
        self.sorted = sizes[self.order]
        self.prev = np.arange(len(sizes) + 1) - 1  # union-find to the next unused on the left
        self.rank = np.empty(len(sizes), np.int64)
        self.rank[self.order] = np.arange(len(sizes))

    def _left(self, k: int) -> int:
        root = k
        while root >= 0 and self.prev[root + 1] != root:
            root = self.prev[root + 1]
        while k >= 0 and k != root:
            k, self.prev[k + 1] = self.prev[k + 1], root
        return root

    def fit(self, gap: int) -> int:
        k = self._left(int(np.searchsorted(self.sorted, gap, "right")) - 1)
        return int(self.order[k]) if k >= 0 else -1

    def drop(self, doc: int) -> None:
        k = int(self.rank[doc])
        self.prev[k + 1] = k - 1


def pack(sizes: np.ndarray, index: Bm25, capacity: int) -> list[list[tuple[int, int, int, int]]]:
    """Containers as lists of (document, part, first token, tokens). Every document is placed whole unless it exceeds the capacity."""
    out: list[list[tuple[int, int, int, int]]] = []
    rest = sizes % capacity
    full = sizes // capacity
    exact = (full > 0) & (rest == 0)
    for k in np.flatnonzero(full > 0):
        out += [[(int(k), p, p * capacity, capacity)] for p in range(full[k])]
    unused = ~exact
    by_size = _BySize(rest)
    for k in np.flatnonzero(exact):
        by_size.drop(int(k))

    def item(k: int) -> tuple[int, int, int, int]:
        return (k, int(full[k]), int(full[k]) * capacity, int(rest[k]))

    while True:
        seed = by_size.fit(capacity)
        if seed < 0:
            return out
        unused[seed] = False
        by_size.drop(seed)
        window, gap = [item(seed)], capacity - int(rest[seed])
        if gap > SEEK * capacity:
            score = index.scores(seed)
            score[~unused | (rest > gap)] = 0.0
            near = np.flatnonzero(score > 0)
            for k in near[np.argsort(-score[near], kind="stable")]:
                if gap <= OPEN * capacity:
                    break
                if rest[k] <= gap:
                    window.append(item(int(k)))
                    gap -= int(rest[k])
                    unused[k] = False
                    by_size.drop(int(k))
        while (k := by_size.fit(gap)) >= 0:
            window.append(item(k))
            gap -= int(rest[k])
            unused[k] = False
            by_size.drop(k)
        out.append(window)


def _pack_shards(capacities: list[tuple[int, int]], shared):
    def one(shard: int, rows: list):
        df, n_docs, mean = shared.value[:3]
        whole = Collection(np.frombuffer(df, np.float64), n_docs, mean)
        ids = [r[1] for r in rows]
        sizes = np.array([r[2] for r in rows], dtype=np.int64)
        index = Bm25([r[3] or [] for r in rows], [r[4] or [] for r in rows], whole)
        for cid, cap in capacities:
            cols: list[list] = [[] for _ in range(6)]
            for c, window in enumerate(pack(sizes, index, cap)):
                for place, (k, part, start, n) in enumerate(window):
                    for col, v in zip(cols, ((shard << 32) + c, place, ids[k], part, start, n), strict=True):
                        col.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([cid] * len(cols[0]), pa.int32()), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], ["capacity_id", "container", "place", "doc_id", "part", "start_token", "n_tokens"])

    def run(batches):
        shard, rows = None, []
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[0] != shard:
                    if rows:
                        yield from one(shard, rows)
                    shard, rows = r[0], []
                rows.append(r)
        if rows:
            yield from one(shard, rows)

    return run


def pack_documents(docs: DataFrame, capacities: list[tuple[int, int]], shard: int = SHARD) -> DataFrame:
    """PLACED for docs (id, text): container and place of each document, or of each piece of one that exceeds the capacity.

    Null and empty texts have no tokens and take a place without room; repeated rows are placed again; capacities below 1
    are refused. ``capacities``: (id, tokens), a small fixed table."""
    if any(c < 1 for _, c in capacities):
        raise ValueError("a capacity must be at least one token")
    counted, shared, shape = collection(docs, shard)
    rows = counted.mapInArrow(_shards(shared, *shape), "shard long, id long, n_tokens long, terms array<int>, tfs array<int>")
    return rows.repartition("shard").sortWithinPartitions("shard", "id").mapInArrow(_pack_shards(capacities, shared), PLACED)


def collection(docs: DataFrame, shard: int):
    """Token counts of docs as a table, the broadcast figures and tree, and (vocabulary, depth, parts beyond the tree)."""
    counted = cut_lineage(token_counts(docs, terms=True))
    n, mean = counted.agg(F.count(F.lit(1)), F.coalesce(F.avg("n_tokens"), F.lit(0.0))).first()
    # one row for each token id that occurs: as long as the vocabulary at most
    seen = counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()
    vocabulary = max((r.t for r in seen), default=0) + 1
    df = np.ones(vocabulary)
    df[[r.t for r in seen]] = [r.df for r in seen]
    wanted = int(np.ceil(np.log2(max(1.0, n / shard))))
    depth = min(wanted, int(np.log2(SAMPLE / LEAF)))
    cuts: list = []
    if depth:
        k = max(1, n // SAMPLE)
        rows = counted.filter(F.pmod(F.xxhash64("id"), F.lit(k)) == 0).select("terms", "tfs").limit(2 * SAMPLE).collect()  # bounded
        whole, dirs = Collection(df, n, mean), directions(vocabulary)
        cuts = fit_tree(np.stack([whole.vector(r.terms, r.tfs, dirs) for r in rows]) if rows else np.zeros((0, DIM), np.float32), depth)
    d, c = (np.stack([x[0] for x in cuts]), np.array([x[1] for x in cuts])) if cuts else (np.zeros((1, DIM), np.float32), np.zeros(1))
    shared = docs.sparkSession.sparkContext.broadcast((df.tobytes(), int(n), float(mean), d.astype(np.float32).tobytes(), c.tobytes()))
    return counted, shared, (vocabulary, depth, 1 << (wanted - depth))


def _placed(spark, d: str) -> DataFrame:
    caps = [(r.capacity_id, r.capacity_tokens) for r in table(spark, d, "pack_capacities").select("capacity_id", "capacity_tokens").collect()]  # four fixed rows
    return pack_documents(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"), caps)


def p8_containers(spark, d: str) -> DataFrame:
    return _placed(spark, d)


def p8_report(spark, d: str) -> DataFrame:
    """Per capacity: containers, tokens, documents cut and the share of room used."""
    cap = table(spark, d, "pack_capacities")
    g = _placed(spark, d).groupBy("capacity_id").agg(F.count_distinct("container").alias("containers"), F.sum("n_tokens").alias("tokens"), F.sum((F.col("part") > 0).cast("long")).alias("later_pieces"))
    return g.join(F.broadcast(cap), "capacity_id").select("capacity_id", "containers", "tokens", "later_pieces", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("used"))


QUERIES = {"p8_containers": p8_containers, "p8_report": p8_report}
ORACLE: dict[str, str] = {}
