"""Problem 5: new batches against everything accepted so far, without reprocessing the history.

An incremental inverted index of the window sets' prefixes, rare windows first, stored in slots by window (``windows``). A
history is listed once and stored; a delivery of new items is listed, its prefixes are met with the stored lists slot by slot
under the size filter, which loses no similar pair, the overlap of what meets is verified on the texts, and the prefixes of
what is accepted are appended. Stored texts are never met with each other again, nor read again unless a new text meets them.
Within new items the earlier text must be no duplicate itself: ``resolve`` settles that in rounds over the links (a text all of
whose earlier links are settled is settled), which gives the same answer as taking the items one by one.

Scale: the listed windows are shuffled once, packed; a slot is one task's bounded work. Windows that many texts share come
last in every prefix, where they are seldom listed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.canon import canonical_text
from millrace.plans import checked_broadcast
from millrace.session import cut_lineage, ensure_checkpoint_dir
from millrace.sources import table

from .p02_neardup import verified
from .windows import PACKED, build_index, candidates_of_slots, index_parts, sign, window_order

DIGESTS = "id long, seq long, digest binary"


def resolve(links: DataFrame) -> DataFrame:
    """Of links (a, b, old, rank): the duplicates (b, a) with the best-ranked a that is accepted.

    ``old``: a was accepted before the batch. A text is a duplicate if one of its earlier links is accepted; it is accepted
    if all of its earlier links are duplicates. Rounds end when all are settled; each settles at least the earliest left."""
    links = cut_lineage(links)
    dup = cut_lineage(links.filter("old").select("b").distinct())
    left = cut_lineage(links.filter("NOT old").join(dup, "b", "left_anti").join(dup.withColumnRenamed("b", "a"), "a", "left_anti"))
    while not left.isEmpty():
        # heads: texts that occur only as the earlier side are accepted, what links to them is a duplicate
        heads = left.select("a").distinct().join(left.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        new_dup = cut_lineage(left.join(heads, "a", "left_semi").select("b").distinct())
        dup = cut_lineage(dup.unionByName(new_dup))
        left = cut_lineage(left.join(new_dup, "b", "left_anti").join(new_dup.withColumnRenamed("b", "a"), "a", "left_anti"))
    ok = links.join(dup.withColumnRenamed("b", "a"), "a", "left_anti")
    return ok.groupBy("b").agg(F.min(F.struct("rank", "a")).alias("m")).select("b", F.col("m.a").alias("a"))


class HistoryIndex:
    """The stored index of accepted texts: ``postings`` by slot, ``digests`` (one text for each), and ``plan``, the order and the
    number of parts that all its lists share. Each delivery adds files; nothing stored is rewritten."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        plan = spark.read.parquet(f"{folder}/plan").first()
        self.parts = plan.parts
        self.order = spark.sparkContext.broadcast(bytes(plan.window_order))

    @classmethod
    def create(cls, folder: str, history: DataFrame) -> HistoryIndex:
        """history: id, seq (negative), text. Of equal texts the one of least (seq, id) is kept; null texts are not stored."""
        spark = history.sparkSession
        texts = history.filter(F.col("text").isNotNull())
        plan = [(index_parts(texts), bytearray(window_order(texts)))]
        spark.createDataFrame(plan, "parts int, window_order binary").coalesce(1).write.parquet(f"{folder}/plan")
        index = cls(spark, folder)
        index.append(texts)
        return index

    def append(self, texts: DataFrame) -> None:
        """Store the digests and listed windows of texts (id, seq, text), none of which equals a stored text."""
        signed = cut_lineage(sign(texts, 0))
        at = f"{self.folder}/digests/delivery={uuid.uuid4()}"
        signed.groupBy("digest").agg(F.min(F.struct("seq", "id")).alias("f")).select("f.id", "f.seq", "digest").write.parquet(at)
        kept = self.spark.read.schema(DIGESTS).parquet(at)
        spare = checked_broadcast(cut_lineage(signed.select("id").join(kept.select("id"), "id", "left_anti")))  # copies are few
        self._list(texts.join(spare, "id", "left_anti"), f"{self.folder}/postings")

    def _list(self, texts: DataFrame, to: str) -> None:
        build_index(texts, self.order, self.parts).write.mode("append").partitionBy("slot").option("compression", "zstd").parquet(to)

    def _digests(self) -> DataFrame:
        return self.spark.read.schema(DIGESTS + ", delivery string").parquet(f"{self.folder}/digests").drop("delivery")

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _met(self, staged: str) -> DataFrame:
        """Pairs of a staged text with a stored or staged one that share enough listed windows."""
        columns = [c.split()[0] for c in PACKED.split(", ")]
        places = (f"{self.folder}/postings", staged)
        apart = PACKED.split(", ", 1)[1]
        slots = [(k, [f"{p}/slot={k}" for p in places if self._exists(f"{p}/slot={k}")]) for k in range(self.parts)]
        frames = [self.spark.read.schema(apart).parquet(*ps).select(F.lit(k).alias("slot"), *columns[1:]) for k, ps in slots if ps]
        return candidates_of_slots(frames) if frames else self.spark.createDataFrame([], "a long, b long")

    def settle(self, items: DataFrame, accepted: DataFrame, append: bool = True) -> DataFrame:
        """(id, of): each item that repeats a stored text or an earlier accepted item, and which one; accepted ones are appended.

        items: id, seq (their order, not negative), text; accepted: id, text of what is stored, read only for candidates; ids are
        unique over both. An equal canonical text is preferred, then the highest similarity, then the earlier text. Equal texts are
        one text, represented by its first occurrence. Null texts repeat nothing; empty texts equal empty texts; texts below one
        window are repeated only by equal ones."""
        texts = items.filter(F.col("text").isNotNull()).select("id", "seq", "text")
        new = cut_lineage(sign(texts, 0))
        first = cut_lineage(new.groupBy("digest").agg(F.min(F.struct("seq", "id")).alias("f")).select("digest", "f.seq", "f.id"))
        exact = cut_lineage(first.select("id", "digest").join(self._digests().select("digest", F.col("id").alias("a")), "digest").select("id", "a"))
        fresh = checked_broadcast(cut_lineage(first.join(exact, "id", "left_anti").select("id")))
        # what was stored from earlier deliveries is history to this one
        staged = f"{self.folder}/staged-{uuid.uuid4()}"
        self._list(texts.join(fresh, "id", "left_semi"), staged)
        pairs = self._met(staged)
        near = verified(pairs, accepted.select("id", "text").unionByName(texts.select("id", "text")))
        seqs = first.select(F.col("id").alias("a"), F.col("seq").alias("sa"))
        links = near.select("a", "b", (-(F.col("inter") / F.col("uni"))).alias("score")).join(seqs, "a", "left").withColumn("sa", F.coalesce("sa", F.lit(-1)))
        links = links.unionByName(exact.select("a", F.col("id").alias("b"), F.lit(-1.0).alias("score"), F.lit(-1).cast("long").alias("sa")))
        found = cut_lineage(resolve(links.select("a", "b", (F.col("sa") < 0).alias("old"), F.struct("score", "sa").alias("rank"))))
        of_item = new.select("id", "digest").join(first.select("digest", F.col("id").alias("f")), "digest").join(found.select(F.col("b").alias("f"), F.col("a").alias("fa")), "f", "left")
        # a first occurrence that is accepted, or else what it repeats
        repeats = cut_lineage(of_item.select("id", F.coalesce("fa", "f").alias("of")).filter("id != of"))
        self._remove(staged)
        if append:
            kept = first.join(found.select(F.col("b").alias("id")), "id", "left_anti").select("id")
            # stored order numbers are negative: these texts are history from now on
            self.append(texts.join(kept, "id", "left_semi").select("id", (F.col("seq") - F.lit(1 << 62)).alias("seq"), "text"))
        return repeats

    def _remove(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def drop(self) -> None:
        """Remove the stored files."""
        self._remove(self.folder)


def find_repeats(history: DataFrame, items: DataFrame) -> DataFrame:
    """``HistoryIndex.settle`` of one delivery against a history, by an index in the shared folder that is removed afterwards."""
    spark = items.sparkSession
    index = HistoryIndex.create(f"{ensure_checkpoint_dir(spark)}/index-{uuid.uuid4()}", history)
    found = index.settle(items, history, append=False)
    index.drop()
    return found


def _tables(spark, d: str) -> tuple[DataFrame, DataFrame]:
    # ids over both tables: a history row by its position in hash order is not needed, a hash of its unique key serves
    h = table(spark, d, "hash_dedup").select((F.xxhash64("hash").bitwiseAND((1 << 62) - 1) + F.lit(1 << 62)).alias("id"), F.lit(-1).cast("long").alias("seq"), "text", F.col("hash"))
    i = table(spark, d, "batch_items").select("item_id", "batch_no", "text")
    return h, i.select(F.col("item_id").alias("id"), (F.col("batch_no").cast("long") * F.lit(1 << 40) + F.col("item_id")).alias("seq"), "text")


def p5_found(spark, d: str) -> DataFrame:
    h, i = _tables(spark, d)
    found = cut_lineage(find_repeats(h.select("id", "seq", "text"), i))
    old = found.join(h.select(F.col("id").alias("of"), "hash"), "of").select(F.col("id").alias("item_id"), "hash")
    new = found.join(i.select(F.col("id").alias("of"), F.sha2(canonical_text(F.col("text")), 256).alias("hash")), "of").select(F.col("id").alias("item_id"), "hash")
    return old.unionByName(new)


def p5_accepted(spark, d: str) -> DataFrame:
    """The items of all batches that are no repeats, as they stand in the index after they were appended."""
    h, i = _tables(spark, d)
    history = h.select("id", "seq", "text")
    index = HistoryIndex.create(f"{ensure_checkpoint_dir(spark)}/index-{uuid.uuid4()}", history)
    found = index.settle(i, history)
    held = cut_lineage(index._digests().select("id"))
    index.drop()
    # items with a null text are in no index: they repeat nothing
    kept = i.select("id").join(found, "id", "left_anti").join(held.withColumn("held", F.lit(True)), "id", "left").join(i.select("id", "text"), "id")
    return kept.filter("held OR text IS NULL").select(F.col("id").alias("item_id"))


QUERIES = {"p5_found": p5_found, "p5_accepted": p5_accepted}
ORACLE: dict[str, str] = {}
