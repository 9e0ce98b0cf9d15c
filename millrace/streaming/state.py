"""Streams: keyed back-off with state, incremental exact deduplication with a watermark, dead letters merged by micro-batch."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from millrace.operators.health import merge_letters
from millrace.session import ensure_checkpoint_dir

FAILURES, WINDOW_S, PAUSE_S = 5, 60.0, 120.0


def backoff_stream(events: DataFrame) -> DataFrame:
    """(key, seq, blocked) for a stream of key, seq, ts_s, failed: a key with five failures within a minute is blocked for two.

    State per key: the failure times still inside the window and the time until which it is blocked. Micro-batches are
    sorted by time inside a key; order across micro-batches is that of arrival."""

    def step(key, frames, state):
        times, until = (list(state.get[0]), state.get[1]) if state.exists else ([], 0.0)
        rows = sorted((r for f in frames for r in f[["ts_s", "seq", "failed"]].itertuples(index=False)), key=lambda r: (r.ts_s, r.seq))
        out = []
        for r in rows:
            blocked = r.ts_s < until
            if r.failed and not blocked:
                times = [t for t in times if t > r.ts_s - WINDOW_S] + [r.ts_s]
                if len(times) >= FAILURES:
                    until, times = r.ts_s + PAUSE_S, []
            out.append((key[0], r.seq, blocked))
        state.update((times, until))
        yield pd.DataFrame(out, columns=["key", "seq", "blocked"])

    return events.groupBy("key").applyInPandasWithState(step, "key long, seq long, blocked boolean", "times array<double>, until double", "append", GroupStateTimeout.NoTimeout)


def dedup_stream(docs: DataFrame, ts: str, key: str, late: str = "1 hour") -> DataFrame:
    """First row of each key within the watermark's horizon."""
    return docs.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def run_available(stream: DataFrame, spark: SparkSession, mode: str = "append") -> DataFrame:
    """Everything a stream has now, through a parquet sink; for tests, replays and backfills."""
    at = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    q = stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/out")


def merge_stream(letters: DataFrame, root: str, key: list[str]):
    """A writer of a stream of failures (key..., n, first_ts, last_ts, error) that keeps one row a key: each micro-batch is merged with
    the version before it into a version of its own, so a repeated batch gives the same version again."""

    def merge(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        old = spark.read.schema(batch.schema).parquet(f"{root}/v{n - 1}") if n else batch.limit(0)
        merge_letters(old, batch, key).write.mode("overwrite").parquet(f"{root}/v{n}")

    return letters.writeStream.foreachBatch(merge).option("checkpointLocation", f"{root}/state").trigger(availableNow=True)


def merged_letters(letters: DataFrame, spark: SparkSession, key: list[str]) -> DataFrame:
    """The table that ``merge_stream`` has made of everything a stream has now."""
    root = f"{ensure_checkpoint_dir(spark)}/letters-{uuid.uuid4().hex}"
    q = merge_stream(letters, root, key).start()
    q.awaitTermination()
    return spark.read.schema(letters.schema).parquet(f"{root}/v{q.lastProgress['batchId']}")


def _event_stream(spark, d):
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


def stream_backoff(spark, d):
    e = _event_stream(spark, d).select(F.col("user_id").cast("long").alias("key"), F.col("event_id").alias("seq"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("ts_s"), (F.col("event_type") == "error").alias("failed"))
    return run_available(backoff_stream(e), spark).select(F.col("key").alias("user_id"), F.col("seq").alias("event_id"), "blocked")


def stream_letters(spark, d):
    """Failures by user and type, merged from a stream: how many, first and last time, and the latest value."""
    e = _event_stream(spark, d).select("user_id", "event_type", F.lit(1).cast("long").alias("n"), F.col("ts").alias("first_ts"), F.col("ts").alias("last_ts"), F.lpad(F.format_number("value", 2), 12, " ").alias("error"))
    return merged_letters(e, spark, ["user_id", "event_type"]).select("user_id", "event_type", "n", "first_ts", "last_ts")


QUERIES = {"stream_backoff": stream_backoff, "stream_letters": stream_letters}
ORACLE = {"stream_letters": "select user_id, event_type, count(*) as n, min(ts) as first_ts, max(ts) as last_ts from events group by user_id, event_type"}
