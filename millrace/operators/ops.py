"""Operational reports: failures, timings, histograms, trends, dead letters and keyed state replayed in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources import table

# Bucket bounds of the value histogram, breaker limits.
BOUNDS = (5.0, 10.0, 25.0, 50.0, 75.0, 100.0, 250.0, 500.0, 1000.0)
BREAKER = {"failures": 5, "open_s": 60, "successes": 3}


def _events(spark, d):
    return table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")


def stage_timings(spark, d):
    return _events(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("mean"), F.min("value").alias("least"), F.max("value").alias("most"), F.round(F.sum("value"), 2).alias("total"))


def failure_stats(spark, d):
    """Per type and in all: events, errors and mean value, by one grouping-sets pass."""
    return _events(spark, d).rollup("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 100).alias("costly"), F.round(F.avg("value"), 4).alias("mean"))


def failures_last_day(spark, d):
    """Events of the last 24 hours before the newest event, by type."""
    e = _events(spark, d)
    newest = e.agg(F.max("ts").alias("newest"))
    return e.join(F.broadcast(newest), F.col("ts") > F.col("newest") - F.expr("INTERVAL 24 HOURS")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def histogram_value(spark, d):
    """Cumulative counts up to each bound, per type."""
    e = _events(spark, d).groupBy("event_type").agg(*[F.count_if(F.col("value") <= b).alias(f"le_{int(b)}") for b in BOUNDS], F.count(F.lit(1)).alias("le_inf"))
    return e


def percentiles_nearest(spark, d):
    """Per type the value at rank int(n * q) of the ascending values: ranks over pre-counted values, not a collected list."""
    v = _events(spark, d).filter("value IS NOT NULL").groupBy("event_type", "value").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("event_type").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    r = v.withColumn("upto", F.sum("c").over(w)).withColumn("n", F.sum("c").over(Window.partitionBy("event_type")))
    at = lambda q: F.min(F.when(F.col("upto") > F.floor(F.col("n") * q), F.col("value")))
    return r.groupBy("event_type").agg(*[at(q).alias(f"p{int(q * 100)}") for q in (0.5, 0.9, 0.95, 0.99)])


def cost_report(spark, d):
    return _events(spark, d).groupBy("user_id").agg(F.round(F.sum("value"), 2).alias("total"), F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("mean")).withColumn("opportunities", F.when(F.col("mean") > 0.5, F.col("n")).otherwise(F.lit(0)))


def _trailing(values: Column, n: int, first: bool) -> Column:
    part = F.slice(values, 1, n) if first else F.slice(values, -n, n)
    return F.aggregate(part, F.lit(0.0), lambda a, x: a + x) / F.size(part)


def quality_trend(spark, d):
    """Per user and event: over the last ten values, a drop of the last three below nine tenths of the first three."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-9, 0)
    e = _events(spark, d).filter("value IS NOT NULL").withColumn("v", F.collect_list("value").over(w)).filter(F.size("v") >= 3)
    e = e.withColumn("early", _trailing(F.col("v"), 3, True)).withColumn("late", _trailing(F.col("v"), 3, False))
    return e.select("event_id", (F.col("late") < F.col("early") * 0.9).alias("degrading"), F.round(F.when(F.col("early") > 0, 1 - F.col("late") / F.col("early")), 5).alias("drop"))


def degradation(spark, d):
    """Per user: does any value fall below nine tenths of the one before?"""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = _events(spark, d).withColumn("prev", F.lag("value").over(w))
    return e.groupBy("user_id").agg(F.coalesce(F.bool_or(F.col("value") < 0.9 * F.col("prev")), F.lit(False)).alias("degraded"))


def dead_letters(spark, d):
    """Upsert by (user, type): how often, first and last time, and the latest value."""
    return _events(spark, d).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("failure_count"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.max(F.struct("ts", "event_id", "value")).alias("m")).select("user_id", "event_type", "failure_count", "first_ts", "last_ts", F.col("m.value").alias("last_value"), F.least(F.lit(86400.0), 60 * F.pow(F.lit(2.0), F.least(F.col("failure_count"), F.lit(20)))).alias("retry_after_s"))


def replay_breaker(events: DataFrame) -> DataFrame:
    """Circuit breaker per key replayed in order of time: (key, seq, state) after each event. events: key, seq, ts_s, ok.

    closed: failures add up, a success takes one off, at the limit it opens; open: after the pause the next event finds it half
    open; half open: three successes close it, a failure opens it again. One key's events are a fold and so one group."""
    from millrace.operators.health import fold_by_key

    limit, pause, need = BREAKER["failures"], BREAKER["open_s"], BREAKER["successes"]

    def step(s, r):
        state, failures, good, since = s
        ts = r["ts_s"]
        if state == "open" and ts - since >= pause:
            state, good = "half_open", 0
        if state == "closed":
            failures = max(0, failures - 1) if r["ok"] else failures + 1
            if failures >= limit:
                state, since = "open", ts
        elif state == "half_open":
            if r["ok"]:
                good += 1
                if good >= need:
                    state, failures = "closed", 0
            else:
                state, since = "open", ts
        return (state, failures, good, since), {"state": state}

    return fold_by_key(events, lambda: ("closed", 0, 0, 0.0), step, "state string")


def breaker_replay(spark, d):
    e = _events(spark, d).select(F.col("user_id").cast("long").alias("key"), F.col("event_id").alias("seq"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("ts_s"), (F.col("event_type") != "error").alias("ok"))
    return replay_breaker(e).select(F.col("key").alias("user_id"), F.col("seq").alias("event_id"), "state")


QUERIES = {f.__name__: f for f in (stage_timings, failure_stats, failures_last_day, histogram_value, percentiles_nearest, cost_report, quality_trend, degradation, dead_letters, breaker_replay)}

ORACLE = {
    "stage_timings": "select event_type, count(*) as n, round(avg(value), 4) as mean, min(value) as least, max(value) as most, round(sum(value), 2) as total from events group by event_type",
    "failure_stats": "select event_type, count(*) as n, count(*) filter (value > 100) as costly, round(avg(value), 4) as mean from events group by rollup(event_type)",
    "failures_last_day": "select event_type, count(*) as n from events where ts > (select max(ts) from events) - interval 24 hour group by event_type",
    "histogram_value": "select event_type, " + ", ".join(f"count(*) filter (value <= {b}) as le_{int(b)}" for b in BOUNDS) + ", count(*) as le_inf from events group by event_type",
    "percentiles_nearest": "select event_type, " + ", ".join(f"l[cast(floor(len(l) * {q}) as int) + 1] as p{int(q * 100)}" for q in (0.5, 0.9, 0.95, 0.99)) + " from (select event_type, list(value order by value) as l from events where value is not null group by event_type)",
    "cost_report": "select user_id, total, n, mean, case when mean > 0.5 then n else 0 end as opportunities from (select user_id, round(sum(value), 2) as total, count(*) as n, round(avg(value), 4) as mean from events group by user_id)",
    "quality_trend": "select event_id, late < early * 0.9 as degrading, round(case when early > 0 then 1 - late / early end, 5) as drop from (select event_id, list_avg(v[1:3]) as early, list_avg(v[greatest(len(v) - 2, 1):len(v)]) as late from (select event_id, list(value) over (partition by user_id order by ts, event_id rows between 9 preceding and current row) as v from events where value is not null) where len(v) >= 3)",
    "degradation": "select user_id, coalesce(bool_or(value < 0.9 * prev), false) as degraded from (select user_id, value, lag(value) over (partition by user_id order by ts, event_id) as prev from events) group by user_id",
    "dead_letters": "select user_id, event_type, count(*) as failure_count, min(ts) as first_ts, max(ts) as last_ts, arg_max(value, struct_pack(a := ts, b := event_id)) as last_value, least(86400.0::double, 60 * pow(2.0::double, least(count(*), 20))) as retry_after_s from events group by user_id, event_type",
}
