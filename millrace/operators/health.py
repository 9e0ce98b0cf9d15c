"""Health of runs: counters, trends, resilience, limits and back-off replayed in order, retry queues, alerts.

Aggregates and trends are native. State machines whose step depends on all steps before are folds: rows are brought together by
key, sorted by time, and read in Arrow batches with only the state carried on, so a hot key costs its one task time but no memory.
"""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import table

# Limits of the state machines and of the trends.
COOLDOWN = {"failures": 3, "pause_s": 120.0}
LIMITER = {"limit": 5, "window_s": 3600.0, "burst": 1.5}
RATE = {"start": 2.0, "least": 0.1, "most": 10.0, "up": 1.1, "down": 0.5}
WINDOW_S, FAILURES = 60, 5
ALPHA = 0.1
TIERS = {"enterprise": 1.5, "professional": 1.2, "standard": 1.0, "basic": 0.8}


def fold_by_key(events: DataFrame, start, step, ddl: str) -> DataFrame:
    """Each row of events (key, seq, ts_s, ...) with what ``step(state, row) -> (state, dict)`` gives, ``state`` beginning as
    ``start()`` for each key; rows of a key in order of (ts_s, seq). Result: key, seq and the columns of ``ddl``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType(events.select("key", "seq").schema.fields + T._parse_datatype_string(ddl).fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        key, state = object(), None
        for b in batches:
            rows = []
            for r in b.to_pylist():
                if r["key"] != key:
                    key, state = r["key"], start()
                state, got = step(state, r)
                rows.append({"key": key, "seq": r["seq"], **got})
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return events.repartition("key").sortWithinPartitions("key", "ts_s", "seq").mapInArrow(run, schema)


def replay_cooldown(events: DataFrame) -> DataFrame:
    """(key, seq, blocked, failures): whether a key is in its pause at an event, and its failures since the last success. events: ok
    as well; three failures begin a pause, an expired pause keeps the count, a success clears both."""

    def step(s, r):
        failures, until = s
        blocked = until > r["ts_s"]
        if r["ok"]:
            failures, until = 0, 0.0
        else:
            failures += 1
            until = r["ts_s"] + COOLDOWN["pause_s"] if failures >= COOLDOWN["failures"] else until
        return (failures, until), {"blocked": blocked, "failures": failures}

    return fold_by_key(events, lambda: (0, 0.0), step, "blocked boolean, failures int")


def replay_limiter(events: DataFrame) -> DataFrame:
    """(key, seq, allowed, remaining) of a sliding window over admitted events: up to the limit, beyond it up to the burst while the
    last quarter of the window is light."""
    limit, width = LIMITER["limit"], LIMITER["window_s"]
    burst = int(limit * LIMITER["burst"])

    def step(seen, r):
        now = r["ts_s"]
        while seen and seen[0] < now - width:
            seen.popleft()
        n = len(seen)
        ok = n < limit or (n < burst and sum(t > now - width / 4 for t in seen) < limit / 4)
        if ok:
            seen.append(now)
        return seen, {"allowed": ok, "remaining": max(0, limit - n - 1) if ok else 0}

    return fold_by_key(events, deque, step, "allowed boolean, remaining int")


def replay_rate(events: DataFrame) -> DataFrame:
    """(key, seq, rate, error_rate): requests a second allowed after each event: a tenth more while errors are below a tenth (by an
    exponential mean), half as many after an error, within limits."""

    def step(s, r):
        rate, err = s
        err = (1 - ALPHA) * err + ALPHA * (not r["ok"])
        rate = (min(rate * RATE["up"], RATE["most"]) if err < 0.1 else rate) if r["ok"] else max(rate * RATE["down"], RATE["least"])
        return (rate, err), {"rate": rate, "error_rate": err}

    return fold_by_key(events, lambda: (RATE["start"], 0.0), step, "rate double, error_rate double")


def replay_mean(events: DataFrame) -> DataFrame:
    """(key, seq, mean): the exponential mean of ``value`` after each event; null values change nothing."""

    def step(m, r):
        v = r["value"]
        m = m if v is None else v if m is None else (1 - ALPHA) * m + ALPHA * v
        return m, {"mean": m}

    return fold_by_key(events, lambda: None, step, "mean double")


def retry_eligible(attempts: Column, next_retry: Column, severity: Column, retryable: Column, now: Column, most: int = 3) -> Column:
    """Fewer attempts than allowed, its time reached, not critical and not permanent; nulls are not eligible."""
    return F.coalesce((attempts < most) & (next_retry <= now) & (severity != "critical") & retryable, F.lit(False))


def due_for_retry(letters: DataFrame, now: Column, limit: int = 10, most: int = 3) -> DataFrame:
    """The ``limit`` letters whose retry is due longest (the limit is the feature: one round of the retry loop)."""
    ok = retry_eligible(F.col("failure_count"), F.col("next_retry"), F.col("severity"), F.col("retryable"), now, most)
    return letters.filter(ok).orderBy("next_retry", *[c for c in ("user_id", "stage") if c in letters.columns]).limit(limit)


def letters_of(letters: DataFrame, stage: str | None = None, limit: int = 100) -> DataFrame:
    """Newest dead letters, of one stage or all."""
    x = letters if stage is None else letters.filter(F.col("stage") == stage)
    return x.orderBy(F.desc("last_ts"), "user_id", "stage").limit(limit)


def merge_letters(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Upsert of failures (key..., n, first_ts, last_ts, error): counts add, the earliest time stays, the latest error counts."""
    both = old.unionByName(new)
    return both.groupBy(*key).agg(F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.max_by("error", F.struct("last_ts", "error")).alias("error"))


def action_of(error: Column) -> Column:
    """What a failed item's error asks for: a smaller batch, another try, or only a note."""
    low = F.lower(F.coalesce(error, F.lit("")))
    return F.when(low.contains("out of memory"), "halve_batch").when(low.rlike("timeout|network|connection"), "requeue").when(low.rlike("disk|storage"), "log_storage").otherwise("log")


def safe_to_proceed(metrics: dict[str, Column], limits: dict[str, float], now: Column, periods: Column) -> Column:
    """Reasons against going on: metrics above their limit, and a period (start, end) that holds ``now``; empty if safe."""
    over = [F.when(c > limits[k], F.lit(k)) for k, c in metrics.items() if k in limits]
    return F.array_compact(F.array(*over, F.when(F.exists(periods, lambda p: now.between(p["start"], p["end"])), F.lit("blackout"))))


def value_score(quality: Column, demand: Column, tier: Column, uniqueness: Column) -> Column:
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in TIERS.items() for x in kv]), tier), F.lit(1.0))
    return F.least(F.lit(1.0), quality * 0.4 + demand * 0.3 + rank * 0.2 + uniqueness * 0.1)


def fetch_backoff(attempt: Column, seed: Column) -> Column:
    """Two to the attempts before, times a seeded factor within 0.8..1.2."""
    u = F.pmod(F.xxhash64(seed, attempt), F.lit(10_000)) / 10_000.0
    return F.pow(F.lit(2.0), attempt - 1) * (0.8 + 0.4 * u)


def crawl_complexity(size: Column, scripts: Column, forms: Column) -> Column:
    """Size up to 1 MB, ten scripts and five forms, weighted four, four and two tenths."""
    cap = lambda c: F.least(c, F.lit(1.0))
    return 0.4 * cap(size / 1_000_000) + 0.4 * cap(scripts / 10) + 0.2 * cap(forms / 5)


def resource_efficiency(cpu: Column, memory: Column) -> Column:
    return 0.7 * (1 - cpu / 100) + 0.3 * (1 - memory / 100)


def gpu_batch(memory_mb: Column, model_mb: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(memory_mb * 0.8 / (4 * model_mb)))


def prometheus(counts: DataFrame, name: str, labels: list[str], value: str) -> DataFrame:
    """Lines of the exposition format, one for each row of a small report."""
    quoted = F.concat_ws(",", *[F.concat(F.lit(f'{c}="'), F.col(c).cast("string"), F.lit('"')) for c in labels])
    return counts.select(F.concat(F.lit(f"{name}{{"), quoted, F.lit("} "), F.col(value).cast("string")).alias("line"))


def _events(spark, d):
    return table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")


def _keyed(spark, d):
    return _events(spark, d).select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("ts_s"), (F.col("event_type") != "error").alias("ok"), "value")


def cooldown_replay(spark, d):
    return replay_cooldown(_keyed(spark, d)).select(F.col("key").alias("user_id"), F.col("seq").alias("event_id"), "blocked", "failures")


def limiter_replay(spark, d):
    return replay_limiter(_keyed(spark, d)).select(F.col("key").alias("user_id"), F.col("seq").alias("event_id"), "allowed", "remaining")


def rate_replay(spark, d):
    return replay_rate(_keyed(spark, d)).select(F.col("key").alias("user_id"), F.col("seq").alias("event_id"), F.round("rate", 6).alias("rate"), F.round("error_rate", 6).alias("error_rate"))


def ema_latency(spark, d):
    return replay_mean(_keyed(spark, d)).select(F.col("key").alias("user_id"), F.col("seq").alias("event_id"), F.round("mean", 6).alias("mean"))


def failures_since_success(spark, d):
    """Per error the number of errors of its user since the last other event: runs by windows."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = _events(spark, d).withColumn("run", F.sum((F.col("event_type") != "error").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    n = F.count(F.lit(1)).over(Window.partitionBy("user_id", "run", F.col("event_type") == "error").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0))
    return e.withColumn("n", n).filter("event_type = 'error'").select("event_id", F.col("n").cast("long").alias("failures"))


def failure_bursts(spark, d):
    """Per shard of users and second with errors, the errors of the minute up to it; five or more open a back-off. Seconds are counted
    first, so no window holds single events."""
    s = _events(spark, d).filter("event_type = 'error'").groupBy(F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("second"), F.pmod("user_id", F.lit(10)).alias("shard")).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("shard").orderBy("second").rangeBetween(-(WINDOW_S - 1), 0)
    return s.withColumn("n", F.sum("c").over(w)).select("shard", "second", "n", (F.col("n") >= FAILURES).alias("backoff"))


def cost_trend(spark, d):
    """Per user over the last ten values: mean of the last three against the first five; a rise of over 30 percent is a spike."""
    w = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    last = _events(spark, d).filter("value IS NOT NULL").withColumn("r", F.row_number().over(w)).filter("r <= 10")
    n = last.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col("r") <= 3, F.col("value"))).alias("late"))
    early = last.join(n, "user_id").filter("n >= 5 AND r > n - 5").groupBy("user_id", "late").agg(F.avg("value").alias("early"))
    rise = F.when(F.col("early") > 0, (F.col("late") - F.col("early")) / F.col("early") * 100).otherwise(0.0)
    return early.select("user_id", F.round(rise, 4).alias("rise"), (rise > 30).alias("spiking"), F.round((F.col("late") - F.col("early")) * 30, 4).alias("monthly"))


def resilience(spark, d):
    """Per event type and day against the first day: shares of events and value kept, errors not added, weighted; and the first day
    that is within limits again."""
    day = _events(spark, d).groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"), (F.count_if(F.col("value") > 100) / F.count(F.lit(1))).alias("e"))
    base = day.groupBy("event_type").agg(F.min_by(F.struct("n", "v", "e"), "day").alias("b"))
    x = day.join(base, "event_type").withColumn("i", F.row_number().over(Window.partitionBy("event_type").orderBy("day")) - 1)
    fine = (F.col("n") >= 0.9 * F.col("b.n")) & (F.col("v") >= 0.9 * F.col("b.v")) & (F.col("e") <= 1.5 * F.col("b.e"))
    g = x.filter("i > 0").groupBy("event_type").agg(F.greatest(F.lit(0.0), 1 - F.max(F.col("e") / F.greatest(F.col("b.e"), F.lit(0.1)))).alias("err"), F.least(F.lit(1.0), F.min(F.col("n") / F.col("b.n"))).alias("kept"), F.least(F.lit(1.0), F.min(F.col("v") / F.col("b.v"))).alias("worth"), F.min(F.when(fine, F.col("i") - 1)).alias("first"), F.count(F.lit(1)).alias("days"))
    return g.select("event_type", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.3 * F.col("err") + 0.4 * F.col("kept") + 0.3 * F.col("worth"))), 6).alias("resilience"), (F.coalesce("first", "days") * 10).cast("long").alias("recovery_s"))


def stability(spark, d):
    """Per type: mean of an error score, a latency score and a load score, the peak, limits kept and advice."""
    e = _events(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), (F.count_if(F.col("value") > 100) * 100 / F.count(F.lit(1))).alias("rate"), F.percentile("value", 0.5).alias("mid"), F.percentile("value", 0.95).alias("p95"), F.max("value").alias("peak"))
    score = (F.greatest(F.lit(0.0), 1 - F.col("rate") / 5) + F.when(F.col("mid") < 50, 1.0).otherwise(0.5) + F.greatest(F.lit(0.0), 1 - F.col("peak") / 1000)) / 3
    advice = F.array_compact(F.array(F.when(F.col("rate") > 5, "fewer_errors"), F.when(F.col("p95") > 150, "faster"), F.when(F.col("peak") > 400, "more_room")))
    return e.select("event_type", F.round(score, 6).alias("stability"), F.round("peak", 4).alias("peak"), (F.col("p95") <= 200).alias("p95_kept"), (F.col("rate") <= 20).alias("errors_kept"), F.array_join(advice, ",").alias("advice")).orderBy("stability", "event_type")


def labelled_counters(spark, d):
    """Counts by label with their share of all, and a line of the exposition format for each."""
    g = _events(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    line = F.concat(F.lit('events_total{type="'), F.col("event_type"), F.lit('"} '), F.col("n").cast("string"))
    return g.crossJoin(F.broadcast(g.agg(F.sum("n").alias("total")))).select("event_type", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"), line.alias("line"))  # one-row side


def processing_tracking(spark, d):
    """Per domain type and tier of quality: contents, mean quality, duplicates and a value score, with subtotals."""
    t = table(spark, d, "processed_content").select(F.coalesce("quality_score", F.lit(0.0)).alias("q"), "is_duplicate")
    tier = F.when(F.col("q") >= 0.8, "enterprise").when(F.col("q") >= 0.6, "professional").when(F.col("q") >= 0.4, "standard").otherwise("basic")
    x = t.withColumn("tier", tier).withColumn("value", value_score(F.col("q"), F.lit(0.5), F.col("tier"), F.lit(0.7)))
    return x.rollup("tier").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("q"), 6).alias("mean_quality"), F.count_if("is_duplicate").alias("duplicates"), F.round(F.avg("value"), 6).alias("mean_value"))


def crawl_summary(spark, d):
    """Deliveries by status: count, successes, mean bytes, mean attempts, mean complexity."""
    t = table(spark, d, "crawl_results").select("status", "status_code", F.octet_length("content").alias("bytes"), "attempts")
    ok = F.col("status_code").between(200, 299)
    return t.rollup("status").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(ok.cast("double")), 6).alias("success_rate"), F.round(F.avg("bytes"), 4).alias("mean_bytes"), F.round(F.avg("attempts"), 6).alias("mean_attempts"))


def extractor_stats(spark, d):
    """Per extraction method: records, those with enough text, their rate and mean confidence."""
    t = table(spark, d, "extracted_content").select("extraction_method", (F.length(F.trim(F.coalesce("text", F.lit("")))) >= 20).alias("ok"), "confidence_score")
    return t.groupBy("extraction_method").agg(F.count(F.lit(1)).alias("attempts"), F.count_if("ok").alias("successes"), F.round(F.avg(F.col("ok").cast("double")), 6).alias("rate"), F.round(F.avg("confidence_score"), 6).alias("mean_confidence"))


def retry_queue(spark, d):
    """The ten dead letters whose retry is due longest at the newest event (one round of the retry loop)."""
    e = _events(spark, d)
    g = e.groupBy("user_id", F.col("event_type").alias("stage")).agg(F.count(F.lit(1)).alias("failure_count"), F.max("ts").alias("last_ts"))
    g = g.withColumns({"next_retry": F.expr("last_ts + make_dt_interval(0, 0, 0, least(86400, 60 * pow(2, least(failure_count, 20))))"), "severity": F.when(F.col("stage") == "purchase", "critical").otherwise("normal"), "retryable": F.col("stage") != "view"})
    now = e.agg(F.max("ts").alias("now"))
    return due_for_retry(g.join(F.broadcast(now)), F.col("now"), most=12).select("user_id", "stage", "failure_count", "next_retry")  # one-row side


def alerts(spark, d):
    """Users whose cost spikes, and the severity of it."""
    return cost_trend(spark, d).filter("spiking").select("user_id", F.lit("cost_spike").alias("alert"), F.when(F.col("rise") > 100, "critical").otherwise("warning").alias("severity"))


QUERIES = {f.__name__: f for f in (cooldown_replay, limiter_replay, rate_replay, ema_latency, failures_since_success, failure_bursts, cost_trend, resilience, stability, labelled_counters, processing_tracking, crawl_summary, extractor_stats, retry_queue, alerts)}

_COST = "with r as (select user_id, value, row_number() over (partition by user_id order by ts desc, event_id desc) as r from events where value is not null), l as (select *, count(*) over (partition by user_id) as n from r where r <= 10), g as (select user_id, avg(value) filter (r <= 3) as late, avg(value) filter (r > n - 5) as early from l where n >= 5 group by user_id), t as (select user_id, late, early, case when early > 0 then (late - early) / early * 100 else 0 end as rise from g) "
ORACLE = {
    "failures_since_success": "select event_id, count(*) over (partition by user_id, run order by ts, event_id) as failures from (select *, sum((event_type <> 'error')::int) over (partition by user_id order by ts, event_id rows unbounded preceding) as run from events) where event_type = 'error'",
    "failure_bursts": "with s as (select floor(epoch_us(ts) / 1000000)::bigint as second, user_id % 10 as shard, count(*) as c from events where event_type = 'error' group by all) select shard, second, n, n >= 5 as backoff from (select shard, second, sum(c) over (partition by shard order by second range between 59 preceding and current row)::bigint as n from s)",
    "cost_trend": _COST + "select user_id, round(rise, 4) as rise, rise > 30 as spiking, round((late - early) * 30, 4) as monthly from t",
    "alerts": _COST + "select user_id, 'cost_spike' as alert, case when round(rise, 4) > 100 then 'critical' else 'warning' end as severity from t where rise > 30",
    "labelled_counters": "select event_type, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share, 'events_total{type=\"' || event_type || '\"} ' || count(*) as line from events group by event_type",
    "processing_tracking": "select tier, count(*) as n, round(avg(q), 6) as mean_quality, count(*) filter (is_duplicate) as duplicates, round(avg(least(1, q * 0.4::double + 0.15::double + case tier when 'enterprise' then 1.5::double when 'professional' then 1.2::double when 'standard' then 1 else 0.8::double end * 0.2::double + 0.07::double)), 6) as mean_value from (select *, case when q >= 0.8 then 'enterprise' when q >= 0.6 then 'professional' when q >= 0.4 then 'standard' else 'basic' end as tier from (select coalesce(quality_score, 0) as q, is_duplicate from processed_content)) group by rollup(tier)",
    "crawl_summary": "select status, count(*) as n, round(avg((status_code between 200 and 299)::int), 6) as success_rate, round(avg(octet_length(content)), 4) as mean_bytes, round(avg(attempts), 6) as mean_attempts from crawl_results group by rollup(status)",
    "extractor_stats": "select extraction_method, count(*) as attempts, count(*) filter (length(trim(coalesce(text, ''), ' ')) >= 20) as successes, round(avg((length(trim(coalesce(text, ''), ' ')) >= 20)::int), 6) as rate, round(avg(confidence_score), 6) as mean_confidence from extracted_content group by extraction_method",
    "stability": "select event_type, round((greatest(0, 1 - rate / 5) + case when mid < 50 then 1 else 0.5::double end + greatest(0, 1 - peak / 1000)) / 3, 6) as stability, round(peak, 4) as peak, p95 <= 200 as p95_kept, rate <= 20 as errors_kept, array_to_string(list_filter([case when rate > 5 then 'fewer_errors' end, case when p95 > 150 then 'faster' end, case when peak > 400 then 'more_room' end], lambda x: x is not null), ',') as advice from (select event_type, count(*) filter (value > 100) * 100 / count(*) as rate, quantile_cont(value, 0.5) as mid, quantile_cont(value, 0.95) as p95, max(value) as peak from events group by event_type)",
    "resilience": "with d as (select event_type, date_trunc('day', ts) as day, count(*) as n, sum(value) as v, count(*) filter (value > 100) / count(*) as e from events group by all), x as (select *, first(n) over w as bn, first(v) over w as bv, first(e) over w as be, row_number() over w - 1 as i from d window w as (partition by event_type order by day)), g as (select event_type, greatest(0, 1 - max(e / greatest(be, 0.1::double))) as err, least(1, min(n / bn)) as kept, least(1, min(v / bv)) as worth, min(case when n >= 0.9::double * bn and v >= 0.9::double * bv and e <= 1.5::double * be then i - 1 end) as first_ok, count(*) as days from x where i > 0 group by event_type) select event_type, round(greatest(0, least(1, 0.3::double * err + 0.4::double * kept + 0.3::double * worth)), 6) as resilience, cast(coalesce(first_ok, days) * 10 as bigint) as recovery_s from g",
    "retry_queue": "with g as (select user_id, event_type as stage, count(*) as failure_count, max(ts) as last_ts from events group by all), n as (select *, last_ts + to_seconds(least(86400.0::double, 60 * pow(2.0::double, least(failure_count, 20)))) as next_retry from g) select user_id, stage, failure_count, next_retry from n where failure_count < 12 and next_retry <= (select max(ts) from events) and stage not in ('purchase', 'view') order by next_retry, user_id, stage limit 10",
}
