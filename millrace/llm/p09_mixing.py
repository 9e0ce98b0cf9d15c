"""Problem 9: documents drawn from sources to target shares of the tokens.

Subset-sum budget fitting: documents are counted by exact token length per source. A source's budget is met by whole
passes over it (up to its repeats), then by an even share of every length, and the budget that remains by bounded-knapsack
dynamic programming over the lengths left. Where that misses the budget, the part left to the knapsack grows, at last to all
of it with every document's repeats, so that the total is the best that lengths and repeats allow. Which documents of a
length are drawn follows from a seeded hash.

The size of a plan is the largest at which every source that has documents can supply its share within its repeats.

Scale: only (source, length) counts meet the solver, one task per plan and source: a bitset over the remaining budget and
one number for each total in it. Documents of a length are picked by distributed ranks (p04).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.canon import clean_domain
from millrace.session import cut_lineage
from millrace.sources import table

from .p04_cap import over_quota
from .tokens import token_counts

SEED = 17


def _reach(lengths: list[int], left: list[int], gap: int) -> tuple[int, list[int]]:
    """Bounded knapsack: the largest total up to ``gap`` of at most ``left`` of each length, and how many of each it takes.

    A bitset holds the reachable totals, items of one length in powers of two; of each total only the item that reached it first is
    kept. What it was added to was reached by earlier items, so going back uses each item once."""
    items: list[tuple[int, int]] = []  # (position, how many at once)
    for k, n in enumerate(lengths):
        rest, step = min(left[k], gap // n if n else 0), 1
        while rest > 0:
            step = min(step, rest)
            items.append((k, step))
            rest -= step
            step *= 2
    mask, reach = (1 << (gap + 1)) - 1, 1
    first = np.full(gap + 1, -1, np.int32)
    for at, (k, m) in enumerate(items):
        new = (reach | reach << (lengths[k] * m)) & mask
        fresh = np.frombuffer((new ^ reach).to_bytes(gap // 8 + 1, "little"), np.uint8)
        first[np.flatnonzero(np.unpackbits(fresh, bitorder="little"))] = at
        reach = new
        if reach >> gap & 1:
            break
    total = at = reach.bit_length() - 1
    take = [0] * len(lengths)
    while at > 0:
        k, m = items[first[at]]
        take[k] += m
        at -= lengths[k] * m
    return total, take


def fit_budget(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each length to take, at most its count, for the largest total that does not exceed the budget.

    An even share of every length first, the rest by ``_reach``. Where that falls short, the share is lowered and the rest
    doubled until the budget is met or the rest is all of it, which is the whole bounded knapsack."""
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    if budget >= total:
        return list(counts)
    if budget <= 0 or not total:
        return [0] * len(lengths)
    best, rest = (-1, []), 0
    while True:
        share = [c * max(0, budget - rest) // total for c in counts]
        gap = budget - sum(n * t for n, t in zip(lengths, share, strict=True))
        got, more = _reach(lengths, [c - t for c, t in zip(counts, share, strict=True)], gap)
        best = max(best, (budget - gap + got, [t + m for t, m in zip(share, more, strict=True)]), key=lambda x: x[0])
        if best[0] == budget or gap == budget:
            return best[1]
        rest = max(2 * gap, 1)


def _solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Whole passes over the source and a fit of the rest; where that misses the budget, documents are repeated unevenly, each at
    most ``max_repeats`` times, by a fit from nothing."""
    pdf = pdf.sort_values("n_tokens")
    lengths, counts = [int(x) for x in pdf.n_tokens], [int(x) for x in pdf.n]
    size = lambda xs: sum(n * x for n, x in zip(lengths, xs, strict=True))
    whole = size(counts)
    budget, repeats = int(pdf.budget.iloc[0]), int(pdf.max_repeats.iloc[0])
    passes = min(repeats, budget // whole) if whole else 0
    more = fit_budget(lengths, counts, budget - passes * whole) if passes < repeats else [0] * len(lengths)
    uses = [passes * c + m for c, m in zip(counts, more, strict=True)]
    if size(uses) < budget and repeats > 1:
        uses = max(uses, fit_budget(lengths, [c * repeats for c in counts], budget), key=size)
    return pd.DataFrame({"plan_id": key[0], "source": key[1], "n_tokens": lengths, "passes": [u // c for u, c in zip(uses, counts, strict=True)], "more": [u % c for u, c in zip(uses, counts, strict=True)]})


def draw(docs: DataFrame, targets: DataFrame, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(plan_id, source, doc_id, n_tokens, repeats) and the budgets, for docs (id, source, n_tokens) and targets (plan_id, source,
    target_share, max_repeats), whose sources are spelled in their clean form.

    Documents without tokens or source are not drawn. A source without documents supplies nothing; shares of the others are
    not raised, the plan is that much smaller and the report shows it. max_repeats below 1 draws nothing."""
    docs = cut_lineage(docs.filter("n_tokens > 0").join(F.broadcast(targets.select("source").distinct()), "source"))  # targets: a small fixed table
    hist = cut_lineage(docs.groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("n")))
    supply = hist.groupBy("source").agg(F.sum(F.col("n") * F.col("n_tokens")).alias("supply"))
    t = targets.join(supply, "source", "left")
    size = t.filter("supply > 0 AND target_share > 0").groupBy("plan_id").agg(F.min(F.col("supply") * F.col("max_repeats") / F.col("target_share")).alias("plan_tokens"))
    budgets = cut_lineage(t.join(size, "plan_id", "left").select("plan_id", "source", "target_share", "max_repeats", F.coalesce("supply", F.lit(0)).alias("supply"), F.floor(F.coalesce(F.col("plan_tokens") * F.col("target_share"), F.lit(0.0)) + 1e-6).cast("long").alias("budget")))
    chosen = cut_lineage(hist.join(F.broadcast(budgets.filter("supply > 0")), "source").groupBy("plan_id", "source").applyInPandas(_solve, "plan_id int, source string, n_tokens long, passes long, more long").filter("passes > 0 OR more > 0"))
    d = docs.join(chosen, ["source", "n_tokens"]).withColumn("_h", F.xxhash64("id", "plan_id", F.lit(seed)).cast("double"))
    d = cut_lineage(d.select(F.concat_ws("|", "plan_id", "source", "n_tokens").alias("key"), "plan_id", "source", "n_tokens", "id", "passes", "more", "_h", F.concat_ws("|", "plan_id", "id").alias("pick")))
    part = d.filter("more > 0")
    counts = part.groupBy("key", "more").agg(F.count(F.lit(1)).alias("_n")).filter("_n > more").select("key", F.col("more").alias("_quota"))
    ranked = part.select("key", F.col("id"), "_h")
    beyond = over_quota(ranked, counts, ["key"], "_h", "id", small=False, keep_keys=True)
    extra = part.join(beyond, ["key", "id"], "left_anti").select("key", "id", F.lit(1).alias("one"))
    got = d.join(extra, ["key", "id"], "left").withColumn("repeats", F.col("passes") + F.coalesce("one", F.lit(0)))
    return got.filter("repeats > 0").select("plan_id", "source", F.col("id").alias("doc_id"), "n_tokens", "repeats"), budgets


def _inputs(spark, d: str) -> tuple[DataFrame, DataFrame]:
    clean = lambda c: clean_domain(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"^[a-zA-Z]+://|/+\s*$", ""))
    targets = table(spark, d, "mix_targets").select("plan_id", clean(F.col("source")).alias("source"), "target_share", "max_repeats")
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", clean(F.col("source")).alias("source"))
    wanted = docs.join(F.broadcast(targets.select("source").distinct()), "source", "left_semi")  # others are not tokenised
    n = token_counts(wanted.select("id", "text"))
    return wanted.select("id", "source").join(n, "id"), targets


def p9_draw(spark, d: str) -> DataFrame:
    return draw(*_inputs(spark, d))[0]


def p9_shares(spark, d: str) -> DataFrame:
    """Per plan and source: target and reached share, tokens, documents and the most repeats."""
    drawn, budgets = draw(*_inputs(spark, d))
    g = drawn.groupBy("plan_id", "source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count(F.lit(1)).alias("docs"), F.max("repeats").alias("most_repeats"))
    j = budgets.join(g, ["plan_id", "source"], "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    total = j.groupBy("plan_id").agg(F.sum("tokens").alias("total"))
    return j.join(total, "plan_id").select("plan_id", "source", "target_share", F.round(F.when(F.col("total") > 0, F.col("tokens") / F.col("total")), 6).alias("reached_share"), "budget", "tokens", F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), "max_repeats")


QUERIES = {"p9_draw": p9_draw, "p9_shares": p9_shares}
ORACLE: dict[str, str] = {}
