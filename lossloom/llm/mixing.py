"""Mixing sources to target weights: word budgets are met by a bounded-knapsack fit over counts of document lengths."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lossloom.llm.common import word_count
from lossloom.session import materialise, trimmed

BUCKETS = 4096
# The dynamic programme covers this many words of the budget at most; what lies above is taken in proportion.
PLAN_WORDS = 1 << 16


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, target): sources by code point, null last, weigh `weights` in turn and share all words.

    A target ends at `most` times its source's size and the excess is shared again by weight. In the order of
    size / weight this is one running sum: sources up to some point are full, the rest share what is left.
    `sizes` has one row per source.
    """
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int") + 1).cast("double"))
    weighed = weighed.withColumn("cap", F.lit(float(most)) * F.col("source_size")).withColumn("fill", F.col("cap") / F.col("weight"))
    before = Window.orderBy("fill", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    rate = ((F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    rated = weighed.withColumn("rate", rate)
    # The first source that is not full at its own rate fixes the rate of all the others.
    level = F.min(F.when(F.col("rate") <= F.col("fill"), F.struct("fill", "rate"))).over(whole)["rate"]
    return rated.select("source", "source_size", F.least(F.coalesce(level * F.col("weight"), F.col("cap")), F.col("cap")).alias("target"))


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come as near to `budget` from below as the fit finds.

    The lengths first give their shares of the budget, what rounding leaves going to the next shorter length, and long documents
    fill the rest down to PLAN_WORDS; the bounded knapsack over the remaining counts then finds the largest reachable sum.
    Where that misses the budget, long documents are also tried first with all of it, and the better of both is kept.
    """
    first = fill_budget(lengths, counts, budget, True)
    if int((lengths * first).sum()) >= min(budget, int((lengths * counts).sum())):
        return first
    other = fill_budget(lengths, counts, budget, False)
    return other if int((lengths * other).sum()) > int((lengths * first).sum()) else first


def fill_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, shared: bool) -> np.ndarray:
    """One try of fit_counts(): with the lengths' shares first, or with the longest documents that fit."""
    taken = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return taken
    if budget >= total:
        return counts.copy()
    order = np.argsort(-lengths, kind="stable")
    reserve = PLAN_WORDS // 2 if shared else 0
    if shared and budget > PLAN_WORDS:
        # From long to short, running counts rounded down never hold more words than the exact shares.
        running = [int(c) * (budget - reserve) // total for c in np.cumsum(counts[order])]
        taken[order] = np.diff(running, prepend=0)
    left = budget - int((lengths * taken).sum())
    for i in order:
        if left <= PLAN_WORDS:
            break
        n = min(int(counts[i] - taken[i]), max(0, left - reserve) // max(1, int(lengths[i])))
        taken[i] += n
        left -= n * int(lengths[i])
    width = min(left, PLAN_WORDS) + 1
    free = counts - taken
    usable = [i for i in order if 0 < lengths[i] < width and free[i] > 0]
    # used[s]: fewest copies of the current length in a sum s; reached: sums that earlier lengths make.
    reached = np.zeros(width, bool)
    reached[0] = True
    last = np.full(width, -1, np.int32)
    copies = np.zeros(width, np.int32)
    for i in usable:
        if reached[-1]:
            break
        size, rest = int(lengths[i]), int(free[i])
        state = reached.copy()
        step, given = 1, 0
        while given < rest and given * size < width:
            n = min(step, rest - given)
            shifted = np.zeros_like(state)
            if n * size < width:
                shifted[n * size:] = state[:width - n * size]
            fresh = np.flatnonzero(shifted & ~state)
            # A sum may itself be fresh of this length: its copies add up.
            base = fresh - n * size
            copies[fresh] = n + np.where(last[base] == i, copies[base], 0)
            last[fresh] = i
            state |= shifted
            given += n
            step *= 2
        reached = state
    at = int(np.flatnonzero(reached)[-1])
    while at > 0:
        taken[last[at]] += copies[at]
        at -= int(copies[at]) * int(lengths[last[at]])
    return taken


@trimmed
def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 42, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of `docs(doc_id, text, source)`.

    A source is taken whole as often as its target holds it; for the rest of its budget the number of documents of each
    length is fitted, and documents of that length are chosen in the order of a seeded hash of their id. A null text has
    size 0 and is taken with 0 words; a null source is a source; rows with one id and length are chosen in any order
    among themselves, or in that of the columns `carry`, which are given out too. `taken` counts words with repeats and never exceeds
    `most` times the size. An empty table gives none.
    """
    sized = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                    word_count(F.col("text")).alias("size"), *carry)
                        .withColumn("draw", F.xxhash64(F.lit(seed), F.col("doc_id")))
                        .withColumn("bucket", F.pmod("draw", F.lit(BUCKETS)).cast("int")))
    counted = materialise(sized.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("n")))
    lengths = materialise(counted.groupBy("source", "size").agg(F.sum("n").alias("n")))
    targets = materialise(source_targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most))
    per_length = lengths.join(targets, lengths["source"].eqNullSafe(targets["source"])).select(
        lengths["source"], "size", "n", "source_size", "target")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size", ignore_index=True)
        whole, target = int(group["source_size"][0]), float(group["target"][0])
        rounds = min(most, int(target // whole)) if whole else 0
        extra = fit_counts(group["size"].to_numpy(), group["n"].to_numpy(), int(round(target)) - rounds * whole if rounds < most else 0)
        return pd.DataFrame({"source": group["source"], "size": group["size"], "rounds": rounds, "extra": extra,
                             "source_size": whole, "target": target})

    plan = materialise(per_length.groupBy("source").applyInPandas(
        fit, "source string, size long, rounds long, extra long, source_size long, target double"))
    # Buckets of a length are taken in order until one holds the last document that is wanted.
    below = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begun = counted.withColumn("below", F.coalesce(F.sum("n").over(below), F.lit(0)))
    limits = materialise(begun.join(plan, begun["source"].eqNullSafe(plan["source"]) & (begun["size"] == plan["size"])).select(
        begun["source"], begun["size"], "bucket", (F.col("extra") - F.col("below")).alias("room"), "rounds", "source_size", "target"))
    place = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("draw", "doc_id", *carry))
    placed = sized.withColumn("place", place).alias("d").join(
        limits.alias("l"), F.col("d.source").eqNullSafe(F.col("l.source")) & (F.col("d.size") == F.col("l.size")) & (F.col("d.bucket") == F.col("l.bucket")))
    times = F.col("rounds") + F.when(F.col("place") <= F.col("room"), 1).otherwise(0)
    return placed.select("doc_id", F.col("d.size").alias("size"), "source_size", "target", (times * F.col("d.size")).alias("taken"),
                         F.col("d.source").alias("source"), times.cast("int").alias("times"), *(F.col(f"d.{c}") for c in carry))
