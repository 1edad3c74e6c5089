"""Mixing sources to target weights: subset-sum budgets over counts of documents by exact length.

Sources share a total by weight, up to a number of copies of their own size. What a
source takes beyond whole copies is fitted by length counts: an equal share of every
length first, the rest by a bounded-knapsack program, and the documents of each length
by a seeded order. Only counts by (source, length) reach a fitting task.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.prefixes import count_words
from tidemark.llm.tables import cut, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
COPIES = 2
SEED = 13
WINDOW = 65_536  # words that the knapsack program fits at most; lengths above are fitted by the steps before it
GROUP_ROWS = 5_000  # documents that one task puts in order at a time


def fit_rest(free: dict[int, int], budget: int) -> dict[int, int]:
    """How many documents of each length to take for the largest total up to ``budget``: bounded subset sum.

    Counts are split into powers of two. The reachable totals are the bits of one number,
    shifted by every item; each item keeps the bits that it added, from which the choice is read back.
    """
    items, mask = [], (1 << (budget + 1)) - 1
    for length in sorted(free, reverse=True):
        left, step = min(free[length], budget // length), 1
        while left > 0:
            step = min(step, left)
            items.append((length, step))
            left -= step
            step *= 2
    reached, added, used = 1, [], []
    for length, times in items:
        new = (reached << (length * times)) & mask & ~reached
        if new:
            added.append(new)
            used.append((length, times))
            reached |= new
        if reached >> budget & 1:
            break
    total, taken = reached.bit_length() - 1, {}
    for (length, times), new in zip(reversed(used), reversed(added)):
        if new >> total & 1:
            taken[length] = taken.get(length, 0) + times
            total -= length * times
    return taken


def fit_lengths(counts: dict[int, int], budget: int, window: int = WINDOW) -> dict[int, int]:
    """Documents to take of each length, so that their total is as near below ``budget`` as can be.

    All but a window of the budget is an equal share of each length, rounded down, and
    then the longest that still fit; the knapsack fits the rest. Small windows come first,
    as they keep the shares of lengths; a larger one only where the total falls short.
    """
    if budget >= sum(length * n for length, n in counts.items()):
        return dict(counts)
    best: dict[int, int] = {}
    most = -1
    for part in (64, 8, 1):
        taken = _fit_window(counts, budget, window // part)
        total = sum(length * n for length, n in taken.items())
        if total > most:
            best, most = taken, total
        if most == budget or window // part >= budget:
            break
    return best


def _fit_window(counts: dict[int, int], budget: int, window: int) -> dict[int, int]:
    size = sum(length * n for length, n in counts.items())
    taken = {length: n * max(budget - window, 0) // size for length, n in counts.items()}
    rest = budget - sum(length * n for length, n in taken.items())
    for at_once in (1, None):
        for length in sorted(counts, reverse=True):
            if rest <= window:
                break
            more = min(counts[length] - taken[length], rest // length, -(-(rest - window) // length), at_once or rest)
            taken[length] += more
            rest -= more * length
    free = {length: counts[length] - n for length, n in taken.items() if counts[length] > n and length <= rest}
    for length, n in fit_rest(free, min(rest, window)).items():
        taken[length] += n
    return taken


def source_key(source: Column) -> Column:
    """Text that orders sources by code point, NULL last, and joins NULL with NULL."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def ranked(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``sources`` with the weight of their place in the order of ``key``: ranges are counted, no task sees all."""
    placed = cut(sources.repartitionByRange("key").withColumn("part", F.spark_partition_id()), "mix-ranges")
    starts = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1
    place = (F.col("before") + inside) % len(weights)
    choice = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), place.cast("int") + 1)
    return placed.join(starts.select("part", before.alias("before")), "part").select("key", "source_size", choice.alias("weight"))


def targets(counts: DataFrame, weights: Sequence[float], share: float, copies: int) -> DataFrame:
    """(key, source_size, target) of (key, size, n): shares by weight, the excess over ``copies`` sizes dealt out again.

    Each round is one sum over the sources, and closes the sources that are above their limit.
    """
    sizes = counts.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    sources = cut(ranked(sizes, weights), "mix-sources")
    limit = (copies * F.col("source_size")).cast("double")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, closed = 0.0, -1
    while True:
        full = F.lit(closed >= 0) & (F.col("weight") * level > limit)
        row = sources.agg(
            F.count_if(full).alias("n"),
            F.coalesce(F.sum(F.when(full, copies * F.col("source_size"))), F.lit(0)).alias("spent"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        if row.n == closed or not row.weight:
            break
        closed, level = row.n, (share * total - row.spent) / row.weight
    return sources.select("key", "source_size", F.least(F.col("weight") * level, limit).alias("target"))


PLAN = "key string, source_size long, target double, size long, n long, copies long, extra long"


def mix_to_targets(
    docs: DataFrame,
    id_column: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    copies: int = COPIES,
    seed: int = SEED,
    window: int = WINDOW,
) -> DataFrame:
    """One row per row of ``docs``: id, source, size (words), source_size, target and taken words.

    Every document is taken as often as its source needs whole copies, and once more if
    chosen. The choice among documents of one source and length goes by a hash of seed,
    id and text, so reruns agree; equal rows are interchangeable. NULL texts have no words
    and take none; NULL sources are one source, last in order; NULL ids are ids of their own
    rows. A source and length with many documents is put in order in ranges of the hash,
    so that no task holds more than a few thousand. An empty table gives no rows.
    """
    base = cut(
        docs.select(
            F.col(id_column), F.col(source), source_key(F.col(source)).alias("key"), count_words(F.col(text)).alias("size"),
            F.xxhash64(F.lit(seed), F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))).alias("draw"),
        ),
        "mix-sizes",
    )
    counts = cut(base.groupBy("key", "size").agg(F.count("*").alias("n")), "mix-counts")
    goals = targets(counts, weights, share, copies)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        goal = min(int(target + 0.5), copies * size)
        whole = goal // size if size else 0
        sized = {int(s): int(n) for s, n in zip(group["size"], group["n"]) if s > 0}
        extra = fit_lengths(sized, goal - whole * size, window) if size else {}
        return group.assign(copies=whole, extra=[extra.get(int(s), 0) for s in group["size"]])

    plan = cut(counts.join(goals, "key").select("key", "source_size", "target", "size", "n").groupBy("key").applyInPandas(fit, PLAN), "mix-plan")
    # The lower bits of the hash deal a large group out, in an order that is as good as any.
    part = F.pmod("draw", F.ceil(F.col("n") / GROUP_ROWS).cast("long")).alias("part")
    group = ["key", "size", "part"]
    chosen_from = plan.where("extra > 0 AND extra < n").select("key", "size", "n", "extra")
    drawn = base.select("key", "size", "draw").join(chosen_from, ["key", "size"]).groupBy("key", "size", part, "extra").agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("key", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    quota = drawn.select(*group, F.greatest(F.least(F.col("extra") - before, F.col("rows")), F.lit(0)).alias("quota"))
    rows = base.join(plan, ["key", "size"]).withColumn("part", part)
    whole = rows.where("extra = 0 OR extra = n").withColumn("more", (F.col("extra") > 0).cast("long"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy("draw"))
    split = rows.where("extra > 0 AND extra < n").join(quota, group).withColumn("more", (place <= F.col("quota")).cast("long"))
    out = [F.col(id_column), F.col(source), F.col("size"), F.col("source_size"), F.col("target"), (F.col("size") * (F.col("copies") + F.col("more"))).alias("taken")]
    return whole.select(*out).union(split.select(*out))


def op13_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mix_to_targets(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
