"""Funnels over any ordered steps, per user: which step was reached, when, and where users stop.

A user reaches the first step with any event of it, and a later step with an event of
it that comes after an event that reached the step before, no more than ``within``
later. All choices of events count, not the first match only: what matters of the
past is the latest time at which each step was reached, because a later one leaves
more time for the next step. So one pass over a user's events in time order, with
that many times as its state, is exact.

Events that belong to no step drop out first, and events of one user and time become
one row, so the shuffle carries (user, time, steps). A user with few rows is folded in
one array. A user with many is cut into parts of time, and each step is one pass over
all parts: a part needs of the parts before it only the latest time at which the step
before was reached.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.numbers import round_half_away
from tidemark.operators.parts import EPOCH, PART_ROWS, micros, time_parts
from tidemark.session import written

Step = str | Sequence[str]


def _names(step: Step) -> list[str]:
    return [step] if isinstance(step, str) else list(step)


def step_name(step: Step) -> str:
    return " | ".join(_names(step))


def _time(at: Column) -> Column:
    return F.timestamp_add("MICROSECOND", at, F.lit(EPOCH).cast("timestamp_ntz"))


def _has(steps: str | Column, i: int) -> Column:
    return (F.col(steps) if isinstance(steps, str) else steps).bitwiseAND(F.lit(1 << i)) != 0


def step_marks(events: DataFrame, steps: Sequence[Step], by: Sequence[str] = (), time: str = "created_at") -> DataFrame:
    """(key, at, steps): per user (and ``by``) and time in microseconds, a bit for every step that has an event then."""
    if not 1 <= len(steps) <= 62:
        raise ValueError("a funnel has 1 to 62 steps")
    mask = F.lit(0).cast("bigint")
    for i, step in enumerate(steps):
        mask = mask.bitwiseOR(F.when(F.col("event_name").isin(_names(step)), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint"))
    wanted = sorted({name for step in steps for name in _names(step)})
    return (
        events.where(F.col("event_name").isin(wanted) & F.col("user_id").isNotNull() & F.col(time).isNotNull())
        .groupBy(F.struct("user_id", *by).alias("key"), micros(time).alias("at"))
        .agg(F.bit_or(mask).alias("steps"))
    )


def _folded(marks: DataFrame, count: int, within: int) -> DataFrame:
    """(key, reached): the first time of each step, by one fold over a user's rows in time order."""
    none = F.array_repeat(F.lit(None).cast("bigint"), count)

    def move(state: Column, row: Column) -> Column:
        def reached(before: Column, i: Column) -> Column:
            step_before = F.element_at(state["latest"], F.greatest(i, F.lit(1)))
            on_time = (i == 0) | F.coalesce(row["at"] - step_before <= within, F.lit(False))
            here = F.call_function("bit_get", row["steps"], i) == 1
            return F.when(here & on_time, row["at"])

        latest = F.transform(state["latest"], lambda old, i: F.coalesce(reached(old, i), old))
        first = F.transform(state["first"], lambda old, i: F.coalesce(old, F.element_at(latest, i + 1)))
        return F.struct(latest.alias("latest"), first.alias("first"))

    rows = F.sort_array(F.collect_list(F.struct("at", "steps")))
    start = F.struct(none.alias("latest"), none.alias("first"))
    return marks.groupBy("key").agg(rows.alias("rows")).select("key", F.aggregate("rows", start, move)["first"].alias("reached"))


def _by_parts(marks: DataFrame, count: int, within: int, part_rows: int) -> DataFrame:
    """As ``_folded``, step by step over parts of time; one time per step and part passes between them."""
    rows = time_parts(marks, part_rows)
    rows = written(rows.withColumn("step_1", F.when(_has("steps", 0), F.col("at"))), "funnel-step")
    before = W.partitionBy("key", "part").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    for i in range(1, count):
        last = f"step_{i}"
        ends = rows.groupBy("key", "part").agg(F.max(last).alias("last"))
        carried = F.max("last").over(W.partitionBy("key").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
        state = F.greatest(F.col("carried"), F.max(last).over(before))
        rows = written(
            rows.join(ends.select("key", "part", carried.alias("carried")), ["key", "part"])
            .withColumn("state", state)
            .withColumn(f"step_{i + 1}", F.when(_has("steps", i) & (F.col("at") - F.col("state") <= within), F.col("at")))
            .drop("carried", "state"),
            "funnel-step",
        )
    return rows.groupBy("key").agg(F.array(*(F.min(f"step_{i + 1}") for i in range(count))).alias("reached"))


def step_progress(
    events: DataFrame,
    steps: Sequence[Step],
    within: timedelta,
    by: Sequence[str] = (),
    time: str = "created_at",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """user_id, ``by``, steps_reached and reached_at (first time per step, NULL if never) of users at the first step.

    A step is an event name or several of which any counts. Each step needs an event at a
    later time than the one before. ``within`` is the longest time between two steps. Rows
    without user or time are in no funnel; a NULL in ``by`` is a value of its own. Users with
    more than ``part_rows`` different times take the second way; the results are the same.
    """
    count, limit = len(steps), int(within / timedelta(microseconds=1))
    marks = written(step_marks(events, steps, by, time), "funnel-marks")
    large = written(marks.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > part_rows), "funnel-large")
    if large.isEmpty():
        reached = _folded(marks, count, limit)
    else:
        few = _folded(marks.join(large, "key", "left_anti"), count, limit)
        reached = few.union(_by_parts(marks.join(large, "key", "left_semi"), count, limit, part_rows))
    return reached.where(F.col("reached")[0].isNotNull()).select(
        "key.*",
        F.size(F.filter("reached", lambda t: t.isNotNull())).alias("steps_reached"),
        F.transform("reached", _time).alias("reached_at"),
    )


def ordered_funnel(progress: DataFrame, steps: Sequence[Step], by: Sequence[str] = ()) -> DataFrame:
    """Per step (and ``by``): users, losses and rates as in the funnel by volume, and the mean seconds since the step before.

    One grouping of one row per user, without a window; steps that nobody reached are there with 0 users.
    """
    def first(i: int) -> Column:
        return F.col("reached_at")[i]

    sums = []
    for i in range(len(steps)):
        sums.append(F.count_if(first(i).isNotNull()).alias(f"users_{i}"))
        if i:
            sums.append(F.sum(F.timestamp_diff("MICROSECOND", first(i - 1), first(i))).alias(f"micros_{i}"))
    totals = progress.groupBy(*by).agg(*sums) if by else progress.agg(*sums)
    rows = []
    for i, step in enumerate(steps):
        users, before, top = F.col(f"users_{i}"), F.col(f"users_{max(i - 1, 0)}"), F.col("users_0")
        rows.append(
            F.struct(
                F.lit(i + 1).alias("step_order"),
                F.lit(step_name(step)).alias("step_name"),
                users.alias("users_count"),
                (before - users).alias("step_dropoff_users_count"),
                F.when(before > 0, round_half_away(users / before, 4)).otherwise(0.0).alias("step_conversion_rate"),
                F.when(top > 0, round_half_away(users / top, 4)).otherwise(0.0).alias("overall_conversion_rate"),
                (F.when(users > 0, round_half_away(F.col(f"micros_{i}") / users / 1_000_000, 0)) if i else F.lit(None).cast("double")).alias("mean_seconds"),
            )
        )
    return totals.select(*by, F.inline(F.array(*rows)))
