"""Paths: which events follow each other within a session, as transitions and as sequences of any length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.numbers import round_half_away
from tidemark.operators.parts import PART_ROWS, micros, time_parts
from tidemark.session import written

SESSION = ("user_id", "session_id")


def event_runs(
    events: DataFrame,
    length: int,
    keys: Sequence[str] = SESSION,
    time: str = "created_at",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """(key, path): every ``length`` neighbouring events of a session, by time and then event id; events without a time are left out.

    NULLs in ``keys`` are values of their own. A session of more than ``part_rows`` events,
    such as the one that all events without a session share, is cut into parts of time. A
    part borrows the first events of the parts after it, and counts no path from these.
    """
    if length < 2:
        raise ValueError("a path has two events or more")
    rows = events.where(F.col(time).isNotNull()).select(F.struct(*keys).alias("key"), micros(time).alias("at"), "event_id", "event_name")
    large = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part_rows).select("key"), "path-large")
    if large.isEmpty():
        return _neighbours(rows.select("*", F.lit(0).alias("part"), F.lit(True).alias("own")), length)
    few = rows.join(large, "key", "left_anti").select("*", F.lit(0).cast("bigint").alias("part"), F.lit(True).alias("own"))
    parts = written(time_parts(rows.join(large, "key", "left_semi"), part_rows), "path-parts")
    # Parts can be short, so the first events go to as many parts before as a path could reach back.
    numbers = parts.select("key", "part").distinct()
    by_part = W.partitionBy("key").orderBy("part")
    before = F.array_compact(F.array(*(F.lag("part", i).over(by_part) for i in range(1, length))))
    first = F.row_number().over(W.partitionBy("key", "part").orderBy("at", "event_id")) < length
    heads = parts.withColumn("first", first).where("first").drop("first").join(numbers.select("key", "part", before.alias("before")), ["key", "part"])
    borrowed = heads.select("key", "at", "event_id", "event_name", F.explode("before").alias("part"), F.lit(False).alias("own"))
    return _neighbours(few.unionByName(parts.withColumn("own", F.lit(True))).unionByName(borrowed), length)


def _neighbours(rows: DataFrame, length: int) -> DataFrame:
    in_order = W.partitionBy("key", "part").orderBy("at", "event_id")
    following = [F.lead("event_name", i).over(in_order) for i in range(1, length)]
    there = F.lead(F.lit(True), length - 1).over(in_order)
    return rows.select("key", "own", F.array("event_name", *following).alias("path"), there.alias("whole")).where("own AND whole").select("key", "path")


def event_paths(events: DataFrame, length: int = 3, keys: Sequence[str] = SESSION, part_rows: int = PART_ROWS) -> DataFrame:
    """path, occurrences and number of sessions with it, of all paths of a length."""
    runs = event_runs(events, length, keys, part_rows=part_rows)
    return (
        runs.groupBy("path", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("path")
        .agg(F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("sessions_count"))
        .select(path_text(F.col("path")).alias("path"), "occurrences", "sessions_count")
    )


def path_text(path: Column) -> Column:
    return F.array_join(path, " > ")


def top_paths(paths: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent paths; equal ones in the order of their text."""
    return paths.orderBy(F.desc("occurrences"), "path").limit(k)


def event_transitions(events: DataFrame, keys: Sequence[str] = SESSION, part_rows: int = PART_ROWS) -> DataFrame:
    """from_event, to_event, how often, and the share of all transitions from there.

    The window runs over the distinct transitions of one event name.
    """
    pairs = event_runs(events, 2, keys, part_rows=part_rows).groupBy(F.col("path")[0].alias("from_event"), F.col("path")[1].alias("to_event"))
    counted = pairs.agg(F.count(F.lit(1)).alias("transitions_count"))
    total = F.sum("transitions_count").over(W.partitionBy("from_event"))
    return counted.withColumn("transition_share", round_half_away(F.col("transitions_count") / total, 4))
