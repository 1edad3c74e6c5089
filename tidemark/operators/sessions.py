"""Sessions by inactivity: a user's events belong together while less than ``gap`` passes between them.

Two events in one slot of the length of the gap are always less than a gap apart, so each
task first combines the events of a user and slot into one row. What is put in order per
user is slots, of which there are no more than the history has gaps, however many events
a user has.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def gap_micros(gap: timedelta) -> int:
    micros = gap // timedelta(microseconds=1)
    if micros <= 1:
        raise ValueError("the gap between sessions must be longer than a microsecond")
    return micros


def session_facts(time: str) -> list[Column]:
    """What is kept of a session; the same in batch and stream. Ties in time go by event id."""
    order = F.struct(F.col(time), F.col("event_id"))
    return [
        F.min(time).alias("session_start"),
        F.max(time).alias("session_end"),
        F.count(F.lit(1)).alias("events_count"),
        F.min(F.struct(order.alias("order"), F.col("event_name"))).alias("entry"),
        F.max(F.struct(order.alias("order"), F.col("event_name"))).alias("exit"),
    ]


def session_columns() -> list[Column]:
    return [
        F.col("user_id"),
        F.col("session_start"),
        F.col("session_end"),
        F.timestamp_diff("SECOND", F.col("session_start"), F.col("session_end")).alias("duration_seconds"),
        F.col("events_count"),
        F.col("entry.event_name").alias("entry_event"),
        F.col("exit.event_name").alias("exit_event"),
    ]


def sessionize(events: DataFrame, gap: timedelta, time: str = "created_at") -> DataFrame:
    """One row per session of known users; rows without user or time are in none.

    An event exactly ``gap`` after the one before starts a new session.
    """
    micros = gap_micros(gap)
    at = F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col(time))
    slots = (
        events.where(F.col("user_id").isNotNull() & F.col(time).isNotNull())
        .groupBy("user_id", F.floor(at / micros).alias("slot"))
        .agg(*session_facts(time))
    )
    in_order = W.partitionBy("user_id").orderBy("slot")
    quiet = F.timestamp_diff("MICROSECOND", F.lag("session_end").over(in_order), F.col("session_start"))
    return (
        slots.withColumn("opens", F.when(quiet < micros, 0).otherwise(1))
        .withColumn("session_no", F.sum("opens").over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow)))
        .groupBy("user_id", "session_no")
        .agg(
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            F.sum("events_count").alias("events_count"),
            F.min("entry").alias("entry"),
            F.max("exit").alias("exit"),
        )
        .select(*session_columns())
    )


def session_metrics(sessions: DataFrame) -> DataFrame:
    """Per date of the session's start: sessions, users, events, total and longest duration, and sessions of one event."""
    return sessions.groupBy(F.to_date("session_start").alias("metric_date")).agg(
        F.count(F.lit(1)).alias("sessions_count"),
        F.count_distinct("user_id").alias("users_count"),
        F.sum("events_count").alias("events_count"),
        F.sum("duration_seconds").alias("total_seconds"),
        F.max("duration_seconds").alias("longest_seconds"),
        F.count_if(F.col("events_count") == 1).alias("single_event_sessions"),
    )
