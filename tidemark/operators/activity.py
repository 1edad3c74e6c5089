"""Aggregates over events.

Every function takes either staged events or the rollup of them. The rollup
(one row per date, event name, platform, user and session) holds all that the
models ask of events, so a daily run reads the wide event table once, writes
the rollup and builds every model from it.

All grouping is done with built-in aggregates: tasks combine rows before the
shuffle, so a user, session or date with a third of all events sends one row
per task and key. Distinct counts shuffle on the counted value as well as the
group, so a hot group is spread, too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLLUP_KEYS = ["event_date", "event_name", "platform", "user_id", "session_id"]


def as_activity(events: DataFrame) -> DataFrame:
    """Staged events in rollup layout, one row per event; a rollup as it is."""
    if "events_in_row" in events.columns:
        return events
    return events.select(
        *ROLLUP_KEYS,
        F.lit(1).cast("bigint").alias("events_in_row"),
        F.col("created_at").alias("first_at"),
        F.col("created_at").alias("last_at"),
    )


def activity_rollup(events: DataFrame) -> DataFrame:
    return as_activity(events).groupBy(*ROLLUP_KEYS).agg(
        F.sum("events_in_row").alias("events_in_row"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
    )


def user_events_summary(events: DataFrame) -> DataFrame:
    """Lifetime activity per known user."""
    return (
        as_activity(events)
        .where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.min("first_at").alias("first_event_at"),
            F.max("last_at").alias("last_event_at"),
            F.min("event_date").alias("first_event_date"),
            F.max("event_date").alias("last_event_date"),
            F.sum("events_in_row").alias("total_events_count"),
            F.count_distinct("event_date").alias("total_active_days"),
            F.count_distinct("session_id").alias("total_sessions_count"),
        )
    )


def dau(events: DataFrame) -> DataFrame:
    """Known users active per event date."""
    return (
        as_activity(events)
        .groupBy(F.col("event_date").alias("metric_date"))
        .agg(F.count_distinct("user_id").alias("dau_count"))
    )


def user_days(events: DataFrame) -> DataFrame:
    """Distinct (date, user) pairs, with NULLs as values of their own."""
    return as_activity(events).select("event_date", "user_id").distinct()


def event_totals(events: DataFrame) -> DataFrame:
    """Volume per event name."""
    return (
        as_activity(events)
        .groupBy("event_name")
        .agg(
            F.sum("events_in_row").alias("total_events"),
            F.count_distinct("user_id").alias("unique_users_count"),
            F.count_distinct("session_id").alias("unique_sessions_count"),
            F.min("first_at").alias("first_event_seen_at"),
            F.max("last_at").alias("last_event_seen_at"),
        )
    )


def platform_events(events: DataFrame) -> DataFrame:
    """Volume per date and folded platform."""
    return (
        as_activity(events)
        .groupBy(F.col("event_date").alias("metric_date"), "platform")
        .agg(
            F.sum("events_in_row").alias("events_count"),
            F.count_distinct("session_id").alias("sessions_count"),
            F.count_distinct("user_id").alias("active_users_count"),
        )
    )
