"""Distinct counts that merge: HyperLogLog sketches per date and platform, kept next to the rollup.

A sketch takes at most some 2**k bytes, whatever it has counted, and sketches of any
dates and platforms unite. So users over any span are answered from the stored sketches,
without the events or the user days. The relative standard error is 1.04 / sqrt(2**k);
the exact forms are ``dau``, ``wau_mau`` and ``platform_events``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.activity import as_activity

LG_K = 12


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / math.sqrt(2**lg_k)


def actives_sketches(events: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(metric_date, platform, users_sketch, sessions_sketch); NULL users and sessions are not counted."""
    return (
        as_activity(events)
        .groupBy(F.col("event_date").alias("metric_date"), "platform")
        .agg(F.hll_sketch_agg("user_id", lg_k).alias("users_sketch"), F.hll_sketch_agg("session_id", lg_k).alias("sessions_sketch"))
    )


def merge_sketches(*tables: DataFrame) -> DataFrame:
    """Tables of sketches as one, such as the stored dates and a load with late events of some of them."""
    whole = tables[0]
    for more in tables[1:]:
        whole = whole.unionByName(more)
    return _united(whole, "metric_date", "platform")


def _united(sketches: DataFrame, *keys: str) -> DataFrame:
    return sketches.groupBy(*keys).agg(*(F.hll_union_agg(c).alias(c) for c in ("users_sketch", "sessions_sketch")))


def _estimates(sketches: DataFrame) -> DataFrame:
    return sketches.select(
        *[c for c in sketches.columns if not c.endswith("_sketch")],
        F.hll_sketch_estimate("users_sketch").alias("active_users"),
        F.hll_sketch_estimate("sessions_sketch").alias("sessions"),
    )


def span_actives(sketches: DataFrame, start: str | None = None, end: str | None = None, by_platform: bool = True) -> DataFrame:
    """Estimated users and sessions of a span of dates, both ends included, per platform or over all."""
    if start is not None:
        sketches = sketches.where(F.col("metric_date") >= F.lit(start).cast("date"))
    if end is not None:
        sketches = sketches.where(F.col("metric_date") <= F.lit(end).cast("date"))
    return _estimates(_united(sketches, *(["platform"] if by_platform else [])))


def rolling_actives(sketches: DataFrame, windows: Iterable[int] = (1, 7, 30), by_platform: bool = True) -> DataFrame:
    """Estimated users and sessions in the last n days of each date that has a sketch.

    Each sketch goes to the next n dates: rows of dates times platforms, not of users.
    Dates without events have no row.
    """
    keys = ["platform"] if by_platform else []
    daily = _united(sketches.where(F.col("metric_date").isNotNull()), "metric_date", *keys)
    dates = daily.select("metric_date", *keys).distinct() if by_platform else daily.select("metric_date")
    spread = daily.select(
        F.explode(F.array(*(F.lit(n) for n in windows))).alias("days"), F.col("metric_date").alias("day"), *keys, "users_sketch", "sessions_sketch"
    ).select(
        "days", F.explode(F.sequence("day", F.date_add("day", F.col("days") - 1))).alias("metric_date"), *keys, "users_sketch", "sessions_sketch"
    )
    return _estimates(_united(spread.join(dates, ["metric_date", *keys], "left_semi"), "metric_date", *keys, "days"))
