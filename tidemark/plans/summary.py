"""The last-N-days summary of stored events, and the filters offered on them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import nonblank_or

DEFAULT_DAYS = 30
TOP_EVENTS = 10


def parse_days(text: object, policy: str = "default") -> int:
    """The ``days`` argument of a summary request.

    ``default``: text that is no integer means 30; ``range``: an integer from 1
    to 365 or ValueError; ``prefix``: the leading integer of the text, else 0.
    """
    raw = str(DEFAULT_DAYS if text is None else text).strip()
    if policy == "prefix":
        sign, digits = (raw[:1], raw[1:]) if raw[:1] in ("+", "-") else ("", raw)
        lead = len(digits) - len(digits.lstrip("0123456789"))
        return int(sign + digits[:lead]) if lead else 0
    if policy not in ("default", "range"):
        raise ValueError(f"unknown policy {policy!r}")
    try:
        days = int(raw)
    except ValueError:
        if policy == "range":
            raise
        return DEFAULT_DAYS
    if policy == "range" and not 1 <= days <= 365:
        raise ValueError("days must be from 1 to 365")
    return days


def events_filtered(
    events: DataFrame,
    name: str | None = None,
    category: str | None = None,
    user: str | int | None = None,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    platform: str | None = None,
    time: str = "occurred_at",
) -> DataFrame:
    """Events that match all given filters; both ends of the time range count.

    The platform asked for is lower-cased, the stored one is taken as it is.
    """
    if (start is None) != (end is None):
        raise ValueError("give both ends of the time range")
    wanted: list[Column] = []
    if name is not None:
        wanted.append(F.col("event_name") == name)
    if category is not None:
        wanted.append(F.col("event_category") == category)
    if user is not None:
        wanted.append(F.col("user_id") == str(user))
    if start is not None:
        low, high = (F.lit(str(t)).cast("timestamp_ntz") for t in (start, end))
        wanted.append(F.col(time).between(low, high))
    if platform is not None:
        wanted.append(F.col("platform") == platform.lower())
    for condition in wanted:
        events = events.where(condition)
    return events


def events_since(events: DataFrame, as_of: str | datetime, days: int, time: str = "occurred_at") -> DataFrame:
    cutoff = F.lit(str(as_of)).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))
    return events.where(F.col(time) >= cutoff)


def top_events(events: DataFrame, k: int = TOP_EVENTS) -> DataFrame:
    """The k most frequent event names (a top-k report); ties go by name."""
    return (
        events.groupBy("event_name")
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy(F.desc("total"), F.asc_nulls_last("event_name"))
        .limit(k)
    )


def event_metrics_summary(
    events: DataFrame,
    as_of: str | datetime,
    days: int = DEFAULT_DAYS,
    null_platform: str | None = None,
    time: str = "occurred_at",
) -> dict[str, DataFrame]:
    """Totals, top events and platforms of the events since ``as_of`` - ``days``.

    With ``null_platform`` a missing or empty platform is counted under that name.
    """
    recent = events_since(events, as_of, days, time)
    return {
        "totals": recent.agg(
            F.count(F.lit(1)).alias("total_events"), F.count_distinct("user_id").alias("unique_users")
        ),
        "top_events": top_events(recent),
        "platforms": recent.groupBy(_platform(null_platform).alias("platform")).agg(
            F.count(F.lit(1)).alias("total")
        ),
    }


def _platform(null_platform: str | None) -> Column:
    if null_platform is None:
        return F.col("platform")
    return nonblank_or(F.col("platform"), null_platform)


# Which of (event_name, platform, user_id) a grouping set leaves out, as bits.
SECTIONS = {0b011: "top_events", 0b101: "platforms", 0b110: "unique_users", 0b111: "total_events"}


def summary_report(
    events: DataFrame,
    as_of: str | datetime,
    days: int = DEFAULT_DAYS,
    null_platform: str | None = None,
    time: str = "occurred_at",
    k: int = TOP_EVENTS,
) -> DataFrame:
    """The same summary as (section, name, total) rows, in one pass over the events.

    Events are first counted per name, platform and user. Grouping sets then sum these
    counts per event name, per platform, per user and in all; the rows per user shrink
    to their number before anything is ranked. Platforms are read by falling total, then name.
    """
    recent = events_since(events, as_of, days, time).select(
        "event_name", _platform(null_platform).alias("platform"), "user_id"
    )
    section = F.create_map(*[F.lit(x) for pair in SECTIONS.items() for x in pair])
    once = recent.groupBy("event_name", "platform", "user_id").agg(F.count(F.lit(1)).alias("n"))
    counted = once.groupingSets(
        [["event_name"], ["platform"], ["user_id"], []], "event_name", "platform", "user_id"
    ).agg(F.grouping_id().cast("int").alias("left_out"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    of_users = F.col("section") == "unique_users"
    small = (
        counted.withColumn("section", section[F.col("left_out")])
        .groupBy("section", F.coalesce("event_name", "platform").alias("name"))
        .agg(
            F.sum(F.when(of_users, F.when(F.col("user_id").isNotNull(), 1).otherwise(0)).otherwise(F.col("n")))
            .cast("bigint")
            .alias("total")
        )
    )
    # Rows of other sections rank alone, so one rank limit fits all and is applied before the shuffle.
    alone = F.when(F.col("section") != "top_events", F.col("name"))
    place = F.row_number().over(
        W.partitionBy("section", alone).orderBy(F.desc("total"), F.asc_nulls_last("name"))
    )
    return small.withColumn("place", place).where(F.col("place") <= k).select("section", "name", "total")
