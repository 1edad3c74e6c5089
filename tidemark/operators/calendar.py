"""Dates and date-platform pairs that have data; days without any are absent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar_dates(users: DataFrame, events: DataFrame) -> DataFrame:
    """Registration and event dates; a missing time gives one NULL date."""
    registered = users.select(F.col("registration_date").alias("metric_date"))
    active = events.select(F.col("event_date").alias("metric_date"))
    return registered.union(active).distinct()


def calendar_platforms(*daily: DataFrame) -> DataFrame:
    """Distinct (date, platform) pairs of several daily tables."""
    pairs = [df.select("metric_date", "platform") for df in daily]
    return reduce(DataFrame.union, pairs).distinct()
