"""Cutting the rows of one key into parts of time, so that no task has to hold a key with a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PART_ROWS = 100_000
SLOT_MICROS = 60_000_000
EPOCH = "1970-01-01 00:00:00"


def micros(time: str) -> Column:
    """A zone-free time as a number."""
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col(time))


def time_parts(rows: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """``rows`` (key, at in microseconds, ...) with ``part``: numbers that rise with time, of about ``part_rows`` rows each.

    A minute stays whole. The rows per minute are summed up per key: as many values as the
    history has minutes, whatever the number of rows.
    """
    slotted = rows.withColumn("slot", F.floor(F.col("at") / SLOT_MICROS))
    slots = slotted.groupBy("key", "slot").agg(F.count(F.lit(1)).alias("slot_rows"))
    earlier = F.sum("slot_rows").over(W.partitionBy("key").orderBy("slot").rowsBetween(W.unboundedPreceding, -1))
    parts = slots.select("key", "slot", F.floor(F.coalesce(earlier, F.lit(0)) / part_rows).alias("part"))
    return slotted.join(parts, ["key", "slot"]).drop("slot")
