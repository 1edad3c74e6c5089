"""Users active in the last n days, without a range join.

An active day keeps its user "active" for n dates. Per user the days are put
in order, overlapping spans merge, and each span adds 1 on its first date and
takes 1 away on the date after its last. Both are counted by the active day
itself, which leaves one row per date; only these few rows are shifted by n
and summed up along the dates. The work per user-day is one sort inside its
user (as many rows as there are dates at most) and one partial count.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The reported windows in days.
GROWTH_WINDOWS = {"wau_count": 7, "mau_count": 30}


def activity_changes(days: DataFrame, windows: Mapping[str, int]) -> DataFrame:
    """Per date: active users (``dau_count``) and the change of each window's count.

    Every date of ``days`` is present, NULL included, with ``in_data`` above 0;
    rows without a user or date contribute nothing but their date.
    """
    per_user = W.partitionBy("user_id").orderBy(F.col("event_date").asc_nulls_first())
    day, before, after = F.col("event_date"), F.col("day_before"), F.col("day_after")
    real = day.isNotNull() & F.col("user_id").isNotNull()
    counts = [F.count_if(real).alias("dau_count")]
    for name, length in windows.items():
        starts = before.isNull() | (before < F.date_sub(day, length))
        lapses = after.isNull() | (after > F.date_add(day, length))
        counts.append(F.count_if(real & starts).alias(f"{name}_starts"))
        counts.append(F.count_if(real & lapses).alias(f"{name}_lapses"))
    per_day = (
        days.select(
            "event_date",
            "user_id",
            F.lag("event_date").over(per_user).alias("day_before"),
            F.lead("event_date").over(per_user).alias("day_after"),
        )
        .groupBy("event_date")
        .agg(*counts)
    )

    names = ["in_data", "dau_count", *windows]

    def change(date: Column, **values: Column) -> Column:
        filled = [values.get(name, F.lit(0)).cast("bigint").alias(name) for name in names]
        return F.struct(date.alias("metric_date"), *filled)

    on_the_day = {name: F.col(f"{name}_starts") for name in windows}
    changes = [change(day, in_data=F.lit(1), dau_count=F.col("dau_count"), **on_the_day)]
    for name, length in windows.items():
        changes.append(change(F.date_add(day, length), **{name: -F.col(f"{name}_lapses")}))
    return (
        per_day.select(F.inline(F.array(*changes)))
        .groupBy("metric_date")
        .agg(*[F.sum(name).alias(name) for name in names])
    )


def by_date() -> W:
    """Running frame over one row per date: as many rows as the history has days."""
    return W.orderBy(F.col("metric_date").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)


def wau_mau(calendar: DataFrame, days: DataFrame, windows: Mapping[str, int] | None = None) -> DataFrame:
    """Users active in each window that ends on a calendar date; 0 on a NULL date."""
    windows = windows or GROWTH_WINDOWS
    changes = activity_changes(days, windows).where(F.col("metric_date").isNotNull())
    names = list(windows)
    wanted = calendar.select("metric_date", F.lit(True).alias("wanted"), *[F.lit(0).alias(n) for n in names])
    return (
        changes.select("metric_date", F.lit(False).alias("wanted"), *names)
        .union(wanted)
        .groupBy("metric_date")
        .agg(F.max("wanted").alias("wanted"), *[F.sum(n).alias(n) for n in names])
        .select("metric_date", "wanted", *[F.sum(n).over(by_date()).alias(n) for n in names])
        .where("wanted")
        .select(
            "metric_date",
            *[F.when(F.col("metric_date").isNull(), 0).otherwise(F.col(n)).cast("bigint").alias(n) for n in names],
        )
    )


def rolling_users(events: DataFrame, windows: Iterable[int], keys: Iterable[str] = ("platform",)) -> DataFrame:
    """Distinct users of the last n days of each date per ``keys``: (metric_date, keys, days, users); a date that no window reaches has no row.

    An active day counts its user for n dates, or until the user's next active day. Days
    are first counted by how far that is, up to the longest window; only these counts, a
    few per date, are spread over the dates.
    """
    keys, windows = list(keys), sorted(windows)
    days = events.where("event_date IS NOT NULL AND user_id IS NOT NULL").select("event_date", *keys, "user_id").distinct()
    following = F.lead("event_date").over(W.partitionBy(*keys, "user_id").orderBy("event_date"))
    gap = F.least(F.coalesce(F.datediff(following, "event_date"), F.lit(windows[-1])), F.lit(windows[-1]))
    counts = days.select("event_date", *keys, gap.alias("gap")).groupBy("event_date", *keys, "gap").agg(F.count("*").alias("n"))
    spread = counts.select("*", F.explode(F.array(*(F.lit(n) for n in windows))).alias("days"))
    reached = F.sequence("event_date", F.date_add("event_date", F.least("gap", "days") - 1))
    return spread.select(F.explode(reached).alias("metric_date"), *keys, "days", "n").groupBy("metric_date", *keys, "days").agg(F.sum("n").alias("users"))
