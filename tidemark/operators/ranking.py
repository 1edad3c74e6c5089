"""Latest rows, first and last rows, smallest k, and a dense running index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_row(df: DataFrame, date: str = "metric_date") -> DataFrame:
    """The row of the latest date (top-1 per task, then overall)."""
    return df.orderBy(F.col(date).desc_nulls_last()).limit(1)


def latest_slice(df: DataFrame, date: str = "metric_date") -> DataFrame:
    """All rows of the latest date, in one pass over ``df``.

    A rank filter lets every task drop all but its own latest date before the
    shuffle; comparing with a subquery's maximum would compute ``df`` twice.
    """
    newest_first = W.orderBy(F.col(date).desc_nulls_last())
    return (
        df.where(F.col(date).isNotNull())
        .withColumn("date_rank", F.rank().over(newest_first))
        .where(F.col("date_rank") == 1)
        .drop("date_rank")
    )


def first_last_step(funnel: DataFrame) -> DataFrame:
    """One row: the first and the last funnel row in step order."""
    order = F.struct("funnel_step_order", "event_name")
    row = F.struct("event_name", "unique_users_count", "overall_conversion_rate")
    return funnel.agg(F.min_by(row, order).alias("first"), F.max_by(row, order).alias("last")).select(
        F.col("first.event_name").alias("first_event_name"),
        F.col("first.unique_users_count").alias("first_users_count"),
        F.col("last.event_name").alias("last_event_name"),
        F.col("last.unique_users_count").alias("last_users_count"),
        F.col("last.overall_conversion_rate").alias("last_overall_conversion_rate"),
    )


def dense_index(df: DataFrame, order: str, index: str, span: int = 1_000_000) -> DataFrame:
    """Number rows 1, 2, ... by ``order``, a unique whole number such as a row position.

    Positions are cut into spans; a task numbers the rows of its spans (at most
    ``span`` rows each, as positions are unique) and shifts them by the size of
    all earlier spans. Only the span sizes are summed up in one place: one row
    per span, read from the position column alone.
    """
    cut = df.withColumn("span_no", F.floor(F.col(order) / span))
    sizes = cut.groupBy("span_no").agg(F.count(F.lit(1)).alias("span_rows"))
    earlier = W.orderBy("span_no").rowsBetween(W.unboundedPreceding, -1)
    shifts = sizes.select("span_no", F.coalesce(F.sum("span_rows").over(earlier), F.lit(0)).alias("shift"))
    inside = W.partitionBy("span_no").orderBy(order)
    return (
        cut.withColumn("place_in_span", F.row_number().over(inside))
        .join(shifts, "span_no")
        .select(*df.columns, (F.col("place_in_span") + F.col("shift")).alias(index))
    )
