"""The user journey and the four published tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import round_half_away
from tidemark.operators.accounts import (
    daily_new_users,
    daily_revenue,
    platform_registrations,
    platform_transactions,
    user_transactions_summary,
)
from tidemark.operators.activity import event_totals, platform_events, user_days, user_events_summary
from tidemark.operators.rolling import GROWTH_WINDOWS, activity_changes, by_date
from tidemark.schemas import MONEY_TOTAL


def _ratio(part: Column, whole: Column, digits: int) -> Column:
    return round_half_away(part.cast("double") / whole.cast("double"), digits)


def _zero(*names: str) -> list[Column]:
    return [F.coalesce(F.col(name), F.lit(0)).alias(name) for name in names]


def int_user_journey(users: DataFrame, events: DataFrame, transactions: DataFrame) -> DataFrame:
    """Every user with lifetime activity, payments and conversion flags.

    Events and payments are reduced to one row per user and meet on the partitioning of
    that grouping; the user rows join them last. An id that many user rows share is an
    error that the checks report; the join still only has to pass each row once.
    """
    lifetime = user_events_summary(events).join(user_transactions_summary(transactions), "user_id", "full")
    paid_after = F.datediff("first_transaction_date", "registration_date")
    return users.join(lifetime, "user_id", "left").select(
        "user_id",
        "email",
        "user_role",
        "user_status",
        F.col("platform").alias("registration_platform"),
        "country_code",
        F.col("created_at").alias("registered_at"),
        "registration_date",
        *_zero("total_events_count", "total_active_days", "total_sessions_count"),
        "first_event_at",
        "last_event_at",
        "first_event_date",
        "last_event_date",
        *_zero("total_transactions_count", "successful_transactions_count"),
        F.coalesce("lifetime_value_amount", F.lit(0)).cast(MONEY_TOTAL).alias("lifetime_value_amount"),
        "first_transaction_at",
        "last_transaction_at",
        "first_transaction_date",
        "last_transaction_date",
        F.col("first_event_at").isNotNull().cast("int").alias("has_performed_event"),
        F.when(F.col("successful_transactions_count") > 0, 1).otherwise(0).alias("has_converted_paying"),
        paid_after.alias("days_to_first_transaction"),
    )


def mart_user_growth(
    users: DataFrame, events: DataFrame, windows: Mapping[str, int] | None = None
) -> DataFrame:
    """Active users per day, week and month, registrations and stickiness.

    Activity and registrations are stacked and summed per date: one grouping
    instead of a calendar with joins. The last step runs over one row per date.
    """
    windows = windows or GROWTH_WINDOWS
    rolled = list(windows)
    dated = F.col("metric_date").isNotNull()
    active = activity_changes(user_days(events), windows).withColumn(
        "new_registrations_count", F.lit(0).cast("bigint")
    )
    registered = daily_new_users(users).select(
        "metric_date",
        F.lit(1).cast("bigint").alias("in_data"),
        *[F.lit(0).cast("bigint").alias(name) for name in ["dau_count", *rolled]],
        F.when(dated, F.col("new_registrations_count")).otherwise(0).alias("new_registrations_count"),
    )
    counted = ["in_data", "dau_count", *rolled, "new_registrations_count"]
    per_date = active.unionByName(registered).groupBy("metric_date").agg(*[F.sum(n).alias(n) for n in counted])
    running = per_date.select(
        "metric_date",
        "in_data",
        "dau_count",
        *[F.when(dated, F.sum(n).over(by_date())).otherwise(0).alias(n) for n in rolled],
        "new_registrations_count",
        F.sum("new_registrations_count").over(by_date()).alias("cumulative_total_users"),
    ).where(F.col("in_data") > 0)
    return running.select(
        "metric_date",
        "dau_count",
        *rolled,
        "new_registrations_count",
        "cumulative_total_users",
        F.when(F.col("mau_count") > 0, _ratio(F.col("dau_count"), F.col("mau_count"), 4))
        .otherwise(0.0)
        .alias("dau_to_mau_stickiness_ratio"),
    )


def funnel_levels(totals: DataFrame) -> DataFrame:
    """Per distinct (users, events) of event names: the step, and reach at and before the level's first name.

    Names are free text, so no window runs over them. One row per distinct number of users
    is ranked in one place: n different numbers need n * n / 2 users of names, so there are
    few. Inside a number of users its distinct volumes are ranked by themselves.
    """
    pairs = totals.groupBy("unique_users_count", "total_events").agg(
        F.min(F.struct(F.col("event_name").isNull(), "event_name")).alias("first_name")
    )
    levels = pairs.groupBy("unique_users_count").agg(F.count(F.lit(1)).alias("volumes"), F.max("total_events").alias("top_volume"))
    falling = W.orderBy(F.desc("unique_users_count"))
    levels = levels.select(
        "unique_users_count",
        "top_volume",
        F.coalesce(F.sum("volumes").over(falling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("steps_above"),
        F.lag("unique_users_count").over(falling).alias("users_above"),
        F.first("unique_users_count").over(falling).alias("users_at_top"),
    )
    inside = W.partitionBy("unique_users_count").orderBy(F.desc("total_events"))
    return pairs.withColumn("place", F.row_number().over(inside)).join(levels, "unique_users_count").select(
        "unique_users_count",
        "total_events",
        (F.col("steps_above") + F.col("place")).cast("bigint").alias("funnel_step_order"),
        F.when(F.col("place") == 1, F.col("first_name.event_name")).alias("first_name"),
        (F.col("place") == 1).alias("top_of_level"),
        "users_above",
        "users_at_top",
    )


def mart_event_funnel(events: DataFrame) -> DataFrame:
    """Event names ordered by reach, with rates to the step before and to the top.

    Names with equal reach and volume share a step; the name decides which of them comes
    first. The name before has the same reach, save for the first name of a reach.
    """
    totals = event_totals(events)
    levels = funnel_levels(totals)
    opens = F.col("top_of_level") & F.col("event_name").eqNullSafe(F.col("first_name"))
    steps = totals.join(levels, ["unique_users_count", "total_events"]).withColumn(
        "users_before", F.when(opens, F.col("users_above")).otherwise(F.col("unique_users_count"))
    )
    users, before, top = F.col("unique_users_count"), F.col("users_before"), F.col("users_at_top")
    return steps.select(
        "funnel_step_order",
        F.concat(
            F.lit("Step "), F.col("funnel_step_order").cast("string"), F.lit(": "), F.col("event_name")
        ).alias("step_name"),
        "event_name",
        "total_events",
        "unique_users_count",
        "unique_sessions_count",
        F.when(before > 0, _ratio(users, before, 4)).otherwise(1.0).alias("step_conversion_rate"),
        F.when(top > 0, _ratio(users, top, 4)).otherwise(1.0).alias("overall_conversion_rate"),
        F.greatest(F.coalesce(before - users, F.lit(0)), F.lit(0)).cast("bigint").alias("step_dropoff_users_count"),
    )


def mart_revenue(transactions: DataFrame) -> DataFrame:
    """Daily and running revenue per currency and payment method (dates with payments only)."""
    so_far = (
        W.partitionBy("currency", "payment_method")
        .orderBy(F.col("metric_date").asc_nulls_last())
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    paid = F.col("daily_successful_transactions")
    return daily_revenue(transactions).select(
        "metric_date",
        "currency",
        "payment_method",
        "total_transactions_count",
        "daily_successful_transactions",
        "daily_failed_transactions",
        "daily_paying_users_count",
        "daily_gross_revenue",
        F.when(paid > 0, _ratio(F.col("daily_gross_revenue"), paid, 2)).otherwise(0.0).alias("daily_average_order_value"),
        F.sum("daily_gross_revenue").over(so_far).cast(MONEY_TOTAL).alias("cumulative_total_revenue"),
    )


PLATFORM_COUNTS = ["active_users_count", "events_count", "sessions_count", "registrations_count", "transactions_count"]


def mart_platform_split(
    users: DataFrame, events: DataFrame, transactions: DataFrame, null_safe: bool = False
) -> DataFrame:
    """Activity, registrations and revenue per date and platform.

    The three daily tables are stacked and summed per (date, platform). Figures
    of rows without a date or platform, such as the payments of unknown users,
    are zero unless ``null_safe``: the published table matches on equality.
    """
    figures = [*PLATFORM_COUNTS, "revenue_amount"]
    kinds = {name: "bigint" for name in PLATFORM_COUNTS} | {"revenue_amount": MONEY_TOTAL}
    known = F.col("metric_date").isNotNull() & F.col("platform").isNotNull()

    def stackable(df: DataFrame) -> DataFrame:
        def figure(name: str) -> Column:
            value = F.col(name) if name in df.columns else F.lit(0)
            if name in df.columns and not null_safe:
                value = F.when(known, value).otherwise(0)
            return value.cast(kinds[name]).alias(name)

        return df.select("metric_date", "platform", *[figure(name) for name in figures])

    grid = (
        stackable(platform_events(events))
        .union(stackable(platform_registrations(users)))
        .union(stackable(platform_transactions(transactions, users)))
        .groupBy("metric_date", "platform")
        .agg(*[F.sum(name).cast(kinds[name]).alias(name) for name in figures])
    )
    day_total = F.sum("events_count").over(W.partitionBy("metric_date"))
    return grid.withColumn("day_events", day_total).select(
        "metric_date",
        "platform",
        *figures,
        F.when(F.col("day_events") > 0, _ratio(F.col("events_count"), F.col("day_events"), 4))
        .otherwise(0.0)
        .alias("platform_event_share_ratio"),
    )


# Reading order of each published table; applied by consumers, not stored.
MART_ORDER = {
    "mart_user_growth": [F.asc_nulls_last, ["metric_date"]],
    "mart_event_funnel": [F.asc_nulls_last, ["funnel_step_order", "event_name"]],
    "mart_revenue": [F.desc_nulls_last, ["metric_date"], F.asc_nulls_last, ["currency", "payment_method"]],
    "mart_platform_split": [F.desc_nulls_last, ["metric_date"], F.asc_nulls_last, ["platform"]],
}


def in_reading_order(name: str, mart: DataFrame) -> DataFrame:
    spec = MART_ORDER[name]
    order = [direction(column) for direction, columns in zip(spec[::2], spec[1::2]) for column in columns]
    return mart.orderBy(*order)
