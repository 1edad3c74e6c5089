"""Aggregates over users and transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import MONEY_TOTAL


def successful_amount() -> Column:
    """Gross amount of the successful transactions of a group, 0 if there are none."""
    paid = F.when(F.col("is_successful") == 1, F.col("amount")).otherwise(F.lit(0).cast("decimal(12,2)"))
    return F.coalesce(F.sum(paid), F.lit(0)).cast(MONEY_TOTAL)


def user_transactions_summary(transactions: DataFrame) -> DataFrame:
    """Lifetime payments per known user; firsts and lasts are over any status."""
    return (
        transactions.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.min("created_at").alias("first_transaction_at"),
            F.max("created_at").alias("last_transaction_at"),
            F.min("transaction_date").alias("first_transaction_date"),
            F.max("transaction_date").alias("last_transaction_date"),
            F.count("transaction_id").alias("total_transactions_count"),
            F.sum("is_successful").alias("successful_transactions_count"),
            successful_amount().alias("lifetime_value_amount"),
        )
    )


def daily_new_users(users: DataFrame) -> DataFrame:
    return users.groupBy(F.col("registration_date").alias("metric_date")).agg(
        F.count_distinct("user_id").alias("new_registrations_count")
    )


def platform_registrations(users: DataFrame) -> DataFrame:
    return users.groupBy(F.col("registration_date").alias("metric_date"), "platform").agg(
        F.count_distinct("user_id").alias("registrations_count")
    )


def daily_revenue(transactions: DataFrame) -> DataFrame:
    """Payments per date, currency and method."""
    return transactions.groupBy(
        F.col("transaction_date").alias("metric_date"), "currency", "payment_method"
    ).agg(
        F.count("transaction_id").alias("total_transactions_count"),
        F.sum("is_successful").alias("daily_successful_transactions"),
        F.sum(1 - F.col("is_successful")).cast("bigint").alias("daily_failed_transactions"),
        F.count_distinct(F.when(F.col("is_successful") == 1, F.col("user_id"))).alias("daily_paying_users_count"),
        successful_amount().alias("daily_gross_revenue"),
    )


def platform_transactions(transactions: DataFrame, users: DataFrame) -> DataFrame:
    """Payments per date and platform of the paying user.

    A user id that occurs n times in ``users`` counts each payment n times, an
    unknown one gives platform NULL. Both sides are aggregated before the join
    (payments per date and user, copies per user and platform), so a user with
    a third of the payments joins with at most one row per day, and copies
    become a factor instead of a product of rows.
    """
    paid = transactions.groupBy("transaction_date", "user_id").agg(
        F.count("transaction_id").alias("n"), successful_amount().alias("gross")
    )
    copies = (
        users.where(F.col("user_id").isNotNull())
        .groupBy("user_id", "platform")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    factor = F.coalesce("copies", F.lit(1))
    return (
        paid.join(copies, "user_id", "left")
        .groupBy(F.col("transaction_date").alias("metric_date"), "platform")
        .agg(
            F.sum(F.col("n") * factor).alias("transactions_count"),
            F.sum(F.col("gross").cast("decimal(27,2)") * factor.cast("decimal(10,0)"))
            .cast(MONEY_TOTAL)
            .alias("revenue_amount"),
        )
    )
