"""One key with a third of all rows: same results, and no task gets the key whole."""

from decimal import Decimal

from fixtures import dicts, plan_text
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.accounts import platform_transactions
from tidemark.operators.activity import event_totals
from tidemark.operators.ranking import dense_index
from tidemark.plans import models


def test_journey_with_a_repeated_user(spark):
    rows = 900
    users = spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("user_id"),
        *[F.lit("x").alias(c) for c in ["email", "user_role", "user_status", "platform", "country_code"]],
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
        F.lit("2024-01-01").cast("date").alias("registration_date"),
    )
    events = spark.range(rows).select(
        F.lit("hot").alias("user_id"),
        F.lit("2024-01-02").cast("date").alias("event_date"),
        F.lit("e").alias("event_name"),
        F.lit("ios").alias("platform"),
        F.col("id").cast("string").alias("session_id"),
        F.lit("2024-01-02 00:00:00").cast("timestamp_ntz").alias("created_at"),
    )
    tx = spark.createDataFrame(
        [], "transaction_id string, user_id string, amount decimal(12,2), created_at timestamp_ntz, transaction_date date, is_successful int"
    )
    whole = models.int_user_journey(users, events, tx)
    assert whole.count() == rows
    assert whole.where("total_sessions_count = 900").count() == rows // 3


def test_funnel_windows_run_over_levels_not_names(spark):
    names = spark.range(3000).selectExpr(
        "concat('n', id) as event_name", "'web' as platform", "concat('u', id % (id % 7 + 1)) as user_id",
        "'s' as session_id", "date'2024-01-02' as event_date", "timestamp_ntz'2024-01-02 00:00:00' as created_at",
    )
    events = names.union(names.where("event_name < 'n2'"))
    totals = event_totals(events)
    assert models.funnel_levels(totals).count() == totals.select("unique_users_count", "total_events").distinct().count() < 10
    reach = [F.desc("unique_users_count"), F.desc("total_events")]
    in_order = W.orderBy(*reach, F.asc_nulls_last("event_name"))
    plain = totals.select(
        "event_name", F.dense_rank().over(W.orderBy(*reach)).cast("bigint").alias("step"), F.lag("unique_users_count").over(in_order).alias("before"), "unique_users_count"
    )
    want = plain.selectExpr("event_name", "step", "greatest(coalesce(before - unique_users_count, 0), 0) as lost")
    got = models.mart_event_funnel(events).selectExpr("event_name", "funnel_step_order as step", "step_dropoff_users_count as lost")
    assert got.exceptAll(want).count() == 0 and got.count() == 3000


def test_copies_become_a_factor(spark):
    """2,000 copies of a user and 2,000 payments of theirs would be 4,000,000 joined rows."""
    users = spark.range(2000).select(F.lit("hot").alias("user_id"), F.lit("ios").alias("platform"))
    tx = spark.range(2000).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.lit("hot").alias("user_id"),
        F.lit("0.50").cast("decimal(12,2)").alias("amount"),
        F.lit("2024-01-01").cast("date").alias("transaction_date"),
        F.lit(1).alias("is_successful"),
    )
    [row] = dicts(platform_transactions(tx, users))
    assert row["transactions_count"] == 4_000_000 and row["revenue_amount"] == Decimal("2000000.00")
    text = plan_text(platform_transactions(tx, users))
    assert text.index("Join") < text.index("HashAggregate", text.index("Join"))


def test_dense_index_over_gaps(spark):
    df = spark.range(500).select((F.col("id") * F.col("id") + 3).alias("position")).repartition(7)
    got = [(r["position"], r["place"]) for r in dense_index(df, "position", "place", span=1000).collect()]
    assert sorted(got) == [(i * i + 3, i + 1) for i in range(500)]
    assert "SinglePartition" in plan_text(dense_index(df, "position", "place"))


def test_no_nested_loops_in_any_model(spark):
    from fixtures import events, transactions, users

    us, ev, tx = users(spark, []), events(spark, []), transactions(spark, [])
    for df in (
        models.int_user_journey(us, ev, tx),
        models.mart_user_growth(us, ev),
        models.mart_event_funnel(ev),
        models.mart_revenue(tx),
        models.mart_platform_split(us, ev, tx),
    ):
        text = plan_text(df)
        assert "NestedLoop" not in text and "Cartesian" not in text
