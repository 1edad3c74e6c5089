"""Numbers and chart inputs of the report page, from the published tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import nonblank_or, round_exact, threshold_band
from tidemark.operators.ranking import first_last_step, latest_row
from tidemark.schemas import MONEY_TOTAL

# Platforms shown, colour bands, the rate that counts as good.
SHOWN_PLATFORMS = ["ios", "android", "web"]
BAND_NAMES = ["red", "amber", "green"]
STICKINESS_CUTS = [15.0, 30.0]
FUNNEL_CUTS = [40.0, 60.0]
GOOD_STEP_RATE = 80.0

GROWTH_COUNTS = ["dau_count", "wau_count", "mau_count", "new_registrations_count", "cumulative_total_users"]
FUNNEL_COUNTS = ["total_events", "unique_users_count", "unique_sessions_count"]
REVENUE_COUNTS = [
    "total_transactions_count",
    "daily_successful_transactions",
    "daily_failed_transactions",
    "daily_paying_users_count",
]
REVENUE_AMOUNTS = ["daily_gross_revenue", "daily_average_order_value", "cumulative_total_revenue"]
PLATFORM_COUNTS = ["active_users_count", "events_count", "sessions_count", "registrations_count", "transactions_count"]


def _or_zero(names: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(name), F.lit(0)).alias(name) for name in names]


def _as_double(names: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name) for name in names]


def _date_text() -> Column:
    return F.col("metric_date").cast("string").alias("metric_date")


def _text_or(name: str, default: str) -> Column:
    return F.coalesce(F.col(name), F.lit(default)).alias(name)


def growth_series(mart: DataFrame) -> DataFrame:
    return mart.select(_date_text(), *_or_zero(GROWTH_COUNTS), *_as_double(["dau_to_mau_stickiness_ratio"]))


def funnel_series(mart: DataFrame) -> DataFrame:
    return mart.select(
        "funnel_step_order",
        "step_name",
        "event_name",
        *_or_zero(FUNNEL_COUNTS),
        *_as_double(["step_conversion_rate", "overall_conversion_rate"]),
        *_or_zero(["step_dropoff_users_count"]),
    )


def revenue_series(mart: DataFrame) -> DataFrame:
    return mart.select(
        _date_text(),
        _text_or("currency", "BRL"),
        _text_or("payment_method", "all"),
        *_or_zero(REVENUE_COUNTS),
        *_as_double(REVENUE_AMOUNTS),
    )


def platform_series(mart: DataFrame) -> DataFrame:
    return mart.select(
        _date_text(),
        _text_or("platform", "unknown"),
        *_or_zero(PLATFORM_COUNTS),
        *_as_double(["revenue_amount", "platform_event_share_ratio"]),
    )


def percent(ratio: Column, ties: str = "even") -> Column:
    return round_exact(F.coalesce(ratio, F.lit(0.0)) * F.lit(100.0), 1, ties)


def kpi_latest_growth(growth: DataFrame) -> DataFrame:
    """Figures of the latest real date."""
    row = latest_row(growth.where(F.col("metric_date").isNotNull()))
    return row.select(
        F.coalesce("cumulative_total_users", F.lit(0)).alias("total_users"),
        F.coalesce("dau_count", F.lit(0)).alias("current_dau"),
        F.coalesce("wau_count", F.lit(0)).alias("current_wau"),
        F.coalesce("mau_count", F.lit(0)).alias("current_mau"),
        F.coalesce("new_registrations_count", F.lit(0)).alias("new_today"),
        percent(F.col("dau_to_mau_stickiness_ratio")).alias("stickiness_pct"),
    )


def kpi_funnel(funnel: DataFrame) -> DataFrame:
    """Users at the top and bottom step and the end-to-end rate; zeros without steps."""
    return first_last_step(funnel).select(
        F.coalesce("first_users_count", F.lit(0)).alias("funnel_top_users"),
        F.coalesce("last_users_count", F.lit(0)).alias("funnel_bottom_users"),
        percent(F.col("last_overall_conversion_rate")).alias("overall_funnel_pct"),
    )


def kpi_revenue(revenue: DataFrame) -> DataFrame:
    """Revenue figures of the page.

    ``total_gross_revenue`` is the largest running total of any one currency
    and method, as the page shows it; ``true_total_revenue`` adds them all up.
    """
    position = F.struct(
        F.col("metric_date").isNull().alias("undated"),
        F.col("metric_date").alias("date"),
        F.coalesce("currency", F.lit("BRL")).alias("currency"),
        F.coalesce("payment_method", F.lit("all")).alias("method"),
    )
    sums = revenue.agg(
        F.max("cumulative_total_revenue").cast("double").alias("largest"),
        F.coalesce(F.sum("daily_gross_revenue").cast("double"), F.lit(0.0)).alias("gross"),
        F.coalesce(F.sum("total_transactions_count"), F.lit(0)).alias("total_transactions"),
        F.coalesce(F.sum("daily_successful_transactions"), F.lit(0)).alias("successful_transactions"),
        F.coalesce(F.max_by(F.coalesce("currency", F.lit("BRL")), position), F.lit("BRL")).alias("currency"),
    )
    shown = F.when(F.col("largest") > 0, F.col("largest")).otherwise(F.col("gross"))
    paid = F.col("successful_transactions")
    return sums.withColumn("total_gross_revenue", round_exact(shown, 2)).select(
        "total_gross_revenue",
        "total_transactions",
        "successful_transactions",
        F.when(paid > 0, round_exact(F.col("total_gross_revenue") / paid, 2)).otherwise(0.0).alias("avg_order_value"),
        "currency",
        round_exact(F.col("gross"), 2).alias("true_total_revenue"),
    )


def dashboard_kpis(growth: DataFrame, funnel: DataFrame, revenue: DataFrame) -> DataFrame:
    """One row with the figures of all three."""
    parts = [kpi_revenue(revenue), kpi_funnel(funnel), kpi_latest_growth(growth)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    row = stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])
    users = ["total_users", "current_dau", "current_wau", "current_mau"]
    return row.withColumn("stickiness_pct", F.coalesce("stickiness_pct", F.lit(0.0))).select(
        *_or_zero(users),
        "stickiness_pct",
        threshold_band(F.col("stickiness_pct"), STICKINESS_CUTS, BAND_NAMES).alias("stickiness_band"),
        "funnel_top_users",
        "funnel_bottom_users",
        "overall_funnel_pct",
        threshold_band(F.col("overall_funnel_pct"), FUNNEL_CUTS, BAND_NAMES).alias("funnel_band"),
        "total_gross_revenue",
        "total_transactions",
        "successful_transactions",
        "avg_order_value",
        "currency",
    )


def kpi_platform_totals(platform: DataFrame) -> DataFrame:
    """Sums over all dates; users are summed daily counts, not distinct over time."""
    return platform.groupBy(F.coalesce("platform", F.lit("unknown")).alias("platform")).agg(
        F.sum("events_count").cast("bigint").alias("events"),
        F.sum("active_users_count").cast("bigint").alias("users"),
        F.sum(F.col("revenue_amount").cast(MONEY_TOTAL)).cast(MONEY_TOTAL).alias("revenue"),
    )


def revenue_by_date(revenue: DataFrame) -> DataFrame:
    """Per date over all currencies and methods: sum of revenue, largest running total."""
    return revenue.groupBy("metric_date").agg(
        F.sum(F.col("daily_gross_revenue").cast(MONEY_TOTAL)).cast(MONEY_TOTAL).alias("gross_revenue"),
        F.max(F.col("cumulative_total_revenue").cast(MONEY_TOTAL)).alias("max_cumulative_revenue"),
    )


def platform_share(totals: DataFrame, metric: str) -> DataFrame:
    """(platform, value, share_pct) for the three shown platforms and no other.

    One aggregation row is turned into three, so a platform without data still
    shows with 0.
    """
    if metric not in ("users", "events", "revenue"):
        raise ValueError(f"unknown metric {metric!r}")
    value = F.col(metric).cast("double")
    sums = totals.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("platform") == name, value)), F.lit(0.0)).alias(name)
            for name in SHOWN_PLATFORMS
        ]
    )
    rows = sums.withColumn("total", reduce(Column.__add__, [F.col(n) for n in SHOWN_PLATFORMS])).select(
        "total", F.inline(F.array(*[F.struct(F.lit(n).alias("platform"), F.col(n).alias("value")) for n in SHOWN_PLATFORMS]))
    )
    share = F.col("value") / F.col("total") * F.lit(100.0)
    return rows.select(
        "platform",
        "value",
        F.when(F.col("total") > 0, round_exact(share, 1, "up")).otherwise(0.0).alias("share_pct"),
    )


def funnel_table_format(funnel: DataFrame) -> DataFrame:
    """Funnel rows as the page prints them."""

    def shown(name: str) -> Column:
        return F.format_string("%.1f", percent(F.col(name), "up"))

    good = percent(F.col("step_conversion_rate"), "up") >= GOOD_STEP_RATE
    lost = F.coalesce("step_dropoff_users_count", F.lit(0))
    return funnel.select(
        F.concat(F.lit("#"), F.col("funnel_step_order").cast("string")).alias("step"),
        nonblank_or(F.col("step_name"), F.col("event_name")).alias("label"),
        "event_name",
        "unique_users_count",
        "total_events",
        shown("step_conversion_rate").alias("step_rate"),
        F.when(good, "positive").otherwise("neutral").alias("tag"),
        shown("overall_conversion_rate").alias("overall_rate"),
        F.when(lost > 0, F.concat(F.lit("-"), lost.cast("string"))).otherwise("0").alias("dropoff"),
    )


def dashboard_json(growth: DataFrame, funnel: DataFrame, revenue: DataFrame, platform: DataFrame) -> DataFrame:
    """(section, sort_key, json): the chart inputs, one JSON object per table row.

    Rows stay rows, so no table is gathered into one value. Text keeps its
    characters. ``sort_key`` puts a section into reading order.
    """
    growth, funnel, revenue, platform_rows = (
        growth_series(growth),
        funnel_series(funnel),
        revenue_series(revenue),
        platform_series(platform),
    )
    totals = kpi_platform_totals(platform).withColumn("revenue", F.col("revenue").cast("double"))

    def lines(section: str, df: DataFrame, *key: Column) -> DataFrame:
        return df.select(
            F.lit(section).alias("section"),
            F.concat_ws("|", *[F.coalesce(part, F.lit("~")) for part in key]).alias("sort_key"),
            F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"),
        )

    return reduce(
        DataFrame.union,
        [
            lines("user_growth", growth, F.col("metric_date")),
            lines("event_funnel", funnel, F.lpad(F.col("funnel_step_order").cast("string"), 12, "0"), F.col("event_name")),
            lines("revenue", revenue, F.col("metric_date"), F.col("currency"), F.col("payment_method")),
            lines("platform_split", platform_rows, F.col("metric_date"), F.col("platform")),
            lines("platform_totals", totals, F.col("platform")),
        ],
    )


