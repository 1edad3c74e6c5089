"""Published tables -> labelled metric samples.

A sample is (metric, labels, value, ts_ms, ord); ``ord`` keeps the order in
which samples are written out. By default a table gives the samples of its
latest date, stamped ``ts_ms``. With ``history=True`` every date gives its
samples, stamped with the date, which is the series that daily runs leave.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import label_text, nonblank_or, python_float_text
from tidemark.operators.ranking import latest_row, latest_slice

# Metric names per table column, label values and header text.
SOURCE = "business_pipeline"
HELP_TEXT = "Business flow telemetry metric"
GROWTH_METRICS = [
    ("business_users_dau", "dau_count"),
    ("business_users_wau", "wau_count"),
    ("business_users_mau", "mau_count"),
    ("business_users_new_daily", "new_registrations_count"),
    ("business_users_total", "cumulative_total_users"),
]
REVENUE_METRICS = [
    ("business_revenue_daily_amount", "daily_gross_revenue"),
    ("business_transactions_daily_count", "daily_successful_transactions"),
    ("business_revenue_average_order_value", "daily_average_order_value"),
    ("business_revenue_cumulative_total", "cumulative_total_revenue"),
]
FUNNEL_METRICS = [
    ("business_funnel_step_events_total", "total_events"),
    ("business_funnel_step_unique_users", "unique_users_count"),
    ("business_funnel_step_conversion_ratio", "step_conversion_rate"),
    ("business_funnel_overall_conversion_ratio", "overall_conversion_rate"),
]
PLATFORM_METRICS = [
    ("business_platform_active_users", "active_users_count"),
    ("business_platform_events_total", "events_count"),
    ("business_platform_revenue_total", "revenue_amount"),
]

SAMPLE_SCHEMA = (
    "metric STRING, labels MAP<STRING, STRING>, value DOUBLE, ts_ms BIGINT, "
    "ord STRUCT<section: INT, step: BIGINT, first: STRING, second: STRING, item: INT>"
)


def _date_ms() -> Column:
    return F.datediff(F.col("metric_date").cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86_400_000


def _samples(
    rows: DataFrame,
    metrics: Sequence[tuple[str, str]],
    labels: dict[str, Column],
    section: int,
    ts_ms: Column,
    step: Column | None = None,
    first: Column | None = None,
    second: Column | None = None,
) -> DataFrame:
    labels = labels | {"source": F.lit(SOURCE)}
    label_map = F.create_map(*[part for name, value in labels.items() for part in (F.lit(name), value)])
    items = [
        F.struct(
            F.lit(metric).alias("metric"),
            label_map.alias("labels"),
            F.coalesce(F.col(column).cast("double"), F.lit(0.0)).alias("value"),
            ts_ms.cast("bigint").alias("ts_ms"),
            F.struct(
                F.lit(section).alias("section"),
                (F.lit(0) if step is None else step).cast("bigint").alias("step"),
                (F.lit("") if first is None else first).alias("first"),
                (F.lit("") if second is None else second).alias("second"),
                F.lit(item).alias("item"),
            ).alias("ord"),
        )
        for item, (metric, column) in enumerate(metrics)
    ]
    return rows.select(F.inline(F.array(*items)))


def metrics_user_growth(mart: DataFrame, ts_ms: int = 0, history: bool = False) -> DataFrame:
    rows = mart.where(F.col("metric_date").isNotNull()) if history else latest_row(mart)
    return _samples(rows, GROWTH_METRICS, {}, 1, _date_ms() if history else F.lit(ts_ms))


def metrics_revenue(mart: DataFrame, ts_ms: int = 0, history: bool = False) -> DataFrame:
    """A currency and method without a payment on the latest date has no sample."""
    rows = mart.where(F.col("metric_date").isNotNull()) if history else latest_slice(mart)
    currency = nonblank_or(F.col("currency"), "USD")
    method = nonblank_or(F.col("payment_method"), "all")
    return _samples(
        rows,
        REVENUE_METRICS,
        {"currency": currency, "payment_method": method},
        2,
        _date_ms() if history else F.lit(ts_ms),
        first=currency,
        second=method,
    )


def metrics_funnel(mart: DataFrame, ts_ms: int = 0) -> DataFrame:
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("None"))

    return _samples(
        mart,
        FUNNEL_METRICS,
        {
            "step_order": text("funnel_step_order"),
            "step_name": text("step_name"),
            "event_name": text("event_name"),
        },
        3,
        F.lit(ts_ms),
        step=F.col("funnel_step_order"),
        first=text("event_name"),
    )


def metrics_platform(mart: DataFrame, ts_ms: int = 0, history: bool = False) -> DataFrame:
    rows = mart.where(F.col("metric_date").isNotNull()) if history else latest_slice(mart)
    platform = nonblank_or(F.col("platform"), "unknown")
    return _samples(
        rows,
        PLATFORM_METRICS,
        {"platform": platform},
        4,
        _date_ms() if history else F.lit(ts_ms),
        first=platform,
    )


def metric_samples(
    growth: DataFrame | None = None,
    revenue: DataFrame | None = None,
    funnel: DataFrame | None = None,
    platform: DataFrame | None = None,
    ts_ms: int = 0,
) -> DataFrame:
    """Samples of the tables that are there; no rows if there are none."""
    parts = [
        build(table, ts_ms)
        for build, table in [
            (metrics_user_growth, growth),
            (metrics_revenue, revenue),
            (metrics_funnel, funnel),
            (metrics_platform, platform),
        ]
        if table is not None
    ]
    return reduce(DataFrame.unionByName, parts) if parts else SparkSession.active().createDataFrame([], SAMPLE_SCHEMA)


def metrics_exposition(samples: DataFrame, escape: bool = False) -> DataFrame:
    """(ord, line_in_sample, line): text exposition, to be read in that order.

    The first sample of a metric brings two header lines. Label values are not
    escaped unless asked for. No samples give no lines.
    """
    first = samples.groupBy("metric").agg(F.min("ord").alias("ord"))
    headers = first.select(
        "ord",
        F.inline(
            F.array(
                F.struct(
                    F.lit(0).alias("line_in_sample"),
                    F.concat(F.lit("# HELP "), F.col("metric"), F.lit(f" {HELP_TEXT}")).alias("line"),
                ),
                F.struct(
                    F.lit(1).alias("line_in_sample"),
                    F.concat(F.lit("# TYPE "), F.col("metric"), F.lit(" gauge")).alias("line"),
                ),
            )
        ),
    )
    labels = label_text(F.col("labels"), escape)
    braces = F.when(labels == "", "").otherwise(F.concat(F.lit("{"), labels, F.lit("}")))
    values = samples.select(
        "ord",
        F.lit(2).alias("line_in_sample"),
        F.concat(
            F.col("metric"), braces, F.lit(" "), python_float_text(F.col("value")), F.lit(" "), F.col("ts_ms")
        ).alias("line"),
    )
    return headers.union(values)
