"""Web-analytics report rows as event rows.

A report row is an aggregate: its event count is kept in the properties only,
and its number of active users has no place in an event row at all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fold_platform, json_quote
from tidemark.operators.ranking import dense_index

# Names, categories and the number of stand-in users.
VIEW_EVENTS = ["screen_view", "page_view"]
STAND_IN_USERS = 50
REPORT_COLUMNS = "date STRING, eventName STRING, unifiedScreenName STRING, platform STRING, eventCount BIGINT, activeUsers BIGINT"


def ga4_normalize(report: DataFrame, order: str) -> DataFrame:
    """Raw event rows from a report; ``order`` is a unique number per report row.

    Ids, sessions and stand-in users are made from the row's place in the report.
    """
    place = F.col("report_place")
    is_view = F.col("eventName").isin(VIEW_EVENTS)
    properties = F.concat(
        F.lit('{"ga4_event": '),
        json_quote(F.col("eventName")),
        F.lit(', "screen": '),
        json_quote(F.col("unifiedScreenName")),
        F.lit(', "event_count": '),
        F.col("eventCount").cast("string"),
        F.lit("}"),
    )
    day = F.to_date("date", "yyyyMMdd")
    return dense_index(report, order, "report_place").select(
        F.concat(F.lit("ga4_"), place).alias("id"),
        F.concat(F.lit("ga4_user_"), place % STAND_IN_USERS + 1).alias("user_id"),
        F.concat(F.lit("ga4_sess_"), F.col("date"), F.lit("_"), place).alias("session_id"),
        F.when(is_view, F.col("unifiedScreenName")).otherwise(F.col("eventName")).alias("event_name"),
        F.when(is_view, "ga4_screen_view").otherwise("ga4_event").alias("event_category"),
        fold_platform(F.col("platform")).alias("platform"),
        F.lit("1.0.0").alias("app_version"),
        properties.alias("properties_json"),
        (day.cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(12))).alias("created_at"),
    )


def union_event_sources(*sources: DataFrame) -> DataFrame:
    """Raw events of several sources; ids become text, missing columns NULL."""
    as_text = [df.withColumn("id", F.col("id").cast("string")) for df in sources]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), as_text)
