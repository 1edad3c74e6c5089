"""Small hand-made tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.staging import stg_events, stg_transactions, stg_users
from tidemark.schemas import RAW_ANALYTICS_EVENTS, RAW_SCHEMAS, RAW_TRANSACTIONS, RAW_USERS, ddl_columns

START = date(2024, 3, 1)
DDL = {"users": RAW_USERS, "analytics_events": RAW_ANALYTICS_EVENTS, "transactions": RAW_TRANSACTIONS}


def day(n: int) -> date:
    """Day n of the fixtures, from 1."""
    return START + timedelta(days=n - 1)


def at(n: int, hour: int = 10) -> datetime:
    return datetime.combine(day(n), datetime.min.time()) + timedelta(hours=hour)


def raw(spark: SparkSession, table: str, rows: Iterable[dict]) -> DataFrame:
    names = ddl_columns(RAW_SCHEMAS[table])
    return spark.createDataFrame([tuple(row.get(name) for name in names) for row in rows], DDL[table])


def users(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    return stg_users(raw(spark, "users", [{"id": i} | row for i, row in enumerate(rows, 1)]))


def events(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    numbered = [{"id": str(i), "event_name": "open"} | row for i, row in enumerate(rows, 1)]
    return stg_events(raw(spark, "analytics_events", numbered))


def transactions(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    numbered = [{"id": i, "created_at": at(1), "status": "paid"} | row for i, row in enumerate(rows, 1)]
    return stg_transactions(raw(spark, "transactions", numbered))


def dicts(df: DataFrame, *order: str) -> list[dict]:
    found = [row.asDict(recursive=True) for row in df.collect()]
    return sorted(found, key=lambda r: [(r[c] is None, r[c]) for c in order]) if order else found


def plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
