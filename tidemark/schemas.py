"""Column contracts of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Raw table layouts. Ids may be BIGINT or STRING, times TIMESTAMP_NTZ or STRING.
RAW_USERS = (
    "id BIGINT, user_id STRING, email STRING, role STRING, status STRING, platform STRING, "
    "country_code STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)
RAW_ANALYTICS_EVENTS = (
    "id STRING, user_id STRING, session_id STRING, event_name STRING, event_category STRING, "
    "platform STRING, app_version STRING, properties_json STRING, created_at TIMESTAMP_NTZ"
)
RAW_TRANSACTIONS = (
    "id BIGINT, user_id STRING, amount DOUBLE, currency STRING, status STRING, "
    "payment_method STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)
RAW_SCHEMAS = {
    "users": RAW_USERS,
    "analytics_events": RAW_ANALYTICS_EVENTS,
    "transactions": RAW_TRANSACTIONS,
}

MONEY = "decimal(12,2)"
MONEY_TOTAL = "decimal(38,2)"


def ddl_columns(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]


def require_columns(df: DataFrame, columns: list[str], what: str) -> None:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks column(s) {', '.join(missing)}")


def empty_raw(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], RAW_SCHEMAS[table])


def backend_events_as_raw(df: DataFrame, event_time: str = "created_at") -> DataFrame:
    """Backend storage layout -> raw layout: ``properties`` becomes ``properties_json``.

    Event time stays ``created_at`` unless ``occurred_at`` is asked for.
    """
    if "properties_json" not in df.columns:
        kind = df.schema["properties"].dataType.simpleString()
        text = F.col("properties") if kind == "string" else F.to_json("properties")
        df = df.withColumn("properties_json", text)
    if event_time != "created_at":
        df = df.withColumn("created_at", F.col(event_time))
    return df.select(*ddl_columns(RAW_ANALYTICS_EVENTS))
