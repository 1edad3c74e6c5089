"""Raw tables, posted envelopes and report rows derived from the test tables.

The test tables hold no users or payments of a product, so these projections
stand in for them. The remainder rules bring in what the models must cope
with: missing values, mixed case, blanks, unknown users, broken bodies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_SPAN = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "CAST(c_custkey AS STRING) AS user_id",
        "concat(' ', c_name, '@Example.com') AS email",
        "c_mktsegment AS role",
        "CASE WHEN c_acctbal < 0 THEN 'Inactive' END AS status",
        "element_at(array('iOS', 'Android', 'Web', 'Desktop', NULL), c_nationkey % 5 + 1) AS platform",
        "CASE WHEN c_nationkey % 4 <> 0 THEN concat('C', c_nationkey) END AS country_code",
        "CAST(date_add(DATE'2023-12-20', CAST(c_custkey % 45 AS INT)) AS TIMESTAMP_NTZ) AS created_at",
        "CAST(NULL AS TIMESTAMP_NTZ) AS updated_at",
    )


def raw_analytics_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS id",
        "CASE WHEN event_id % 41 <> 0 THEN CAST(user_id AS STRING) END AS user_id",
        "CASE WHEN event_id % 50 <> 0 THEN concat(user_id, '-', CAST(ts AS DATE)) END AS session_id",
        "CASE WHEN event_id % 7 = 0 THEN concat('  ', upper(event_type), ' ') ELSE event_type END AS event_name",
        "CASE WHEN event_type IN ('view', 'click') THEN 'Navigation' END AS event_category",
        "CASE event_id % 6 WHEN 0 THEN 'iOS 17.2' WHEN 1 THEN 'Android 14' WHEN 2 THEN 'Web/Chrome' "
        "WHEN 3 THEN 'macOS' WHEN 4 THEN 'ANDROID' END AS platform",
        "CASE WHEN event_id % 9 <> 0 THEN '2.1.0' END AS app_version",
        "props AS properties_json",
        "ts AS created_at",
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    purchases = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    return purchases.selectExpr(
        "event_id AS id",
        "CASE WHEN event_id % 53 <> 0 THEN CAST(IF(event_id % 97 = 0, user_id + 10000000, user_id) AS STRING) END "
        "AS user_id",
        "CASE WHEN event_id % 3 = 0 THEN floor(value * 10) / 10 + 0.005 ELSE value END AS amount",
        "CASE user_id % 3 WHEN 0 THEN 'brl' WHEN 1 THEN 'USD' END AS currency",
        "CASE floor(value) % 6 WHEN 0 THEN 'Completed' WHEN 1 THEN 'PAID' WHEN 2 THEN 'pending' "
        "WHEN 3 THEN 'failed' WHEN 4 THEN 'approved' END AS status",
        "CASE event_id % 4 WHEN 0 THEN 'PIX' WHEN 1 THEN 'credit_card' WHEN 2 THEN 'paypal' END AS payment_method",
        "ts AS created_at",
        "CASE event_id % 5 WHEN 0 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'-03:00'\") "
        "WHEN 1 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS updated_at",
    )


def raw_order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payments: a history of several years."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "CAST(o_custkey AS STRING) AS user_id",
        "o_totalprice AS amount",
        "CAST(NULL AS STRING) AS currency",
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'approved' WHEN 'P' THEN 'pending' END AS status",
        "o_orderpriority AS payment_method",
        "o_orderdate AS created_at",
        "CAST(NULL AS TIMESTAMP_NTZ) AS updated_at",
    )


def ga4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events counted per day, name, screen and platform; numbered by first event."""
    kind = F.col("event_type")
    name = F.when(kind == "view", "screen_view").when(kind == "click", "page_view").otherwise(kind)
    screen = F.concat(F.lit("screen \""), F.get_json_object("props", "$.k"), F.lit("\""))
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.date_format("ts", "yyyyMMdd").alias("date"),
            name.alias("eventName"),
            screen.alias("unifiedScreenName"),
    F.expr("element_at(array('iOS', 'Android', 'Desktop Web'), CAST(event_id % 3 + 1 AS INT))").alias("platform"),
        )
        .agg(
            F.count(F.lit(1)).alias("eventCount"),
            F.count_distinct("user_id").alias("activeUsers"),
            F.min("event_id").alias("report_order"),
        )
    )


def _event_body() -> Column:
    """One event as JSON text; fields without a value are left out."""
    number = F.col("event_id")
    name = F.when(number % 29 == 0, F.lit(None)).when(number % 23 == 0, "").otherwise(F.col("event_type"))
    time = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    event = F.struct(
        name.alias("event_name"),
        F.when(number % 11 == 0, F.lit(None)).when(number % 7 == 0, "").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(number % 101 == 0, F.repeat(F.lit("x"), 60)).otherwise("Android").alias("platform"),
        F.parse_json(F.when(number % 113 == 0, "[1]").otherwise(F.col("props"))).alias("properties"),
        F.when(number % 37 == 0, F.lit(None)).when(number % 31 == 0, "yesterday").otherwise(time).alias("occurred_at"),
    )
    return F.to_json(event)


def _request(batch_no: Column) -> list[Column]:
    forwarded = (
        F.when(batch_no % 3 == 0, F.concat(F.lit(" 10.0.0."), (batch_no % 250).cast("string"), F.lit(" , 172.16.0.1")))
        .when(batch_no % 3 == 1, "")
    )
    return [
        F.when(batch_no % 2 == 0, F.concat(F.lit("auth-"), batch_no.cast("string"))).alias("auth_user_id"),
        forwarded.alias("forwarded_for"),
        F.lit("192.168.0.9").alias("peer_address"),
        F.lit("sdk/1.0").alias("user_agent"),
    ]


def single_envelopes(events: DataFrame) -> DataFrame:
    """Each event posted alone, an hour after it happened.

    Some bodies are no JSON or have text behind them, some start with white space or
    repeat a key.
    """
    number = F.col("event_id")
    garbage = F.when(number % 70 == 0, '{"event_name":"a"},0] garbage').when(number % 105 == 0, '{"event_name":"a"},0],[')
    spaced = F.when(number % 15 == 0, "\n\t ").otherwise("")
    body = F.when(number % 25 == 0, F.concat(F.lit('{"platform":"old",'), F.substr(_event_body(), F.lit(2)))).otherwise(_event_body())
    return events.select(
        F.concat(F.lit("e"), number.cast("string")).alias("batch_id"),
        F.lit("event").alias("endpoint"),
        F.when(number % 35 == 0, garbage.otherwise("{not json")).otherwise(F.concat(spaced, body)).alias("value"),
        (F.col("ts") + F.make_dt_interval(hours=F.lit(1))).alias("arrival_ts"),
        *_request(number),
    )


def batch_envelopes(events: DataFrame) -> DataFrame:
    """Events posted in batches of up to 25 neighbours."""
    number = F.col("event_id")
    batch_no = F.floor(number / BATCH_SPAN)
    grouped = (
        events.groupBy(batch_no.alias("batch_no"))
        .agg(
            F.array_sort(F.collect_list(F.struct("event_id", _event_body().alias("body")))).alias("rows"),
            F.max("ts").alias("last_ts"),
        )
    )
    return grouped.select(
        F.concat(F.lit("b"), F.col("batch_no").cast("string")).alias("batch_id"),
        F.lit("batch").alias("endpoint"),
        F.concat(F.lit('{"events":['), F.array_join("rows.body", ","), F.lit("]}")).alias("value"),
        (F.col("last_ts") + F.make_dt_interval(hours=F.lit(1))).alias("arrival_ts"),
        *_request(F.col("batch_no")),
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events: every fifth one posted alone, the others in batches."""
    events = table(spark, sf_dir, "events")
    alone = F.col("event_id") % 5 == 0
    return single_envelopes(events.where(alone)).union(batch_envelopes(events.where(~alone)))


def sdk_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the payloads that client code sends."""
    key = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    screen = F.concat(F.lit("screen_"), key.cast("string"))
    items = F.transform(
        F.sequence(F.lit(1), F.lit(3)),
        lambda i: F.when(
            i <= key % 4,
            F.struct(F.concat(F.lit("sku-"), i.cast("string")).alias("sku"), i.cast("string").alias("qty")),
        ),
    )
    payload = F.to_json(
        F.struct(
            F.when(kind.isin("view", "click"), screen).alias("screen_name"),
            F.when((kind == "view") & (key % 2 == 0), "home").alias("previous_screen"),
            F.when(kind == "click", F.concat(F.lit("btn_"), key.cast("string"))).alias("button_id"),
            F.when(kind.isin("signup", "purchase"), F.col("value")).alias("value"),
            F.when(kind == "signup", "BRL").when((kind == "purchase") & (key % 3 == 0), "EUR").alias("currency"),
            F.when(kind == "purchase", F.concat(F.lit("ord-"), F.col("event_id").cast("string"))).alias("order_id"),
            F.when((kind == "purchase") & (key % 2 == 0), "pix").alias("payment_method"),
            F.when(kind == "purchase", F.array_compact(items)).alias("items"),
        )
    )
    name = (
        F.when(kind == "view", "screen_view")
        .when(kind == "click", "button_tap")
        .when(kind == "purchase", "purchase_completed")
        .when(kind == "error", "app_open")
        .otherwise(kind)
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        name.alias("event_name"),
        F.when(kind == "signup", "conversion").alias("event_category"),
        payload.alias("properties_json"),
    )
