"""Event properties: merging maps and reading the conventional payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Payload fields, conventional events and the default purchase currency.
PAYLOAD = (
    "screen_name STRING, previous_screen STRING, button_id STRING, value DOUBLE, currency STRING, "
    "order_id STRING, payment_method STRING, items ARRAY<MAP<STRING, STRING>>"
)
EVENT_CATEGORIES = {
    "app_open": "system",
    "screen_view": "navigation",
    "button_tap": "interaction",
    "purchase_completed": "conversion",
}
PURCHASE_EVENT = "purchase_completed"
PURCHASE_CURRENCY = "USD"


def merge_properties(shared: Column, own: Column) -> Column:
    """``own`` over ``shared``: a key in both keeps the value of ``own``."""
    only_shared = F.map_filter(shared, lambda key, _: ~F.map_contains_key(own, key))
    return F.coalesce(F.map_concat(only_shared, own), own, shared)


def typed_event_properties(events: DataFrame) -> DataFrame:
    """Events with the conventional payload fields as columns.

    A conventional event without a category gets its usual one; a purchase
    without a currency is in the default one.
    """
    usual = F.create_map(*[F.lit(part) for pair in EVENT_CATEGORIES.items() for part in pair])
    payload = F.from_json("properties_json", PAYLOAD)
    is_purchase = F.col("event_name") == PURCHASE_EVENT
    return (
        events.withColumn("event_category", F.coalesce("event_category", usual[F.col("event_name")]))
        .withColumn("payload", payload)
        .select(*[c for c in events.columns if c != "properties_json"], "payload.*")
        .withColumn(
            "currency", F.coalesce("currency", F.when(is_purchase, F.lit(PURCHASE_CURRENCY)))
        )
    )


def purchase_items(typed: DataFrame) -> DataFrame:
    """One row per purchased item: (event_id, item_no, item), numbered from 0."""
    return typed.where(F.col("event_name") == PURCHASE_EVENT).select(
        "event_id", F.posexplode("items").alias("item_no", "item")
    )
