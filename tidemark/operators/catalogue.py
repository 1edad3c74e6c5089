"""A catalogue of the free properties of events: which event has which property, of which types, since when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How JSON types are named here; a type is known by how its schema text begins.
KINDS = {
    "VOID": "null",
    "BOOLEAN": "boolean",
    "BIGINT": "integer",
    "DECIMAL": "decimal",
    "DOUBLE": "decimal",
    "STRING": "text",
    "ARRAY": "array",
    "OBJECT": "object",
}
NUMBERS = ("integer", "decimal")


def kind_of(value: Column) -> Column:
    schema = F.schema_of_variant(value)
    name = F.lit("other")
    for start, kind in reversed(KINDS.items()):
        name = F.when(schema.startswith(start), kind).otherwise(name)
    return name


def property_values(events: DataFrame) -> DataFrame:
    """(event_name, event_date, property, value): one row per top-level property; text that is no JSON object has none."""
    parsed = F.try_parse_json("properties_json")
    entries = F.map_entries(F.try_variant_get(parsed, "$", "map<string, variant>"))
    return events.select("event_name", "event_date", F.inline(entries).alias("property", "value"))


def property_catalogue(events: DataFrame) -> DataFrame:
    """Per event name and property: events with it, types and their counts, conflicts, first date.

    types is text such as "integer:7,text:2", by name. has_conflict is true if the property
    has values of kinds that do not go together; whole and fractional numbers do, and null
    goes with all. Tasks combine their rows first, so what is shuffled are kinds per property, however
    many events of a name there are.
    """
    kinds = (
        property_values(events)
        .withColumn("kind", kind_of(F.col("value")))
        .groupBy("event_name", "property", "kind")
        .agg(F.count(F.lit(1)).alias("n"), F.min("event_date").alias("first_seen"))
    )
    firm = F.array_distinct(
        F.transform(F.filter(F.col("kinds.kind"), lambda k: k != "null"), lambda k: F.when(k.isin(*NUMBERS), "number").otherwise(k))
    )
    counted = kinds.groupBy("event_name", "property").agg(
        F.sum("n").alias("events_count"), F.min("first_seen").alias("first_seen_date"), F.sort_array(F.collect_list(F.struct("kind", "n"))).alias("kinds")
    )
    return counted.select(
        "event_name",
        "property",
        "events_count",
        F.array_join(F.transform("kinds", lambda k: F.concat(k["kind"], F.lit(":"), k["n"].cast("string"))), ",").alias("types"),
        (F.size(firm) > 1).alias("has_conflict"),
        "first_seen_date",
    )


def property_schemas(events: DataFrame) -> DataFrame:
    """event_name, property and merged_schema: one schema that all values of the property fit, nested ones included."""
    return property_values(events).groupBy("event_name", "property").agg(F.schema_of_variant_agg("value").alias("merged_schema"))
