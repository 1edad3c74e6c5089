"""The catalogue of event properties on hand-made JSON."""

from __future__ import annotations

from datetime import date

from fixtures import dicts, plan_text

from tidemark.operators.catalogue import property_catalogue, property_schemas

DAY = date(2024, 1, 1)


def frame(spark, *rows):
    return spark.createDataFrame([(n, d, j) for n, d, j in rows], "event_name string, event_date date, properties_json string")


def test_types_counts_conflicts_and_first_dates(spark):
    df = frame(
        spark,
        ("buy", date(2024, 1, 3), '{"price": 10, "items": [1], "note": null}'),
        ("buy", date(2024, 1, 2), '{"price": 9.5, "items": [{"sku": "a"}]}'),
        ("buy", None, '{"price": "10", "items": {"sku": "a"}, "ok": true}'),
        ("buy", DAY, '{"note": "x"}'),
        ("open", DAY, '{"price": 1e3}'),
    )
    got = {(r["event_name"], r["property"]): tuple(list(r.values())[2:]) for r in dicts(property_catalogue(df))}
    assert got == {
        ("buy", "price"): (3, "decimal:1,integer:1,text:1", True, date(2024, 1, 2)),
        ("buy", "items"): (3, "array:2,object:1", True, date(2024, 1, 2)),
        ("buy", "note"): (2, "null:1,text:1", False, DAY),
        ("buy", "ok"): (1, "boolean:1", False, None),
        ("open", "price"): (1, "decimal:1", False, DAY),
    }


def test_what_is_no_object_has_no_properties(spark):
    df = frame(spark, ("a", DAY, None), ("a", DAY, ""), ("a", DAY, "[1, 2]"), ("a", DAY, "3"), ("a", DAY, "{oops"), ("a", DAY, "{}"))
    assert property_catalogue(df).count() == 0 and property_schemas(df).count() == 0


def test_merged_schemas(spark):
    df = frame(spark, ("a", DAY, '{"x": {"k": 1}}'), ("a", DAY, '{"x": {"k": 2, "m": ["t"]}}'), ("b", DAY, '{"x": 1}'), ("b", DAY, '{"x": "t"}'))
    got = {(r["event_name"], r["property"]): r["merged_schema"] for r in dicts(property_schemas(df))}
    assert got == {("a", "x"): "OBJECT<k: BIGINT, m: ARRAY<STRING>>", ("b", "x"): "VARIANT"}


def test_a_hot_event_is_combined_before_the_shuffle(spark):
    df = spark.range(20_000).selectExpr("IF(id % 3 = 0, 'rare', 'hot') AS event_name", "date'2024-01-01' AS event_date", """concat('{"k": ', id, '}') AS properties_json""")
    catalogue = property_catalogue(df.repartition(4))
    assert {r["types"] for r in dicts(catalogue)} == {"integer:6667", "integer:13333"}
    text = plan_text(catalogue)
    assert text.index("partial_count") > text.index("Exchange")
