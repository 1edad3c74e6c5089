import json
from datetime import datetime

import pytest
from fixtures import dicts, plan_text
from pyspark.sql import functions as F

from tidemark.functions.properties import merge_properties, purchase_items, typed_event_properties
from tidemark.operators.ingest import (
    ENVELOPE_SCHEMA,
    FIELD_LENGTHS,
    event_time,
    ingest_batch_policy,
    ingest_explode_batch,
    ingest_parse,
    ingest_validate,
    parse_body,
)

NOW = datetime(2024, 5, 1, 12, 0)


def posted(spark, *bodies, endpoint="event", auth=None, forwarded=None, peer="9.9.9.9"):
    rows = [
        (f"b{i}", endpoint, body if isinstance(body, str) else json.dumps(body), NOW, auth, forwarded, peer, "sdk")
        for i, body in enumerate(bodies)
    ]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


def batches(spark, *lists, **more):
    return posted(spark, *[{"events": items} for items in lists], endpoint="batch", **more)


def errors_of(spark, *events):
    items = ingest_explode_batch(parse_body(posted(spark, *events)))
    return [r["errors"] for r in dicts(ingest_validate(items), "batch_id")]


def test_bodies_must_be_json_objects(spark):
    good, corrupt = ingest_parse(posted(spark, '{"event_name":"a"}', "{oops", "[1]", '"text"', "", ' {"x":1} ', '{"x":1} y', '{"x":1} {"y":2}', '{"x":1},{"y":2}', '{"x":NaN}'))
    assert [r["batch_id"] for r in dicts(good, "batch_id")] == ["b0", "b5"]
    assert [r["batch_id"] for r in dicts(corrupt, "batch_id")] == ["b1", "b2", "b3", "b4", "b6", "b7", "b8", "b9"]


def test_text_around_the_object(spark):
    bodies = ['{"event_name":"a"},0] garbage', '{"event_name":"a"},0],[', '{"event_name":"a"}]', '\n\t{"event_name":"b"}\r\n ', '{"event_name":"],0]"}']
    good, corrupt = ingest_parse(posted(spark, *bodies))
    assert [r["batch_id"] for r in dicts(good, "batch_id")] == ["b3", "b4"]
    stored, quarantine = ingest_batch_policy(posted(spark, *bodies), "atomic")
    assert sorted(r["event_name"] for r in dicts(stored)) == ["],0]", "b"]
    assert {tuple(r["errors"]) for r in dicts(quarantine)} == {("invalid_json",)}


def test_the_last_of_repeated_keys_counts(spark):
    good, _ = ingest_batch_policy(posted(spark, '{"event_name":"a","event_name":"b","properties":{"k":1,"k":2}}'), "atomic")
    assert [(r["event_name"], r["properties"]) for r in dicts(good)] == [("b", '{"k":2}')]
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        with pytest.raises(ValueError, match="allowDuplicateKeys"):
            ingest_parse(posted(spark, "{}"))
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def test_only_atomic_bounds_a_batch(spark):
    many = batches(spark, [{"event_name": "a"}] * 501)
    assert ingest_batch_policy(many, "lenient")[0].count() == 501
    assert ingest_batch_policy(many, "lenient", 500)[0].count() == 0
    good, quarantine = ingest_batch_policy(many, "atomic")
    assert good.count() == 0 and dicts(quarantine)[0]["errors"] == ["events_too_many"]
    assert ingest_batch_policy(many, "atomic", 501)[0].count() == 501


def test_lenient_names_by_endpoint(spark):
    names = ["a", "", 5, 0, 0.0, True, False, [], ["a"], {}, {"k": 1}, None]
    alone, _ = ingest_batch_policy(posted(spark, *[{"event_name": n} for n in names]), "lenient")
    assert [r["event_name"] for r in dicts(alone)] == ["a"]
    stored, refused = ingest_batch_policy(batches(spark, [{"event_name": n} for n in names]), "lenient")
    assert sorted(r["pos"] for r in dicts(refused)) == [1, 3, 4, 6, 7, 9, 11]
    assert stored.count() == 5


def test_names(spark):
    got = errors_of(spark, {"event_name": "a"}, {}, {"event_name": ""}, {"event_name": None}, {"event_name": 5}, {"event_name": ["a"]})
    assert got == [[], ["event_name_required"], ["event_name_required"], ["event_name_required"], ["event_name_type"], ["event_name_type"]]


def test_batch_items_that_are_no_objects(spark):
    items = ingest_explode_batch(parse_body(batches(spark, [5, {"event_name": "a"}, "x", None])))
    got = [r["errors"] for r in dicts(ingest_validate(items), "pos")]
    assert got == [["event_name_required"], [], ["event_name_required"], ["event_name_required"]]


def test_lengths(spark):
    fits = {name: "x" * n for name, n in FIELD_LENGTHS.items()}
    too_long = {name: "é" * (n + 1) for name, n in FIELD_LENGTHS.items()}
    got = errors_of(spark, fits, too_long)
    assert got == [[], [f"{name}_length" for name in FIELD_LENGTHS]]


def test_properties_and_times(spark):
    got = errors_of(
        spark,
        {"event_name": "a", "properties": {}, "occurred_at": "2024-05-01T10:00:00Z"},
        {"event_name": "a", "properties": [1], "occurred_at": "soon"},
        {"event_name": "a", "properties": None, "occurred_at": None},
        {"event_name": "a", "properties": "x", "occurred_at": 17, "user_id": 4},
    )
    assert got == [
        [],
        ["properties_not_object", "occurred_at_not_date"],
        [],
        ["user_id_type", "properties_not_object", "occurred_at_not_date"],
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    texts = {
        "2024-05-01T10:00:00Z": datetime(2024, 5, 1, 10),
        "2024-05-01T10:00:00.250+02:00": datetime(2024, 5, 1, 8, 0, 0, 250000),
        "2024-05-01T10:00:00-0300": datetime(2024, 5, 1, 13),
        "2024-05-01 10:00:00": datetime(2024, 5, 1, 10),
        "2024-05-01T10:00": datetime(2024, 5, 1, 10),
        "2024-05-01T10:00Z": datetime(2024, 5, 1, 10),
        "2024-05-01": datetime(2024, 5, 1),
        "2024-13-01": None,
        "T10:00": None,
        "": None,
    }
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", event_time(F.col("t")).alias("at"))
        assert {r["t"]: r["at"] for r in df.collect()} == texts
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_policies(spark):
    mixed = batches(spark, [{"event_name": "a"}, {"event_name": ""}, {"event_name": "c"}])
    good, quarantine = ingest_batch_policy(mixed, "lenient")
    assert [r["event_name"] for r in dicts(good, "event_name")] == ["a", "c"]
    assert [(r["pos"], r["value"], r["errors"]) for r in dicts(quarantine)] == [(1, '{"event_name":""}', ["event_name_required"])]
    good, quarantine = ingest_batch_policy(mixed, "atomic")
    assert good.count() == 0
    [row] = dicts(quarantine)
    assert row["pos"] is None and row["errors"] == ["1:event_name_required"] and json.loads(row["value"])["events"][0] == {"event_name": "a"}
    with pytest.raises(ValueError):
        ingest_batch_policy(mixed, "strict")


def test_lenient_keeps_what_has_a_name(spark):
    items = [{"event_name": 5}, {"event_name": 0}, {"event_name": False}, {"event_name": "0"}, {"event_name": "x", "platform": "y" * 99}, {}]
    good, quarantine = ingest_batch_policy(batches(spark, items), "lenient")
    assert [r["event_name"] for r in dicts(good, "event_name")] == ["0", "5", "x"]
    assert sorted(r["pos"] for r in dicts(quarantine)) == [1, 2, 5]


def test_batch_sizes(spark):
    one = {"event_name": "a"}
    env = batches(spark, [], [one] * 500, [one] * 501).union(posted(spark, '{"events": 5}', '{"event_name":"a"}', endpoint="batch"))
    good, quarantine = ingest_batch_policy(env, "atomic")
    assert good.count() == 500
    assert sorted(r["errors"][0] for r in dicts(quarantine)) == ["events_empty", "events_not_list", "events_not_list", "events_too_many"]
    good, _ = ingest_batch_policy(env, "lenient", max_items=None)
    assert good.count() == 1001


def test_enrichment(spark):
    body = {"event_name": "a", "user_id": "", "properties": {"k": [1, {"é": None}]}, "occurred_at": "2024-01-02T03:04:05Z"}
    good, _ = ingest_batch_policy(posted(spark, body, {"event_name": "b"}, auth="me", forwarded=" 1.1.1.1 , 2.2.2.2"), "atomic")
    a, b = dicts(good, "event_name")
    assert a["user_id"] == b["user_id"] == "me" and a["ip_address"] == "1.1.1.1" and a["user_agent"] == "sdk"
    assert a["occurred_at"] == datetime(2024, 1, 2, 3, 4, 5) and b["occurred_at"] == NOW == b["created_at"]
    assert json.loads(a["properties"]) == body["properties"] and b["properties"] is None
    kept, _ = ingest_batch_policy(posted(spark, body, auth="me", forwarded=""), "atomic", user_fallback="null")
    assert dicts(kept)[0]["user_id"] == "" and dicts(kept)[0]["ip_address"] == "9.9.9.9"


def test_lenient_time_falls_back_to_arrival(spark):
    good, _ = ingest_batch_policy(posted(spark, {"event_name": "a", "occurred_at": "soon"}), "lenient")
    assert dicts(good)[0]["occurred_at"] == NOW


def test_ids_repeat(spark):
    env = batches(spark, [{"event_name": "a"}, {"event_name": "b"}])
    first, again = (sorted(r["id"] for r in dicts(ingest_batch_policy(e)[0])) for e in (env, env.repartition(3)))
    assert first == again and len(set(first)) == 2


def test_ingest_needs_no_shuffle(spark):
    for part in ingest_batch_policy(batches(spark, [{"event_name": "a"}]), "atomic"):
        assert "Exchange" not in plan_text(part)


def test_merged_properties(spark):
    df = spark.sql("select map('a', '1', 'b', '1') as g, map('b', '2') as o union all select map('a', '1'), null union all select null, map('c', '3')")
    got = [r[0] for r in df.select(merge_properties(F.col("g"), F.col("o"))).collect()]
    assert {"a": "1", "b": "2"} in got and {"a": "1"} in got and {"c": "3"} in got


def test_typed_payloads(spark):
    rows = [
        ("1", "screen_view", None, '{"screen_name":"cart","previous_screen":"home"}'),
        ("2", "purchase_completed", None, '{"value":9.5,"order_id":"o1","items":[{"sku":"a","qty":2},{"sku":"b"}]}'),
        ("3", "signup", "conversion", '{"value":1,"currency":"BRL"}'),
        ("4", "app_open", "custom", "not json"),
    ]
    typed = typed_event_properties(spark.createDataFrame(rows, "event_id string, event_name string, event_category string, properties_json string"))
    one, two, three, four = dicts(typed, "event_id")
    assert one["event_category"] == "navigation" and one["screen_name"] == "cart" and one["currency"] is None
    assert two["event_category"] == "conversion" and two["value"] == 9.5 and two["currency"] == "USD"
    assert three["currency"] == "BRL" and four["event_category"] == "custom" and four["value"] is None
    assert [(r["item_no"], r["item"]) for r in dicts(purchase_items(typed), "item_no")] == [(0, {"sku": "a", "qty": "2"}), (1, {"sku": "b"})]
