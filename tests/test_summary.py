import pytest
from fixtures import at, dicts, events, plan_text, raw

from tidemark.operators.staging import stg_events
from tidemark.plans.summary import (
    event_metrics_summary,
    events_filtered,
    parse_days,
    summary_report,
    top_events,
)


def stored(spark, rows):
    return events(spark, rows).withColumnRenamed("created_at", "occurred_at")


def test_cutoff_is_inclusive(spark):
    ev = stored(spark, [{"created_at": at(1)}, {"created_at": at(1, 9)}, {"created_at": at(30)}])
    parts = event_metrics_summary(ev, at(11), days=10)
    assert parts["totals"].first().asDict() == {"total_events": 2, "unique_users": 0}


def test_report_equals_its_parts(spark):
    rows = [
        {"user_id": u, "event_name": n, "platform": p, "created_at": at(d)}
        for u, n, p, d in [("a", "x", "ios", 5), ("a", "y", "ios", 6), (None, "y", "web", 7), ("b", "y", "android", 1), ("", "z", "ios", 8)]
    ]
    ev = stored(spark, rows)
    report = dicts(summary_report(ev, at(11), 7, k=2), "section", "name")
    assert report == [
        {"section": "platforms", "name": "ios", "total": 3},
        {"section": "platforms", "name": "web", "total": 1},
        {"section": "top_events", "name": "x", "total": 1},
        {"section": "top_events", "name": "y", "total": 2},
        {"section": "total_events", "name": None, "total": 4},
        {"section": "unique_users", "name": None, "total": 2},
    ]
    parts = event_metrics_summary(ev, at(11), 7)
    assert parts["totals"].first().asDict() == {"total_events": 4, "unique_users": 2}
    assert dicts(parts["platforms"], "platform") == [{"platform": "ios", "total": 3}, {"platform": "web", "total": 1}]
    assert plan_text(summary_report(ev, at(11), 7)).count("Expand") == 1


def test_missing_platform(spark):
    df = spark.createDataFrame([("e", None, "u", at(5)), ("e", "", "u", at(5))], "event_name string, platform string, user_id string, occurred_at timestamp_ntz")
    kept = dicts(event_metrics_summary(df, at(6), 3)["platforms"], "platform")
    assert kept == [{"platform": "", "total": 1}, {"platform": None, "total": 1}]
    named = dicts(event_metrics_summary(df, at(6), 3, "unknown")["platforms"])
    assert named == [{"platform": "unknown", "total": 2}]
    sections = {(r["section"], r["name"]): r["total"] for r in dicts(summary_report(df, at(6), 3, "unknown"))}
    assert sections[("platforms", "unknown")] == 2


def test_ties_go_by_name(spark):
    ev = events(spark, [{"event_name": n} for n in "ccbbad"])
    assert [r["event_name"] for r in top_events(ev, 3).collect()] == ["b", "c", "a"]


def test_filters_compose(spark):
    ev = events(
        spark,
        [
            {"user_id": "7", "platform": "ios", "event_category": "nav", "event_name": "x", "created_at": at(1)},
            {"user_id": "7", "platform": "ios", "event_category": "nav", "event_name": "x", "created_at": at(2)},
            {"user_id": "8", "platform": "android", "event_name": "y", "created_at": at(3)},
        ],
    )
    def ids(**wanted):
        return [r["event_id"] for r in dicts(events_filtered(ev, time="created_at", **wanted), "event_id")]

    assert ids() == ["1", "2", "3"]
    assert ids(user=7) == ["1", "2"] and ids(platform="ANDROID") == ["3"]
    assert ids(start=at(2), end=at(3)) == ["2", "3"]
    assert ids(name="x", category="nav", start=at(1), end=at(1)) == ["1"]
    with pytest.raises(ValueError):
        ids(start=at(1))


def test_days_argument():
    assert [parse_days(x) for x in (None, "7", "abc", "1.5")] == [30, 7, 30, 30]
    assert [parse_days(x, "prefix") for x in (None, "12days", "abc", "-3")] == [30, 12, 0, -3]
    assert parse_days("365", "range") == 365
    for bad in ("0", "366", "x"):
        with pytest.raises(ValueError):
            parse_days(bad, "range")


def test_cutoff_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "ev")
    raw(spark, "analytics_events", [{"id": "1", "event_name": "a", "created_at": at(1)}]).write.parquet(path)
    report = summary_report(stg_events(spark.read.parquet(path)), at(5), 3, time="created_at")
    plan = plan_text(report)
    assert "GreaterThanOrEqual(created_at" in plan and "properties_json" not in plan.split("ReadSchema")[1]
