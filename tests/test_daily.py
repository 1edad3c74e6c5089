import json
import os

import pytest
from fixtures import at, day, dicts, plan_text, raw

from tidemark.operators.activity import activity_rollup
from tidemark.operators.quality import QualityError
from tidemark.operators.staging import stg_events
from tidemark.plans import daily
from tidemark.plans.daily import daily_run, refresh_activity, report_run, samples_run, stage_activity
from tidemark.sinks import read_published, read_release, release_all, stage_mart
from tidemark.sources import read_marts


def tables(spark, repeated_user=False):
    people = [{"id": i, "user_id": f"u{i}", "platform": "ios", "created_at": at(i)} for i in (1, 2, 3)]
    if repeated_user:
        people.append({"id": 9, "user_id": "u1", "created_at": at(1)})
    visits = [("u1", "open", 1), ("u1", "buy", 2), ("u2", "open", 2), (None, "open", 3)]
    return {
        "users": raw(spark, "users", people),
        "analytics_events": raw(
            spark, "analytics_events",
            [{"id": str(i), "user_id": u, "event_name": n, "created_at": at(d)} for i, (u, n, d) in enumerate(visits)],
        ),
        "transactions": raw(
            spark, "transactions",
            [{"id": 1, "user_id": "u1", "amount": 20.0, "status": "paid", "payment_method": "pix", "created_at": at(2)}],
        ),
    }


def lines_of(path):
    return "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.startswith("part-"))


def test_everything_is_published(spark, tmp_path):
    result = daily_run(spark, tables(spark), str(tmp_path), ts_ms=1)
    assert result.report.count() == 40 and result.report.where("failures > 0").count() == 0
    text = lines_of(result.metrics_path)
    assert 'business_users_total{source="business_pipeline"} 3.0 1\n' in text
    assert 'business_funnel_step_unique_users{event_name="open",source="business_pipeline",step_name="Step 1: open",step_order="1"} 2.0 1' in text
    totals = json.loads(lines_of(os.path.join(result.dashboard_path, "section=platform_totals")).split("\n")[0])
    assert totals["platform"] == "ios"
    assert dicts(spark.table("mart_revenue"))[0]["payment_method"] == "pix"
    assert {"int_user_journey", "mart_user_growth", "mart_event_funnel", "mart_revenue", "mart_platform_split"} == set(result.tables)


def test_failed_checks_stop_the_run(spark, tmp_path):
    out = str(tmp_path / "bad")
    with pytest.raises(QualityError, match="stg_users.user_id unique"):
        daily_run(spark, tables(spark, repeated_user=True), out, ts_ms=1)
    assert not os.path.exists(f"{out}/metrics") and read_published(spark, f"{out}/dq_report").count() > 0
    assert read_marts(spark, require_all=False, path=out) == {}
    result = daily_run(spark, tables(spark, repeated_user=True), out, ts_ms=1, check=False)
    assert os.path.exists(result.metrics_path)


def test_refresh_replaces_only_recent_dates(spark, tmp_path):
    source = str(tmp_path / "raw")
    first = [{"id": str(i), "user_id": "a", "event_name": "x", "created_at": at(d)} for i, d in enumerate([1, 2, 3, 3])]
    first.append({"id": "9", "user_id": "b", "event_name": "x", "created_at": None})
    raw(spark, "analytics_events", first).write.parquet(source)
    path = str(tmp_path / "activity")
    whole = refresh_activity(stg_events(spark.read.parquet(source)), path)
    assert sum(r["events_in_row"] for r in whole.collect()) == 5
    later = [{"id": str(i), "user_id": "c", "event_name": "x", "created_at": at(d)} for i, d in [(20, 3), (21, 4)]]
    raw(spark, "analytics_events", later).write.mode("append").parquet(source)
    staged = stg_events(spark.read.parquet(source))
    refreshed = refresh_activity(staged, path, since=day(3))
    assert dicts(refreshed.selectExpr("*"), "event_date", "user_id") == dicts(activity_rollup(staged), "event_date", "user_id")


@pytest.mark.parametrize("change", ["a date goes", "an event moves", "undated events go"])
def test_refresh_leaves_nothing_stale(spark, tmp_path, change):
    rows = [{"id": str(i), "user_id": "a", "event_name": "x", "created_at": at(d)} for i, d in enumerate([1, 2, 3, 4])]
    rows.append({"id": "9", "user_id": "b", "event_name": "x", "created_at": None})
    path = str(tmp_path / "activity")
    refresh_activity(stg_events(raw(spark, "analytics_events", rows)), path)
    if change == "a date goes":
        rows = [r for r in rows if r["created_at"] != at(3)]
    elif change == "an event moves":
        rows[3] = rows[3] | {"created_at": at(6)}
    else:
        rows = [r for r in rows if r["created_at"]]
    staged = stg_events(raw(spark, "analytics_events", rows))
    refreshed = refresh_activity(staged, path, since=day(3))
    assert dicts(refreshed.selectExpr("*"), "event_date", "user_id") == dicts(activity_rollup(staged), "event_date", "user_id")
    assert dicts(read_published(spark, path).select(refreshed.columns), "event_date", "user_id") == dicts(refreshed, "event_date", "user_id")


def test_refresh_skips_old_row_groups(spark, tmp_path, monkeypatch):
    source = str(tmp_path / "raw")
    raw(spark, "analytics_events", [{"id": "1", "event_name": "x", "created_at": at(1)}]).write.parquet(source)
    plans = []

    def capture(df, *rest):
        plans.append(plan_text(df))
        return df

    monkeypatch.setattr(daily, "stage_mart", capture)
    stage_activity(stg_events(spark.read.parquet(source)), str(tmp_path / "unused"), since=day(3))
    assert "Or(GreaterThanOrEqual(created_at" in plans[0]


def test_jobs_on_tables_of_an_earlier_run(spark, tmp_path):
    out = str(tmp_path / "run")
    result = daily_run(spark, tables(spark), out, ts_ms=1)
    for name in result.tables:
        spark.catalog.dropTempView(name)
    assert lines_of(samples_run(spark, out, str(tmp_path / "m"), 1)) == lines_of(result.metrics_path)
    assert lines_of(samples_run(spark, out, str(tmp_path / "one"), 1, one_file=True)) == lines_of(result.metrics_path)
    report = report_run(spark, out, str(tmp_path / "r"))
    section = "section=revenue"
    assert lines_of(os.path.join(report, section)) == lines_of(os.path.join(result.dashboard_path, section))
    nothing = str(tmp_path / "nothing")
    assert lines_of(samples_run(spark, nothing, str(tmp_path / "empty"), 1)) == ""
    with pytest.raises(LookupError):
        report_run(spark, nothing, str(tmp_path / "never"))


def test_rollup_of_undated_events_only(spark, tmp_path):
    ev = stg_events(raw(spark, "analytics_events", [{"id": "1", "user_id": "a", "event_name": "x"}]))
    back = refresh_activity(ev, str(tmp_path / "a"))
    assert back.first()["event_date"] is None and back.schema["event_date"].dataType.simpleString() == "date"


def test_tables_of_a_run_are_released_together(spark, tmp_path):
    """Staged tables are unseen; one mark switches all of them; a table left out keeps its version."""
    folder = str(tmp_path)
    assert read_release(spark, folder) == {}

    def staged(n, *names):
        return {name: stage_mart(spark.range(n), name, f"{folder}/{name}") for name in names}

    release_all(staged(1, "a", "b"), folder)
    waiting = staged(2, "a", "b")
    assert {name: df.count() for name, df in read_release(spark, folder).items()} == {"a": 1, "b": 1}
    reading = read_release(spark, folder)
    release_all(waiting, folder)
    assert {name: df.count() for name, df in reading.items()} == {"a": 1, "b": 1}
    assert {name: df.count() for name, df in read_release(spark, folder).items()} == {"a": 2, "b": 2}
    release_all(staged(3, "a"), folder)
    release_all(staged(4, "a"), folder)
    assert {name: df.count() for name, df in read_release(spark, folder).items()} == {"a": 4, "b": 2}
    assert read_published(spark, f"{folder}/b").count() == 2
    assert len([n for n in os.listdir(f"{folder}/a") if n.startswith("v")]) == 2
    assert len([n for n in os.listdir(f"{folder}/_RELEASES") if n.endswith(".json") and n[0] != "."]) == 2
    for name in ("a", "b"):
        spark.catalog.dropTempView(name)


def test_a_failed_load_leaves_the_rollup_of_the_run_before(spark, tmp_path):
    """The rollup of the failed run has an event that the next run, from a later date on, must not take over."""
    out, good = str(tmp_path / "run"), tables(spark)
    daily_run(spark, good, out, ts_ms=1)
    bad = tables(spark, repeated_user=True)
    extra = raw(spark, "analytics_events", [{"id": "77", "user_id": "ghost", "event_name": "open", "created_at": at(1)}])
    bad["analytics_events"] = bad["analytics_events"].union(extra)
    with pytest.raises(QualityError):
        daily_run(spark, bad, out, ts_ms=2)
    assert read_published(spark, f"{out}/event_activity").where("user_id = 'ghost'").count() == 0
    daily_run(spark, good, out, ts_ms=3, since=day(3))
    want = dicts(activity_rollup(stg_events(good["analytics_events"])), "event_date", "event_name", "user_id")
    assert dicts(read_published(spark, f"{out}/event_activity").select(list(want[0])), "event_date", "event_name", "user_id") == want
