import pytest
from fixtures import at, dicts, events, plan_text, raw, transactions, users

from tidemark.operators.quality import (
    DECLARED,
    Checks,
    QualityError,
    check_table,
    check_written,
    dq_not_null,
    dq_report,
    dq_unique,
    raise_on_failures,
)
from tidemark.operators.staging import same_key_derivations, stg_events
from tidemark.plans import models
from tidemark.sinks import stage_all, stage_mart


def test_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, None), (None, "b"), (2, "c")], "k int, v string")
    assert dicts(dq_not_null(df, ["k", "v"]), "column") == [{"column": "k", "failures": 2}, {"column": "v", "failures": 2}]
    assert dicts(dq_unique(df, "k")) == [{"value": 1, "occurrences": 2}]
    report = dicts(check_table(df, Checks(["k", "v"], ["k", "v"])).drop("model"), "test", "column")
    assert report == [
        {"column": "k", "test": "not_null", "failures": 2},
        {"column": "v", "test": "not_null", "failures": 2},
        {"column": "k", "test": "unique", "failures": 1},
        {"column": "v", "test": "unique", "failures": 0},
    ]


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "k int, v string")
    assert {r["failures"] for r in dicts(check_table(df, Checks(["v"], ["k"])))} == {0}
    assert {r["failures"] for r in dicts(check_table(df, Checks(["v"])))} == {0}


def test_one_grouping_per_table(spark):
    df = spark.range(10).selectExpr("id as k", "id as v")
    assert plan_text(check_table(df, Checks(["k", "v"], ["k"]))).count("Range") == 1


def test_forty_checks_are_declared():
    assert sum(len(c.not_null) + len(c.unique) for c in DECLARED.values()) == 40


def test_ties_orphans_and_copies_fail(spark):
    us = users(spark, [{"user_id": "a", "created_at": at(1)}, {"user_id": "a", "created_at": at(1)}])
    ev = events(spark, [{"event_name": n, "user_id": "a", "created_at": at(1)} for n in "xy"])
    tx = transactions(spark, [{"user_id": "nobody", "amount": 1.0}])
    report = dq_report(
        {
            "stg_users": us,
            "mart_event_funnel": models.mart_event_funnel(ev),
            "mart_platform_split": models.mart_platform_split(us, ev, tx),
        }
    )
    failed = {(r["model"], r["column"], r["test"]) for r in dicts(report) if r["failures"]}
    assert failed == {
        ("stg_users", "user_id", "unique"),
        ("mart_event_funnel", "funnel_step_order", "unique"),
        ("mart_platform_split", "platform", "not_null"),
    }
    with pytest.raises(QualityError, match="stg_users.user_id unique: 1"):
        raise_on_failures(report)


def test_unknown_table(spark):
    with pytest.raises(ValueError):
        dq_report({"nothing": spark.range(1)})


def test_raw_and_staged_share_a_grouping(spark):
    rows = [
        {"id": "1", "event_name": "a", "created_at": at(1)},
        {"id": "1", "event_name": None},
        {"id": "2", "event_name": "b"},
        {"id": "2", "event_name": "b", "created_at": at(1)},
        {"id": None, "event_name": "c", "created_at": at(1)},
    ]
    df = raw(spark, "analytics_events", rows)
    tables = {"raw_analytics_events": df, "stg_events": stg_events(df)}
    order = ("model", "column", "test")
    apart = dicts(dq_report(tables), *order)
    assert apart == dicts(dq_report(tables, derived=same_key_derivations()), *order)
    failures = {(r["model"], r["column"], r["test"]): r["failures"] for r in apart}
    assert failures[("raw_analytics_events", "id", "unique")] == 2
    assert failures[("stg_events", "event_id", "unique")] == 1
    assert failures[("raw_analytics_events", "created_at", "not_null")] == 2
    assert failures[("stg_events", "event_date", "not_null")] == 1


def test_shared_grouping_reads_only_what_it_checks(spark, tmp_path):
    path = str(tmp_path / "ev")
    raw(spark, "analytics_events", [{"id": "1", "event_name": "a"}]).write.parquet(path)
    df = spark.read.parquet(path)
    plan = plan_text(dq_report({"raw_analytics_events": df, "stg_events": stg_events(df)}, derived=same_key_derivations()))
    assert plan.count("ReadSchema") == 1
    assert "ReadSchema: struct<id:string,event_name:string,created_at:timestamp_ntz>" in plan


def test_nulls_are_counted_by_the_writing_tasks(spark, tmp_path):
    """The counts equal those of a reading check, and the report reads no column for them."""
    df = spark.createDataFrame([(1, "a", None), (1, None, None), (None, None, "x"), (None, "b", "y"), (2, "c", None)], "k int, v string, w string")
    checks = Checks(["k", "v", "w"], ["k"])
    for by in (None, "k"):
        table = stage_mart(df.repartition(3), "t", str(tmp_path / f"t-{by}"), by, checks.not_null)
        assert table.nulls == {"k": 2, "v": 2, "w": 3}
        got = check_written(table.rows, checks, table.nulls, "t")
        assert dicts(got, "column", "test") == dicts(check_table(df, checks, "t"), "column", "test")
        assert "ReadSchema: struct<k:int>" in plan_text(got) or by == "k"
    assert stage_mart(df, "t", str(tmp_path / "plain")).nulls == {}


def test_tables_written_at_the_same_time(spark, tmp_path):
    tables = {f"t{i}": spark.range(10).selectExpr(f"nullif(id % {i + 2}, 0) AS a") for i in range(6)}
    staged = stage_all(tables, str(tmp_path), {name: ["a"] for name in tables})
    assert {name: t.nulls["a"] for name, t in staged.items()} == {f"t{i}": len(range(0, 10, i + 2)) for i in range(6)}
    with pytest.raises(Exception, match="USER_RAISED|stop"):
        stage_all(tables | {"bad": spark.range(1).selectExpr("raise_error('stop') AS a")}, str(tmp_path / "x"))
