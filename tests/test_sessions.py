"""Sessions and daily actives, in batch and as streams, against a walk through each user's events."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from fixtures import dicts, plan_text

from tidemark.operators.activity import dau
from tidemark.operators.sessions import session_metrics, sessionize
from tidemark.streaming.activity import append_stream, streamed_actives, streamed_sessions

START = datetime(2024, 1, 1)
GAP = timedelta(minutes=30)
EVENTS = "user_id string, event_id string, event_name string, created_at timestamp_ntz"


def some_events(n=600, users=8, seed=4):
    rnd = random.Random(seed)
    rows = [
        ("hot" if rnd.random() < 0.4 else f"u{rnd.randrange(users)}", str(i), rnd.choice("abc"), START + timedelta(minutes=10 * rnd.randrange(2000)))
        for i in range(n)
    ]
    return rows + [(None, "x", "a", START), ("u1", "y", "a", None)]


def walk(rows, gap):
    by_user = defaultdict(list)
    for user, event_id, name, at in rows:
        if user is not None and at is not None:
            by_user[user].append((at, event_id, name))
    out = []
    for user, events in by_user.items():
        session = []
        for event in sorted(events) + [None]:
            if session and (event is None or event[0] - session[-1][0] >= gap):
                seconds = (session[-1][0] - session[0][0]) // timedelta(seconds=1)
                out.append((user, session[0][0], session[-1][0], seconds, len(session), session[0][2], session[-1][2]))
                session = []
            session.append(event)
    return sorted(out)


@pytest.mark.parametrize("gap", [timedelta(minutes=10), GAP, timedelta(minutes=11), timedelta(hours=7), timedelta(days=90)], ids=str)
def test_sessions(spark, gap):
    rows = some_events()
    df = spark.createDataFrame(rows, EVENTS)
    assert sorted(map(tuple, sessionize(df, gap).collect())) == walk(rows, gap)


def test_metrics_and_edges(spark):
    rows = [("u", "1", "a", START), ("u", "2", "b", START + GAP), ("u", "3", "c", START + GAP), ("u", "4", "d", START + GAP * 2 - timedelta(microseconds=1))]
    df = spark.createDataFrame(rows, EVENTS)
    assert sorted(map(tuple, sessionize(df, GAP).collect())) == walk(rows, GAP)
    [row] = dicts(session_metrics(sessionize(df, GAP)))
    assert row == {
        "metric_date": date(2024, 1, 1), "sessions_count": 2, "users_count": 1, "events_count": 4, "total_seconds": 1799, "longest_seconds": 1799, "single_event_sessions": 1,
    }
    assert sessionize(df.limit(0), GAP).count() == 0
    with pytest.raises(ValueError):
        sessionize(df, timedelta(0))


def test_a_hot_user_leaves_one_row_per_slot(spark):
    df = spark.range(20_000).selectExpr("IF(id = 7, 'other', 'hot') AS user_id", "CAST(id AS string) AS event_id", "'e' AS event_name", "timestampadd(SECOND, CAST(id AS int), timestamp_ntz'2024-01-01 00:00:00') AS created_at")
    found = sessionize(df.repartition(4), GAP)
    assert [r["events_count"] for r in dicts(found, "user_id")] == [19_999, 1]
    text = plan_text(found)
    scan_side = text[text.index("Window") :]
    assert "partial_count" in scan_side and scan_side.count("Exchange hashpartitioning") >= 2 and "hashpartitioning(user_id" in scan_side


def run(spark, root, build):
    arriving = spark.readStream.option("maxFilesPerTrigger", 1).schema(EVENTS).parquet(f"{root}/in")
    append_stream(build(arriving), f"{root}/out", f"{root}/state", once=True).awaitTermination()
    return spark.read.parquet(f"{root}/out")


def post(spark, root, rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(f"{root}/in")


CLOSING = [("closing", "z", "z", datetime(2030, 1, 1))]


def test_streamed_sessions_equal_the_batch(spark, tmp_path):
    """Late events arrive in later runs, restarts in between; within the delay nothing is lost or twice."""
    rows, root = some_events(200), str(tmp_path)
    ordered = sorted(rows, key=lambda r: r[3] or START)
    late = ordered[::7]
    early = [r for r in ordered if r not in late]
    build = lambda events: streamed_sessions(events, GAP, timedelta(days=30))
    post(spark, root, early[:100])
    assert run(spark, root, build).count() == 0
    post(spark, root, early[100:])
    post(spark, root, late)
    run(spark, root, build)
    post(spark, root, CLOSING)
    got = run(spark, root, build)
    assert sorted(map(tuple, got.collect())) == walk(rows, GAP)
    assert sorted(map(tuple, run(spark, root, build).collect())) == walk(rows, GAP)
    assert got.dtypes == sessionize(spark.createDataFrame(rows, EVENTS), GAP).dtypes


def test_sessions_come_out_once_closed_and_too_late_events_are_left_out(spark, tmp_path):
    root = str(tmp_path)
    build = lambda events: streamed_sessions(events, GAP, timedelta(hours=1))
    post(spark, root, [("u", "1", "a", START), ("u", "2", "b", START + timedelta(minutes=5))])
    post(spark, root, [("v", "3", "a", START + timedelta(hours=5))])
    assert [r["user_id"] for r in dicts(run(spark, root, build))] == ["u"]
    post(spark, root, [("u", "4", "c", START + timedelta(minutes=6))])
    post(spark, root, CLOSING)
    assert [(r["user_id"], r["events_count"]) for r in dicts(run(spark, root, build), "user_id")] == [("u", 2), ("v", 1)]


def test_streamed_actives_equal_the_batch(spark, tmp_path):
    rows, root = some_events(400, 60), str(tmp_path)
    build = lambda events: streamed_actives(events, timedelta(days=2))
    in_order = sorted((r for r in rows if r[3] is not None), key=lambda r: r[3])
    for part in (in_order[:150], in_order[100:250], in_order[250:], CLOSING):  # the second repeats some
        post(spark, root, part)
        got = run(spark, root, build)
    df = spark.createDataFrame(rows, EVENTS).selectExpr("*", "to_date(created_at) AS event_date", "'web' AS platform", "'s' AS session_id")
    want = dicts(dau(df.where("user_id IS NOT NULL AND event_date IS NOT NULL")), "metric_date")
    assert dicts(got, "metric_date") == want
