"""Paths within sessions against a walk through each session."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from fixtures import dicts

from tidemark.operators.paths import event_paths, event_runs, event_transitions, top_paths

START = datetime(2024, 1, 1)
EVENTS = "user_id string, session_id string, event_id string, event_name string, created_at timestamp_ntz"


@pytest.fixture(scope="module")
def rows():
    """One session with half of the events, single events, equal times, NULL users and an event without a time."""
    rnd = random.Random(8)
    out = [
        (rnd.choice(["u", None]), "hot" if rnd.random() < 0.5 else f"s{rnd.randrange(40)}", f"{i:04}", rnd.choice("abcd"), START + timedelta(seconds=20 * rnd.randrange(900)))
        for i in range(500)
    ]
    return out + [("u", "s1", "x", "a", None), ("u", "alone", "y", "a", START)]


def walk(rows, length, key):
    sessions = defaultdict(list)
    for row in rows:
        if row[4] is not None:
            sessions[key(row)].append((row[4], row[2], row[3]))
    found, where = Counter(), defaultdict(set)
    for name, events in sessions.items():
        names = [e[2] for e in sorted(events)]
        for i in range(len(names) - length + 1):
            path = " > ".join(names[i : i + length])
            found[path] += 1
            where[path].add(name)
    return {path: (n, len(where[path])) for path, n in found.items()}


@pytest.mark.parametrize("length", [2, 3, 6])
@pytest.mark.parametrize("part_rows", [100_000, 40, 1])
def test_paths(spark, rows, length, part_rows):
    df = spark.createDataFrame(rows, EVENTS)
    for keys, key in ((["user_id", "session_id"], lambda r: r[:2]), (["session_id"], lambda r: r[1])):
        got = {r["path"]: (r["occurrences"], r["sessions_count"]) for r in dicts(event_paths(df, length, keys, part_rows))}
        assert got == walk(rows, length, key)


def test_transitions_and_top(spark, rows):
    df = spark.createDataFrame(rows, EVENTS)
    want = walk(rows, 2, lambda r: r[:2])
    got = dicts(event_transitions(df))
    assert {f"{r['from_event']} > {r['to_event']}": r["transitions_count"] for r in got} == {p: n for p, (n, _) in want.items()}
    for name in "abcd":
        assert abs(sum(r["transition_share"] for r in got if r["from_event"] == name) - 1) < 0.001
    best = [r["path"] for r in top_paths(event_paths(df, 2), 5).collect()]
    assert best == sorted(want, key=lambda p: (-want[p][0], p))[:5]


def test_edges(spark, rows):
    df = spark.createDataFrame(rows, EVENTS)
    assert event_paths(df.limit(0)).count() == 0 and event_transitions(df.limit(0)).count() == 0
    assert event_runs(df.where("session_id = 'alone'"), 2).count() == 0
    with pytest.raises(ValueError):
        event_runs(df, 1)


def test_parts_of_a_session_are_bounded(spark):
    """A session with all events: no window partition holds more than a part and what it borrows."""
    df = spark.range(4000).selectExpr(
        "'u' AS user_id", "'s' AS session_id", "lpad(CAST(id AS string), 5, '0') AS event_id", "substr('abc', CAST(id % 3 AS int) + 1, 1) AS event_name",
        "timestampadd(SECOND, CAST(id * 30 AS int), timestamp_ntz'2024-01-01 00:00:00') AS created_at",
    )
    got = {r["path"]: r["occurrences"] for r in dicts(event_paths(df, 4, part_rows=100))}
    assert got == {"a > b > c > a": 1333, "b > c > a > b": 1332, "c > a > b > c": 1332}
