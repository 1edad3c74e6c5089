"""Ordered funnels against a search of all choices of events."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from fixtures import dicts, plan_text

from tidemark.operators.step_funnel import ordered_funnel, step_marks, step_progress

START = datetime(2024, 1, 1)
EVENTS = "user_id string, event_name string, created_at timestamp_ntz, platform string"


def names(step):
    return [step] if isinstance(step, str) else step


def brute(rows, steps, within):
    """First time of each step per key: every earlier event that reached the step before is tried."""
    out = {}
    for key in {r[0] for r in rows if r[0][0] is not None}:
        events = [(t, n) for k, n, t in rows if k == key and t is not None]
        before = {t for t, n in events if n in names(steps[0])}
        reached = [min(before, default=None)]
        for step in steps[1:]:
            before = {t for t, n in events if n in names(step) and any(timedelta(0) < t - b <= within for b in before)}
            reached.append(min(before, default=None))
        if reached[0] is not None:
            out[key] = reached
    return out


@pytest.fixture(scope="module")
def rows():
    """A user with 40 % of the events, and minutes with several of them."""
    rnd = random.Random(5)
    out = [
        ((f"u{rnd.randrange(6)}" if rnd.random() < 0.6 else "hot", rnd.choice(["ios", None])), rnd.choice("abcx"), START + timedelta(minutes=rnd.randrange(3000)))
        for _ in range(700)
    ]
    return out + [((None, "ios"), "a", START), (("u1", "ios"), "a", None)]


@pytest.mark.parametrize("steps", [["a", "b", "c"], ["a", ["b", "c"], "a", "a"], ["c"]], ids=str)
@pytest.mark.parametrize("minutes", [4, 60, 9000])
def test_progress(spark, rows, steps, minutes):
    within = timedelta(minutes=minutes)
    df = spark.createDataFrame([(k[0], n, t, k[1]) for k, n, t in rows], EVENTS)
    want = brute(rows, steps, within)
    by_user = brute([((k[0],), n, t) for k, n, t in rows], steps, within)
    for part_rows in (100_000, 15):
        got = step_progress(df, steps, within, by=["platform"], part_rows=part_rows).collect()
        assert {(r.user_id, r.platform): list(r.reached_at) for r in got} == want
        assert all(r.steps_reached == sum(t is not None for t in r.reached_at) for r in got)
        whole = step_progress(df, steps, within, part_rows=part_rows).collect()
        assert {(r.user_id,): list(r.reached_at) for r in whole} == by_user


def test_parts_of_one_row(spark, rows):
    df = spark.createDataFrame([(k[0], n, t, k[1]) for k, n, t in rows[:150]], EVENTS)
    got = step_progress(df, ["a", "b", "a"], timedelta(hours=30), part_rows=1).collect()
    assert {(r.user_id,): list(r.reached_at) for r in got} == brute([((k[0],), n, t) for k, n, t in rows[:150]], ["a", "b", "a"], timedelta(hours=30))


def test_a_later_first_step_saves_the_funnel(spark):
    """The first event of step a is too early for b, the second one is not."""
    times = [("a", 0), ("a", 50), ("b", 70), ("c", 100), ("b", 100), ("c", 131)]
    df = spark.createDataFrame([("u", n, START + timedelta(minutes=m), "web") for n, m in times], EVENTS)
    [row] = dicts(step_progress(df, ["a", "b", "c"], timedelta(minutes=30)))
    assert [(t - START).total_seconds() / 60 for t in row["reached_at"]] == [0, 70, 100]
    [row] = dicts(step_progress(df, ["a", "b", "c"], timedelta(minutes=20)))
    assert row["steps_reached"] == 2


def test_funnel_rows(spark, rows):
    steps, within = ["a", "b", "z"], timedelta(hours=2)
    df = spark.createDataFrame([(k[0], n, t, k[1]) for k, n, t in rows], EVENTS)
    reached = list(brute([((k[0],), n, t) for k, n, t in rows], steps, within).values())
    users = [sum(r[i] is not None for r in reached) for i in range(3)]
    got = dicts(ordered_funnel(step_progress(df, steps, within), steps), "step_order")
    assert [r["users_count"] for r in got] == users and users[2] == 0
    assert [r["step_dropoff_users_count"] for r in got] == [0, users[0] - users[1], users[1]]
    assert [r["step_conversion_rate"] for r in got] == [1.0, round(users[1] / users[0], 4), 0.0]
    seconds = [(r[1] - r[0]).total_seconds() for r in reached if r[1]]
    assert [r["mean_seconds"] for r in got] == [None, float(round(sum(seconds) / len(seconds))), None]
    by = ordered_funnel(step_progress(df, steps, within, by=["platform"]), steps, by=["platform"])
    assert {r["platform"] for r in dicts(by)} == {"ios", None}


def test_empty_and_wrong_input(spark):
    df = spark.createDataFrame([], EVENTS)
    assert step_progress(df, ["a", "b"], timedelta(hours=1)).count() == 0
    assert [r["users_count"] for r in dicts(ordered_funnel(step_progress(df, ["a", "b"], timedelta(hours=1)), ["a", "b"]))] == [0, 0]
    with pytest.raises(ValueError):
        step_marks(df, [])


def test_rows_of_other_steps_and_equal_times_do_not_shuffle(spark, rows):
    df = spark.createDataFrame([(k[0], n, t, k[1]) for k, n, t in rows], EVENTS)
    text = plan_text(step_marks(df, ["a", "b"]))
    assert text.index("Filter") > text.index("partial_bit_or") > text.index("Exchange")
