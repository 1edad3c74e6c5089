"""Rolling actives by deltas equal those of all events at once, whatever the order of the loads."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from fixtures import dicts

from tidemark.operators.activity import user_days
from tidemark.operators.rolling import wau_mau
from tidemark.plans import growth_deltas
from tidemark.plans.growth_deltas import add_activity, compact_layers, days_of, rolling_counts
from tidemark.sinks import read_release

EVENTS = "user_id string, event_date date, event_name string, platform string, session_id string, created_at timestamp_ntz"


def frame(spark, rows):
    return spark.createDataFrame([(u, d, "e", "web", "s", None) for u, d in rows], EVENTS)


def at_once(spark, rows):
    """By the batch operator, and by counting sets."""
    days = user_days(frame(spark, rows))
    calendar = days.where("event_date IS NOT NULL").selectExpr("event_date AS metric_date").distinct()
    batch = {r["metric_date"]: (r["wau_count"], r["mau_count"]) for r in dicts(wau_mau(calendar, days))}
    want = []
    for day in sorted({d for _, d in rows if d}):
        active = [len({u for u, d in rows if u and d and day - timedelta(days=n) < d <= day}) for n in (1, 7, 30)]
        assert batch[day] == (active[1], active[2])
        want.append((day, *active))
    return want


def counts(spark, folder):
    return [tuple(r.values()) for r in dicts(rolling_counts(spark, folder), "metric_date")]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(7)
    out = [(f"u{rnd.randrange(25)}", date(2024, 1, 1) + timedelta(days=rnd.choice([0, 1, 2, 10, 11, 40, 41, 75, 100]))) for _ in range(180)]
    return out + [(None, date(2024, 1, 20)), (None, date(2024, 1, 1)), ("u1", None)]


def test_any_loads_give_the_whole(spark, rows, tmp_path):
    """In order, and with late events last; repeats, a load without events, and compaction in between."""
    ordered = sorted(rows, key=lambda r: r[1] or date(2025, 1, 1))
    for name, loads in (("late", [ordered[100:], ordered[:60], ordered[40:100]]), ("mixed", [rows[::2], [], rows[1::2], rows[::5]])):
        folder, seen = str(tmp_path / name), []
        for i, load in enumerate(loads):
            add_activity(frame(spark, load), folder)
            seen += load
            assert counts(spark, folder) == at_once(spark, seen)
            if i == 1:
                assert compact_layers(spark, folder) == 2
                assert counts(spark, folder) == at_once(spark, seen)
        assert len(read_release(spark, folder)) == 2 * (len(loads) - 1)


def test_a_late_event_moves_only_its_windows(spark, tmp_path):
    folder = str(tmp_path)
    first = [("a", date(2024, 1, 1)), ("b", date(2024, 3, 1)), ("b", date(2024, 1, 25))]
    add_activity(frame(spark, first), folder)
    add_activity(frame(spark, [("a", date(2024, 1, 20))]), folder)
    layer = dicts(read_release(spark, folder)["changes_2"], "metric_date")
    assert [str(r["metric_date"]) for r in layer] == ["2024-01-20", "2024-01-27", "2024-01-31", "2024-02-19"]
    assert read_release(spark, folder)["words_2"].count() == 1
    assert counts(spark, folder) == at_once(spark, [*first, ("a", date(2024, 1, 20))])


def test_a_load_that_broke_off_is_as_if_it_never_ran(spark, rows, tmp_path, monkeypatch):
    folder = str(tmp_path)
    add_activity(frame(spark, rows[:80]), folder)
    with monkeypatch.context() as patch:
        def fails(*_, **__):
            raise RuntimeError("lost")

        patch.setattr(growth_deltas, "release_all", fails)
        with pytest.raises(RuntimeError):
            add_activity(frame(spark, rows[80:]), folder)
    assert counts(spark, folder) == at_once(spark, rows[:80])
    add_activity(frame(spark, rows[80:]), folder)
    add_activity(frame(spark, rows[80:]), folder)
    assert counts(spark, folder) == at_once(spark, rows)


def test_nothing_added(spark, tmp_path):
    with pytest.raises(LookupError):
        rolling_counts(spark, str(tmp_path / "none"))
    add_activity(frame(spark, []), str(tmp_path / "empty"))
    assert counts(spark, str(tmp_path / "empty")) == []


def test_days_of_words(spark, rows):
    from tidemark.operators.cohorts import activity_words

    days = {(r["event_date"], r["user_id"]) for r in dicts(days_of(activity_words(frame(spark, rows), 1)))}
    assert days == {(d, u) for u, d in rows if u and d}
