"""Retention, growth accounting and churn features against plain sets of periods."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from fixtures import dicts, plan_text

from tidemark.operators.cohorts import MONDAY, activity_words, churn_features, growth_accounting, merge_words, retention

EVENTS = "user_id string, event_date date, event_name string, platform string, session_id string, created_at timestamp_ntz"


def frame(spark, rows):
    return spark.createDataFrame([(u, d, "open", "web", "s", None) for u, d in rows], EVENTS)


def periods_of(rows, days, origin):
    out = defaultdict(set)
    for user, day in rows:
        if user is not None and day is not None:
            out[user].add((day - origin).days // days)
    return out


def rate(a, b):
    return int(a / b * 10000 + 0.5) / 10000


@pytest.fixture(scope="module", params=[(1, date(2024, 1, 1)), (7, MONDAY), (1, date(2025, 6, 1))], ids=["days", "weeks", "origin-later"])
def case(request):
    """Some 300 days, so that daily bitmaps have several words, with gaps longer than a word."""
    rnd, rows = random.Random(2), [(None, date(2024, 1, 5)), ("x", None)]
    for u in range(40):
        day = date(2024, 1, 1) + timedelta(days=rnd.randrange(200))
        for _ in range(rnd.randrange(1, 30)):
            rows += [(f"u{u}", day)] * rnd.choice([1, 3])
            day += timedelta(days=rnd.choice([1, 1, 1, 2, 7, 20, 90]))
    return rows, *request.param


def test_retention(spark, case):
    rows, days, origin = case
    users = periods_of(rows, days, origin)
    newest = max(max(p) for p in users.values())
    want = {}
    for cohort in {min(p) for p in users.values()}:
        members = [p for p in users.values() if min(p) == cohort]
        for k in range(newest - cohort + 1):
            n = sum(cohort + k in p for p in members)
            want[origin + timedelta(days=cohort * days), k] = (len(members), n, rate(n, len(members)))
    got = {(r["cohort_start"], r["periods_since"]): (r["cohort_users"], r["active_users"], r["retention_rate"]) for r in dicts(retention(activity_words(frame(spark, rows), days, origin), days, origin))}
    assert got == want


def test_retention_by_registration(spark, case):
    rows, days, origin = case
    joined = [(f"u{i}", date(2024, 1, 1) + timedelta(days=i * 5)) for i in range(45)] + [("u3", date(2024, 6, 1)), ("u4", None), (None, date(2024, 1, 1))]
    first = {}
    for u, d in joined:
        if u is not None and d is not None:
            first[u] = min(d, first.get(u, d))
    users = periods_of(rows, days, origin)
    newest = max(max(p) for p in users.values())
    cohorts = defaultdict(list)
    for u, d in first.items():
        cohorts[(d - origin).days // days].append(users.get(u, set()))
    want = {
        (origin + timedelta(days=c * days), k): (len(m), sum(c + k in p for p in m), rate(sum(c + k in p for p in m), len(m)))
        for c, m in cohorts.items()
        for k in range(newest - c + 1)
    }
    registrations = spark.createDataFrame(joined, "user_id string, registration_date date")
    triangle = retention(activity_words(frame(spark, rows), days, origin), days, origin, registrations)
    assert {(r["cohort_start"], r["periods_since"]): (r["cohort_users"], r["active_users"], r["retention_rate"]) for r in dicts(triangle)} == want


def test_growth_accounting(spark, case):
    rows, days, origin = case
    users = periods_of(rows, days, origin)
    low, high = min(min(p) for p in users.values()), max(max(p) for p in users.values())
    want = []
    for t in range(low, high + 1):
        new = sum(min(p) == t for p in users.values())
        kept = sum(t in p and t - 1 in p for p in users.values())
        active = sum(t in p for p in users.values())
        lost = sum(t not in p and t - 1 in p for p in users.values())
        want.append((origin + timedelta(days=t * days), new, kept, active - new - kept, lost, active))
    got = [tuple(r.values()) for r in dicts(growth_accounting(activity_words(frame(spark, rows), days, origin), days, origin), "period_start")]
    assert got == want


def test_churn_features(spark, case):
    rows, days, origin = case
    as_of = date(2024, 7, 15)
    now = (as_of - origin).days // days
    want = {}
    for user, periods in periods_of(rows, days, origin).items():
        p = sorted(x for x in periods if x <= now)
        if not p:
            continue
        streak = 1
        while p[-1] - streak in periods:
            streak += 1
        want[user] = (
            origin + timedelta(days=p[0] * days), origin + timedelta(days=p[-1] * days), len(p), now - p[-1], sum(x > now - 4 for x in p),
            max([b - a - 1 for a, b in zip(p, p[1:])], default=0), streak, now - p[-1] >= 2,
        )
    words = activity_words(frame(spark, rows), days, origin)
    assert {r["user_id"]: tuple(list(r.values())[1:]) for r in dicts(churn_features(words, as_of, days, origin))} == want


def test_merging_parts_is_the_whole(spark, case):
    rows, days, origin = case
    parts = [activity_words(frame(spark, rows[i::3]), days, origin) for i in range(3)]
    whole = dicts(activity_words(frame(spark, rows), days, origin), "user_id", "word")
    assert dicts(merge_words(*parts), "user_id", "word") == whole
    assert dicts(merge_words(parts[2], parts[0], parts[1], parts[0]), "user_id", "word") == whole


def test_full_words(spark):
    """60 active days fill a word, with the last bit as the current period."""
    origin = date(2024, 1, 1)
    rows = [("a", origin + timedelta(days=i)) for i in range(120)]
    words = activity_words(frame(spark, rows), 1, origin)
    for n in (58, 59, 60, 119):
        [row] = dicts(churn_features(words, origin + timedelta(days=n), 1, origin))
        assert (row["active_periods"], row["current_streak"], row["idle_periods"], row["longest_gap"]) == (n + 1, n + 1, 0, 0)
    assert [r["active_users"] for r in dicts(retention(words, 1, origin), "periods_since")] == [1] * 120


def test_empty(spark):
    words = activity_words(frame(spark, []))
    assert words.count() == retention(words).count() == growth_accounting(words).count() == churn_features(words, date(2024, 1, 1)).count() == 0


def test_hot_user_is_combined_before_the_shuffle(spark):
    rows = spark.range(30_000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('u', id)) AS user_id", "date_add(date'2024-01-01', CAST(id % 400 AS int)) AS event_date",
        "'e' AS event_name", "'web' AS platform", "'s' AS session_id", "timestamp_ntz'2024-01-01 00:00:00' AS created_at",
    )
    words = activity_words(rows.repartition(4))
    words.collect()
    text = plan_text(words)
    assert text.index("partial_bit_or") > text.index("Exchange")  # printed from the result down to the scan
    assert words.where("user_id = 'hot'").count() == 2
    assert "Nested" not in plan_text(growth_accounting(words))
