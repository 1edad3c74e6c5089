import random
from collections import defaultdict
from datetime import timedelta
from decimal import Decimal

from fixtures import at, day, dicts, events, plan_text, transactions, users

from tidemark.operators import accounts, activity, calendar, rolling
from tidemark.plans import models


def visits(spark, *pairs):
    return events(spark, [{"user_id": u, "created_at": None if d is None else at(d)} for u, d in pairs])


def growth_rows(mart):
    return dicts(mart, "metric_date")


def test_sparse_calendar_and_window_edges(spark):
    ev = visits(spark, ("a", 1), ("b", 10))
    us = users(spark, [{"user_id": "a", "created_at": at(3)}])
    got = growth_rows(models.mart_user_growth(us, ev))
    assert [r["metric_date"] for r in got] == [day(1), day(3), day(10)]
    assert [r["wau_count"] for r in got] == [1, 1, 1]
    assert [r["mau_count"] for r in got] == [1, 1, 2]
    assert [r["dau_count"] for r in got] == [1, 0, 1]
    assert [r["cumulative_total_users"] for r in got] == [0, 1, 1]
    assert got[2]["dau_to_mau_stickiness_ratio"] == 0.5


def test_window_lengths(spark):
    target = 60
    marks = {"a": target - 6, "b": target - 7, "c": target - 29, "d": target - 30, "e": target}
    ev = visits(spark, *marks.items())
    last = growth_rows(models.mart_user_growth(users(spark, []), ev))[-1]
    assert (last["dau_count"], last["wau_count"], last["mau_count"]) == (1, 2, 4)


def test_repeated_activity_counts_once(spark):
    ev = visits(spark, ("a", 1), ("a", 2), ("a", 2), ("a", 8), ("a", 40))
    got = growth_rows(models.mart_user_growth(users(spark, []), ev))
    assert [(r["dau_count"], r["wau_count"], r["mau_count"]) for r in got] == [(1, 1, 1)] * 4


def test_missing_users_and_dates(spark):
    ev = visits(spark, (None, 1), (None, None), ("a", None), ("a", 5))
    us = users(spark, [{"user_id": "x", "created_at": None}, {"user_id": "y", "created_at": at(2)}])
    got = growth_rows(models.mart_user_growth(us, ev))
    assert [r["metric_date"] for r in got] == [day(1), day(2), day(5), None]
    assert [r["dau_count"] for r in got] == [0, 0, 1, 0]
    assert [r["mau_count"] for r in got] == [0, 0, 1, 0]
    assert [r["new_registrations_count"] for r in got] == [0, 1, 0, 0]
    assert [r["cumulative_total_users"] for r in got] == [0, 1, 1, 1]
    assert got[3]["dau_to_mau_stickiness_ratio"] == 0.0


def test_intervals_equal_brute_force(spark):
    rng = random.Random(11)
    pairs = [(f"u{rng.randint(1, 25)}", rng.randint(1, 120)) for _ in range(400)] + [(None, 3)]
    ev = visits(spark, *pairs)
    us = users(spark, [{"user_id": "z", "created_at": at(d)} for d in (7, 90)])
    windows = {"wau_count": 7, "mau_count": 30, "two_days": 2}
    got = dicts(rolling.wau_mau(calendar.calendar_dates(us, ev), activity.user_days(ev), windows), "metric_date")
    seen = {(u, day(d)) for u, d in pairs if u}
    assert len(got) == len({day(d) for _, d in pairs} | {day(7), day(90)})
    for row in got:
        for name, length in windows.items():
            first = row["metric_date"] - timedelta(days=length - 1)
            assert row[name] == len({u for u, d in seen if first <= d <= row["metric_date"]}), (row, name)


def test_growth_is_the_same_for_any_order_and_partitioning(spark):
    rng = random.Random(5)
    pairs = [(f"u{rng.randint(1, 9)}", rng.randint(1, 70)) for _ in range(120)]
    us = users(spark, [{"user_id": f"u{i}", "created_at": at(i)} for i in range(1, 9)])
    first = growth_rows(models.mart_user_growth(us, visits(spark, *pairs)))
    rng.shuffle(pairs)
    assert first == growth_rows(models.mart_user_growth(us.repartition(7), visits(spark, *pairs).repartition(5)))
    for row in first:
        assert row["dau_count"] <= row["wau_count"] <= row["mau_count"]


def test_growth_plan_has_no_join(spark):
    text = plan_text(models.mart_user_growth(users(spark, []), visits(spark, ("a", 1))))
    assert "Join" not in text and "Cartesian" not in text


def test_funnel_ties_share_a_step(spark):
    ev = events(spark, [{"event_name": n, "user_id": u} for n, u in [("b", "1"), ("a", "1"), ("top", "1"), ("top", "2")]])
    got = dicts(models.mart_event_funnel(ev), "funnel_step_order", "event_name")
    assert [(r["funnel_step_order"], r["event_name"], r["step_name"]) for r in got] == [
        (1, "top", "Step 1: top"), (2, "a", "Step 2: a"), (2, "b", "Step 2: b"),
    ]
    assert [r["step_conversion_rate"] for r in got] == [1.0, 0.5, 1.0]
    assert [r["overall_conversion_rate"] for r in got] == [1.0, 0.5, 0.5]
    assert [r["step_dropoff_users_count"] for r in got] == [0, 1, 0]


def test_funnel_without_known_users(spark):
    ev = events(spark, [{"event_name": "a"}, {"event_name": "a"}, {"event_name": "b"}])
    for row in dicts(models.mart_event_funnel(ev)):
        assert row["step_conversion_rate"] == row["overall_conversion_rate"] == 1.0
        assert row["step_dropoff_users_count"] == 0


def test_funnel_of_volume_not_sequence(spark):
    ev = events(spark, [{"event_name": n, "user_id": "1", "session_id": s} for n, s in [("a", "s1"), ("b", "s1"), ("b", "s2")]])
    got = dicts(models.mart_event_funnel(ev), "funnel_step_order")
    assert [(r["event_name"], r["total_events"], r["unique_sessions_count"]) for r in got] == [("b", 2, 2), ("a", 1, 1)]


def test_rollup_gives_the_same_models(spark):
    rng = random.Random(2)
    rows = [
        {
            "user_id": rng.choice([None, "a", "b", "c"]),
            "session_id": rng.choice([None, "s1", "s2", "s3"]),
            "event_name": rng.choice(["x", "y", " Z "]),
            "platform": rng.choice(["ios", "Android", None]),
            "created_at": rng.choice([None, at(rng.randint(1, 40), rng.randint(0, 23))]),
        }
        for _ in range(300)
    ]
    ev = events(spark, rows)
    roll = activity.activity_rollup(ev)
    us = users(spark, [{"user_id": u, "created_at": at(2), "platform": p} for u, p in [("a", "ios"), ("b", None)]])
    tx = transactions(spark, [{"user_id": "a", "amount": 3.0}, {"user_id": "q", "amount": 4.0}])
    assert roll.count() < ev.count()
    for build in (
        lambda e: models.mart_user_growth(us, e),
        models.mart_event_funnel,
        lambda e: models.mart_platform_split(us, e, tx),
        lambda e: models.int_user_journey(us, e, tx),
        activity.dau,
        activity.event_totals,
        activity.platform_events,
    ):
        assert sorted(map(str, dicts(build(ev)))) == sorted(map(str, dicts(build(roll))))


def test_average_order_value_rounds_the_double(spark):
    tx = transactions(spark, [{"amount": 1.0}, {"amount": 1.01}, {"amount": 5.0, "status": "failed"}])
    row = dicts(models.mart_revenue(tx))[0]
    assert row["daily_gross_revenue"] == Decimal("2.01")
    assert row["daily_average_order_value"] == 1.0
    assert (row["total_transactions_count"], row["daily_successful_transactions"], row["daily_failed_transactions"]) == (3, 2, 1)


def test_no_success_no_value(spark):
    row = dicts(models.mart_revenue(transactions(spark, [{"amount": 9.0, "status": None}])))[0]
    assert row["daily_gross_revenue"] == Decimal("0.00") and row["daily_average_order_value"] == 0.0


def test_running_revenue_per_method(spark):
    tx = transactions(
        spark,
        [
            {"amount": 10.0, "payment_method": "pix", "created_at": at(1), "user_id": "a"},
            {"amount": 5.0, "payment_method": "pix", "created_at": at(4), "user_id": "a"},
            {"amount": 7.0, "payment_method": "card", "created_at": at(2), "user_id": "b"},
            {"amount": 1.0, "payment_method": "card", "created_at": None, "user_id": "b"},
        ],
    )
    got = dicts(models.mart_revenue(tx), "payment_method", "metric_date")
    assert [(r["payment_method"], r["metric_date"], r["cumulative_total_revenue"]) for r in got] == [
        ("card", day(2), Decimal("7.00")),
        ("card", None, Decimal("8.00")),
        ("pix", day(1), Decimal("10.00")),
        ("pix", day(4), Decimal("15.00")),
    ]
    assert {r["daily_paying_users_count"] for r in got} == {1}


def test_orphan_payment(spark):
    us = users(spark, [{"user_id": "a", "platform": "ios", "created_at": at(1)}])
    tx = transactions(spark, [{"user_id": "nobody", "amount": 50.0}, {"user_id": "a", "amount": 8.0}, {"amount": 2.0}])
    plain = dicts(models.mart_platform_split(us, events(spark, []), tx), "platform")
    assert [(r["platform"], r["revenue_amount"], r["transactions_count"]) for r in plain] == [
        ("ios", Decimal("8.00"), 1), (None, Decimal("0.00"), 0),
    ]
    safe = dicts(models.mart_platform_split(us, events(spark, []), tx, null_safe=True), "platform")
    assert safe[1]["revenue_amount"] == Decimal("52.00") and safe[1]["transactions_count"] == 2


def test_repeated_user_counts_payments_twice(spark):
    twice = users(spark, [{"user_id": "a", "platform": "ios"}, {"user_id": "a", "platform": "ios"}, {"user_id": "a", "platform": "tv"}])
    tx = transactions(spark, [{"user_id": "a", "amount": 10.0}, {"user_id": "a", "amount": 1.0, "status": "failed"}])
    got = dicts(accounts.platform_transactions(tx, twice), "platform")
    assert [(r["platform"], r["transactions_count"], r["revenue_amount"]) for r in got] == [
        ("ios", 4, Decimal("20.00")), ("tv", 2, Decimal("10.00")),
    ]


def test_platform_shares_and_both_vocabularies(spark):
    ev = events(spark, [{"platform": p, "created_at": at(1), "user_id": "u"} for p in ("ios", "ios", "Android", None)])
    us = users(spark, [{"user_id": "u", "platform": "Smart TV", "created_at": at(1)}])
    got = dicts(models.mart_platform_split(us, ev, transactions(spark, [])), "platform")
    assert [(r["platform"], r["events_count"], r["registrations_count"], r["platform_event_share_ratio"]) for r in got] == [
        ("android", 1, 0, 0.25), ("ios", 2, 0, 0.5), ("smart tv", 0, 1, 0.0), ("web", 1, 0, 0.25),
    ]


def test_platform_rows_without_a_date_are_empty(spark):
    ev = events(spark, [{"platform": "ios", "user_id": "u"}])
    row = dicts(models.mart_platform_split(users(spark, []), ev, transactions(spark, [])))[0]
    assert row["metric_date"] is None and row["events_count"] == 0 and row["platform_event_share_ratio"] == 0.0


def test_journey(spark):
    us = users(spark, [{"user_id": u, "created_at": at(10)} for u in ("a", "b", "c")])
    ev = events(
        spark,
        [
            {"user_id": "a", "created_at": at(10), "session_id": "s"},
            {"user_id": "a", "created_at": at(12)},
            {"user_id": "c", "created_at": None},
        ],
    )
    tx = transactions(
        spark,
        [
            {"user_id": "a", "amount": 3.0, "status": "failed", "created_at": at(7)},
            {"user_id": "b", "amount": 3.5, "created_at": at(15)},
            {"user_id": "b", "amount": 1.5, "created_at": at(16)},
        ],
    )
    a, b, c = dicts(models.int_user_journey(us, ev, tx), "user_id")
    assert (a["total_events_count"], a["total_active_days"], a["total_sessions_count"]) == (2, 2, 2)
    assert (a["days_to_first_transaction"], a["has_converted_paying"], a["has_performed_event"]) == (-3, 0, 1)
    assert (b["days_to_first_transaction"], b["has_converted_paying"], b["has_performed_event"]) == (5, 1, 0)
    assert b["lifetime_value_amount"] == Decimal("5.00") and b["successful_transactions_count"] == 2
    assert c["total_events_count"] == 1 and c["has_performed_event"] == 0 and c["days_to_first_transaction"] is None
    assert c["lifetime_value_amount"] == Decimal("0.00") and c["first_event_at"] is None


def test_daily_sums_reach_the_last_running_total(spark):
    rng = random.Random(4)
    tx = transactions(
        spark,
        [{"amount": rng.randint(1, 9999) / 100, "payment_method": rng.choice("ab"), "created_at": at(rng.randint(1, 20)),
          "status": rng.choice(["paid", "failed"])} for _ in range(200)],
    )
    sums, last = defaultdict(Decimal), {}
    for row in dicts(models.mart_revenue(tx), "payment_method", "metric_date"):
        method = row["payment_method"]
        sums[method] += row["daily_gross_revenue"]
        assert row["cumulative_total_revenue"] >= last.get(method, 0)
        last[method] = row["cumulative_total_revenue"]
    assert dict(sums) == last


def test_reading_order(spark):
    tx = transactions(spark, [{"amount": 1.0, "payment_method": m, "created_at": at(d)} for m, d in [("b", 1), ("a", 1), ("a", 2)]])
    got = models.in_reading_order("mart_revenue", models.mart_revenue(tx)).collect()
    assert [(r["metric_date"], r["payment_method"]) for r in got] == [(day(2), "a"), (day(1), "a"), (day(1), "b")]
    assert set(models.MART_ORDER) == {"mart_user_growth", "mart_event_funnel", "mart_revenue", "mart_platform_split"}
    assert models.in_reading_order("mart_user_growth", spark.createDataFrame([(2,), (1,)], "metric_date int")).first()[0] == 1
