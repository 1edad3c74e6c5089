import json
from datetime import date
from decimal import Decimal

import pytest
from fixtures import at, dicts, events, transactions, users

from tidemark.plans import kpis, models
from tidemark.plans.metric_queries import metric_agg
from tidemark.plans.metrics import metrics_revenue


def revenue_mart(spark, *payments):
    return models.mart_revenue(
        transactions(spark, [{"amount": a, "payment_method": m, "created_at": at(d)} for a, m, d in payments])
    )


def test_largest_running_total_is_not_the_sum(spark):
    mart = revenue_mart(spark, (100.0, "pix", 1), (70.0, "card", 1))
    row = dicts(kpis.kpi_revenue(mart))[0]
    assert row["total_gross_revenue"] == 100.0 and row["true_total_revenue"] == 170.0
    assert row["avg_order_value"] == 50.0 and row["currency"] == "BRL"
    total = metric_agg(metrics_revenue(mart, 1), "business_revenue_cumulative_total", "sum")
    assert total.first()["value"] == 170.0


def test_currency_of_the_last_row(spark):
    tx = transactions(
        spark,
        [{"amount": 1.0, "currency": c, "payment_method": m, "created_at": at(d)} for c, m, d in [("usd", "b", 2), ("brl", "a", 2), ("eur", "z", 1)]],
    )
    assert dicts(kpis.kpi_revenue(models.mart_revenue(tx)))[0]["currency"] == "USD"


def test_empty_tables(spark):
    us, ev, tx = users(spark, []), events(spark, []), transactions(spark, [])
    row = dicts(kpis.dashboard_kpis(models.mart_user_growth(us, ev), models.mart_event_funnel(ev), models.mart_revenue(tx)))[0]
    assert row["total_users"] == 0 and row["stickiness_pct"] == 0.0 and row["currency"] == "BRL"
    assert row["funnel_top_users"] == 0 and row["total_gross_revenue"] == 0.0 and row["stickiness_band"] == "red"


def test_growth_of_the_latest_real_date(spark):
    us = users(spark, [{"created_at": at(1)}, {"created_at": None}])
    ev = events(spark, [{"user_id": u, "created_at": at(d)} for u, d in [("a", 1), ("b", 2), ("c", 2), ("a", 3)]])
    row = dicts(kpis.kpi_latest_growth(models.mart_user_growth(us, ev)))[0]
    assert row == {"total_users": 1, "current_dau": 1, "current_wau": 3, "current_mau": 3, "new_today": 0, "stickiness_pct": 33.3}


def test_funnel_kpis_and_table(spark):
    ev = events(spark, [{"event_name": "a", "user_id": str(u)} for u in range(8)] + [{"event_name": "b", "user_id": str(u)} for u in range(5)])
    mart = models.mart_event_funnel(ev)
    assert dicts(kpis.kpi_funnel(mart)) == [{"funnel_top_users": 8, "funnel_bottom_users": 5, "overall_funnel_pct": 62.5}]
    first, second = dicts(kpis.funnel_table_format(mart), "step")
    assert (first["step"], first["step_rate"], first["tag"], first["dropoff"]) == ("#1", "100.0", "positive", "0")
    assert (second["label"], second["step_rate"], second["tag"], second["dropoff"]) == ("Step 2: b", "62.5", "neutral", "-3")
    blank = mart.withColumn("step_name", kpis.F.lit(""))
    assert {r["label"] for r in dicts(kpis.funnel_table_format(blank))} == {"a", "b"}


def test_shares_of_shown_platforms(spark):
    totals = spark.createDataFrame(
        [("ios", 1, 3, Decimal("1.00")), ("tv", 9, 9, Decimal("9.00")), ("web", 3, 5, Decimal("0.00"))],
        "platform string, events long, users long, revenue decimal(38,2)",
    )
    assert [(r["platform"], r["value"], r["share_pct"]) for r in dicts(kpis.platform_share(totals, "users"), "platform")] == [
        ("android", 0.0, 0.0), ("ios", 3.0, 37.5), ("web", 5.0, 62.5),
    ]
    assert {r["share_pct"] for r in dicts(kpis.platform_share(totals.where("false"), "events"))} == {0.0}
    with pytest.raises(ValueError):
        kpis.platform_share(totals, "clicks")


def test_platform_totals_and_revenue_by_date(spark):
    mart = spark.createDataFrame(
        [(date(2024, 1, 1), "ios", 2, 5, Decimal("1.10")), (date(2024, 1, 2), "ios", 2, 1, Decimal("2.20")), (None, None, 0, 0, Decimal("0.00"))],
        "metric_date date, platform string, active_users_count long, events_count long, revenue_amount decimal(38,2)",
    )
    assert dicts(kpis.kpi_platform_totals(mart), "platform") == [
        {"platform": "ios", "events": 6, "users": 4, "revenue": Decimal("3.30")},
        {"platform": "unknown", "events": 0, "users": 0, "revenue": Decimal("0.00")},
    ]
    by_date = dicts(kpis.revenue_by_date(revenue_mart(spark, (1.0, "a", 1), (2.0, "b", 1), (4.0, "a", 2))), "metric_date")
    assert [(r["gross_revenue"], r["max_cumulative_revenue"]) for r in by_date] == [
        (Decimal("3.00"), Decimal("2.00")), (Decimal("4.00"), Decimal("5.00")),
    ]


def test_dashboard_json(spark):
    us = users(spark, [{"created_at": at(1), "platform": "ios"}])
    ev = events(spark, [{"event_name": "ação", "user_id": "1", "created_at": at(1)}])
    tx = transactions(spark, [{"user_id": "x", "amount": 2.5}])
    lines = kpis.dashboard_json(
        models.mart_user_growth(us, ev), models.mart_event_funnel(ev), models.mart_revenue(tx),
        models.mart_platform_split(us, ev, tx),
    )
    found = {}
    for row in lines.orderBy("section", "sort_key").collect():
        found.setdefault(row["section"], []).append(json.loads(row["json"]))
    assert set(found) == {"user_growth", "event_funnel", "revenue", "platform_split", "platform_totals"}
    assert found["event_funnel"][0]["event_name"] == "ação"
    assert any("ação" in r["json"] for r in lines.collect())
    assert found["revenue"][0]["daily_gross_revenue"] == 2.5
    assert [r["platform"] for r in found["platform_split"]] == ["ios", "unknown", "web"]
