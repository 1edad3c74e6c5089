from datetime import date

from fixtures import dicts

from tidemark.plans.metric_queries import (
    bottomk,
    metric_agg,
    metric_instant,
    metric_range,
    metric_ratio,
    metric_reduce,
    metric_scale,
    metric_stack,
)
from tidemark.plans.metrics import metric_samples, metrics_exposition, metrics_platform, metrics_revenue
from tidemark.sinks import write_text
from pyspark.sql import functions as F

DAY = date(2025, 3, 9)
BEFORE = date(2025, 3, 8)


def marts(spark):
    """Reduced tables: only the columns that samples are made of."""
    growth = spark.createDataFrame(
        [(BEFORE, 6, 8, 9, 2, 70), (DAY, 13, 29, 61, 4, 74), (None, 0, 0, 0, 0, 75)],
        "metric_date date, dau_count long, wau_count long, mau_count long, new_registrations_count long, cumulative_total_users long",
    )
    revenue = spark.createDataFrame(
        [
            (DAY, "EUR", "voucher", 322.5, 7, 46.07, 9876.25),
            (BEFORE, "EUR", "wallet", 8.0, 2, 4.0, 8.0),
            (DAY, "", None, None, None, 0.0, 31.0),
        ],
        "metric_date date, currency string, payment_method string, daily_gross_revenue double, "
        "daily_successful_transactions long, daily_average_order_value double, cumulative_total_revenue double",
    )
    funnel = spark.createDataFrame(
        [(1, "Opened", "screen_open", 17, 11, 1.0, 1.0)],
        "funnel_step_order int, step_name string, event_name string, total_events long, unique_users_count long, "
        "step_conversion_rate double, overall_conversion_rate double",
    )
    platform = spark.createDataFrame(
        [(DAY, "android", 9, 44, 210.5), (DAY, None, 0, 0, 3.25)],
        "metric_date date, platform string, active_users_count long, events_count long, revenue_amount double",
    )
    return growth, revenue, funnel, platform


def samples(spark, *rows):
    df = spark.createDataFrame(
        [(m, labels, float(v), ts, i) for i, (m, labels, v, ts) in enumerate(rows)],
        "metric string, labels map<string,string>, value double, ts_ms long, ord int",
    )
    return df


def text(spark, df, tmp_path):
    return "".join(r[0] for r in spark.read.text(write_text(metrics_exposition(df), str(tmp_path / "m")), wholetext=True).collect())


def test_samples_of_the_latest_date(spark):
    growth, revenue, funnel, platform = marts(spark)
    found = {(r["metric"], tuple(sorted(r["labels"].items()))): r["value"] for r in dicts(metric_samples(growth, revenue, funnel, platform, 7))}
    source = ("source", "business_pipeline")
    assert found[("business_users_dau", (source,))] == 13.0
    assert found[("business_users_total", (source,))] == 74.0
    voucher = (("currency", "EUR"), ("payment_method", "voucher"), source)
    assert found[("business_revenue_daily_amount", voucher)] == 322.5
    assert found[("business_transactions_daily_count", voucher)] == 7.0
    assert found[("business_revenue_daily_amount", (("currency", "USD"), ("payment_method", "all"), source))] == 0.0
    assert found[("business_platform_revenue_total", (("platform", "unknown"), source))] == 3.25
    step = (("event_name", "screen_open"), source, ("step_name", "Opened"), ("step_order", "1"))
    assert found[("business_funnel_step_unique_users", step)] == 11.0
    assert len(found) == 5 + 2 * 4 + 4 + 2 * 3


def test_absent_tables(spark):
    growth, *_ = marts(spark)
    nothing = metric_samples()
    assert nothing.count() == 0 and nothing.columns == metric_samples(growth=growth).columns
    assert metrics_exposition(nothing).count() == 0
    assert metric_samples(growth=growth).count() == 5


def test_history_is_stamped_with_its_date(spark):
    _, revenue, _, platform = marts(spark)
    stamps = {r["ts_ms"] for r in dicts(metrics_revenue(revenue, history=True))}
    assert stamps == {1741392000000, 1741478400000}
    assert metrics_platform(platform.where("false"), 1).count() == 0


def test_exposition_text(spark, tmp_path):
    growth, revenue, *_ = marts(spark)
    lines = text(spark, metric_samples(growth=growth, revenue=revenue, ts_ms=7), tmp_path).split("\n")
    assert lines[-1] == ""
    assert lines[:3] == [
        "# HELP business_users_dau Business flow telemetry metric",
        "# TYPE business_users_dau gauge",
        'business_users_dau{source="business_pipeline"} 13.0 7',
    ]
    first = 'business_revenue_daily_amount{currency="EUR",payment_method="voucher",source="business_pipeline"} 322.5 7'
    other = 'business_revenue_daily_amount{currency="USD",payment_method="all",source="business_pipeline"} 0.0 7'
    assert lines.index("# TYPE business_revenue_daily_amount gauge") + 1 == lines.index(first) < lines.index(other)
    assert sum(line.startswith("# HELP business_revenue_daily_amount ") for line in lines) == 1


def test_exposition_edge_cases(spark, tmp_path):
    plain = samples(spark, ("a", {}, 42.0, 1), ("b", {"z": "1", "a": 'q"'}, 1250.75, 1), ("a", {"x": "y"}, 1e16, 1))
    assert text(spark, plain, tmp_path) == (
        "# HELP a Business flow telemetry metric\n# TYPE a gauge\na 42.0 1\n"
        '# HELP b Business flow telemetry metric\n# TYPE b gauge\nb{a="q"",z="1"} 1250.75 1\n'
        'a{x="y"} 1e+16 1\n'
    )
    escaped = metrics_exposition(plain, escape=True).where("line like 'b{%'").first()["line"]
    assert escaped == 'b{a="q\\"",z="1"} 1250.75 1'
    assert metrics_exposition(plain.where("false")).count() == 0


def test_instant_and_range(spark):
    s = samples(
        spark,
        ("u", {"step_order": "1", "n": "a"}, 5, 10), ("u", {"step_order": "1", "n": "a"}, 7, 20),
        ("u", {"step_order": "2"}, 3, 10), ("v", {}, 1, 10),
    )
    now = dicts(metric_instant(s, "u"), "series")
    assert [(r["series"], r["value"], r["ts_ms"]) for r in now] == [('n="a",step_order="1"', 7.0, 20), ('step_order="2"', 3.0, 10)]
    assert [r["value"] for r in dicts(metric_instant(s, "u", {"step_order": "1"}, at=15))] == [5.0]
    assert dicts(metric_instant(s, "u", {"absent": ""}), "series") == now
    shown = dicts(metric_range(s, "u", 15, 20, "{{n}} (step {{step_order}})"))
    assert [(r["legend"], r["value"]) for r in shown] == [("a (step 1)", 7.0)]


def test_aggregates(spark):
    s = samples(
        spark,
        ("r", {"m": "pix", "c": "1"}, 100, 1), ("r", {"m": "card", "c": "1"}, 70, 1),
        ("r", {"m": "pix", "c": "2"}, 0, 1), ("r", {"m": "pix", "c": "1"}, 0, 2),
    )
    assert dicts(metric_agg(s, "r", "sum"), "ts_ms") == [{"ts_ms": 1, "value": 170.0}, {"ts_ms": 2, "value": 0.0}]
    assert dicts(metric_agg(s, "r", "avg", where=F.col("value") > 0)) == [{"ts_ms": 1, "value": 85.0}]
    assert dicts(metric_agg(s, "r", "max", match={"m": "card"})) == [{"ts_ms": 1, "value": 70.0}]
    assert dicts(metric_agg(s, "r", "sum", by=["m"]), "ts_ms", "m")[:2] == [
        {"ts_ms": 1, "m": "card", "value": 70.0}, {"ts_ms": 1, "m": "pix", "value": 100.0},
    ]
    assert [r["value"] for r in dicts(metric_scale(metric_agg(s, "r", "sum"), 100), "ts_ms")] == [17000.0, 0.0]


def test_ratio_drops_series_without_divisor(spark):
    s = samples(spark, ("d", {"s": "1"}, 3, 1), ("m", {"s": "1"}, 12, 1), ("d", {"s": "1"}, 3, 2), ("m", {"s": "1"}, 0, 2), ("d", {"s": "2"}, 1, 1))
    assert dicts(metric_ratio(s, "d", "m", 100)) == [{"series": 's="1"', "ts_ms": 1, "value": 25.0}]


def test_bottomk_reduce_stack(spark):
    s = samples(
        spark,
        ("r", {"p": "a"}, 4, 1), ("r", {"p": "b"}, 4, 1), ("r", {"p": "c"}, 9, 1), ("r", {"p": "a"}, 1, 2), ("r", {"p": "a"}, 7, 3),
    )
    assert [(r["series"], r["ts_ms"]) for r in dicts(bottomk(s, "r"), "ts_ms")] == [('p="a"', 1), ('p="a"', 2), ('p="a"', 3)]
    assert len(dicts(bottomk(s, "r", 2))) == 4
    gap = s.withColumn("value", F.when(F.col("ts_ms") != 3, F.col("value")))
    a = dicts(metric_reduce(gap, "r"), "series")[0]
    assert (a["lastNotNull"], a["max"], a["sum"], a["mean"]) == (1.0, 4.0, 5.0, 2.5)
    assert [r["stacked"] for r in dicts(metric_stack(s, "r"), "ts_ms", "series")] == [4.0, 8.0, 17.0, 1.0, 7.0]
