import os

import duckdb
import pytest
from fixtures import at, dicts, events, raw, transactions, users

from tidemark.plans.extract import extract
from tidemark.plans.models import mart_revenue
from tidemark.schemas import empty_raw
from tidemark.session import build_session, require_utc, scratch_path
from tidemark.sinks import materialize_mart, read_published, register_raw, stage_mart, write_snapshots
from tidemark.sources import (
    JdbcSource,
    choose_tables,
    ga4_normalize,
    read_marts,
    read_parquet_raw,
    union_event_sources,
)
from tidemark.sources.ga4 import REPORT_COLUMNS
from tidemark.sources import jdbc
from tidemark.sources.jdbc import HashSplit, RangeSplit, Split, id_split, split_range
from tidemark.sources.tables import MARTS


def database(driver="mysql", host="h", **more):
    return JdbcSource(**{"driver": driver, "host": host, "database": "d", "user": "u", "password": "p"} | more)


def test_jdbc_addresses():
    assert database().url.startswith("jdbc:mysql://h:3306/d?")
    assert database(" PostgreSQL ").url.startswith("jdbc:postgresql://h:5432/d?")
    assert database("postgres", port=6000).url.startswith("jdbc:postgresql://h:6000/")
    secret = database(password="p@ss w/rd")
    assert "p@ss" not in secret.url
    assert secret.options()["password"] == "p@ss w/rd"
    assert Split("id", 1, 100, 4).options() == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "4",
    }
    with pytest.raises(ValueError, match="oracle"):
        database("oracle").url
    with pytest.raises(TypeError):
        JdbcSource("mysql", "h")


@pytest.fixture
def asked(monkeypatch):
    """Questions to the source are answered by an SQL engine in this process, over the given ids."""
    con = duckdb.connect()
    monkeypatch.setattr(jdbc, "_ask", lambda _, __, query: con.execute(query).fetchall())

    def fill(values, kind="BIGINT"):
        con.execute(f"CREATE OR REPLACE TABLE t (id {kind})")
        for value in values:
            con.execute("INSERT INTO t VALUES (?)", [value])
        return con

    return fill


def part_sizes(con, split):
    conditions = split.predicates("mysql")
    sizes = [con.execute(f"SELECT count(*) FROM t WHERE {c}").fetchone()[0] for c in conditions]
    assert sum(sizes) == con.execute("SELECT count(*) FROM t").fetchone()[0]
    return sizes


SPARSE = {
    "time-based 64 bits": ([(1_700_000_000_000 + i * 37) << 22 | i % 4096 for i in range(1000)], "BIGINT"),
    "one far outlier": ([*range(999), 2**63 - 1], "BIGINT"),
    "both ends of 64 bits": ([-(2**63), 2**63 - 1, *range(998)], "BIGINT"),
    "unsigned, over 63 bits": ([2**64 - 1 - i * 10**9 for i in range(1000)], "DECIMAL(20, 0)"),
}


@pytest.mark.parametrize("kind", SPARSE)
def test_sparse_ids_are_cut_by_rows(spark, asked, kind):
    con = asked(*SPARSE[kind])
    split = id_split(spark, database(), "t", rows_per_task=100)
    assert isinstance(split, RangeSplit)
    assert part_sizes(con, split) == [100] * 10
    assert id_split(spark, database(), "t", rows_per_task=10_000).predicates("mysql") == ["1 = 1"]


def test_dense_ids_are_cut_in_equal_steps(spark, asked):
    asked([i * 2 for i in range(1000)])
    assert id_split(spark, database(), "t", rows_per_task=100) == Split("id", 0, 1999, 10)
    asked(range(2**63 - 500, 2**63))
    assert id_split(spark, database(), "t", rows_per_task=100).options()["upperBound"] == str(2**63 - 1)
    asked([7])
    assert id_split(spark, database(), "t") == Split("id", 7, 8, 1)
    asked([])
    assert id_split(spark, database(), "t") is None
    asked([None, None])
    assert id_split(spark, database(), "t") is None


def test_repeated_and_missing_ids_lie_in_one_part(spark, asked):
    con = asked([None] * 50 + [5] * 300 + [10**12 + i * 10**6 for i in range(650)])
    split = id_split(spark, database(), "t", rows_per_task=100)
    assert max(part_sizes(con, split)) <= 450 and len(split.cuts) == len(set(split.cuts)) >= 6
    text = RangeSplit("uid", ("b", "o'x")).predicates("mysql")
    assert text == ["uid < 'b' OR uid IS NULL", "uid >= 'b' AND uid < 'o''x'", "uid >= 'o''x'"]


def test_table_choice():
    assert choose_tables(" custom_orders, ,custom_customers ", ["users"]) == ["custom_orders", "custom_customers"]
    assert choose_tables(None, ["transactions", "other", "users"]) == ["users", "transactions"]
    assert choose_tables("", ["x", "y"]) == ["x", "y"]


def test_report_rows_become_events(spark):
    rows = [
        (10, "20240105", "screen_view", "home", "iOS", 5, 3),
        (20, "20240106", "page_view", 'the "shop"', "Android 14", 2, 1),
        (30, "20240106", "first_open", "(not set)", "Windows", 1, 1),
    ]
    report = spark.createDataFrame(rows, f"pos BIGINT, {REPORT_COLUMNS}")
    one, two, three = dicts(ga4_normalize(report, "pos"), "id")
    assert (one["id"], one["user_id"], one["session_id"]) == ("ga4_1", "ga4_user_2", "ga4_sess_20240105_1")
    assert (one["event_name"], one["event_category"], one["platform"]) == ("home", "ga4_screen_view", "ios")
    assert one["properties_json"] == '{"ga4_event": "screen_view", "screen": "home", "event_count": 5}'
    assert str(one["created_at"]) == "2024-01-05 12:00:00"
    assert two["properties_json"] == '{"ga4_event": "page_view", "screen": "the \\"shop\\"", "event_count": 2}'
    assert (three["event_name"], three["event_category"], three["platform"]) == ("first_open", "ga4_event", "web")


def test_stand_in_users_wrap(spark):
    report = spark.range(1, 121).selectExpr(
        "id as pos", "'20240101' as date", "'e' as eventName", "'s' as unifiedScreenName", "'web' as platform", "id as eventCount"
    )
    got = {r["id"]: r["user_id"] for r in dicts(ga4_normalize(report, "pos"))}
    assert all(got[f"ga4_{i}"] == f"ga4_user_{i % 50 + 1}" for i in range(1, 121))


def test_sources_combine(spark):
    ids = spark.createDataFrame([(7, "a")], "id bigint, event_name string")
    both = union_event_sources(ids, raw(spark, "analytics_events", [{"id": "ga4_1", "event_name": "b", "platform": "ios"}]))
    assert [(r["id"], r["platform"]) for r in dicts(both, "id")] == [("7", None), ("ga4_1", "ios")]


def test_snapshots_skip_what_fails(spark, tmp_path):
    def fails():
        raise RuntimeError("no such table")

    written = write_snapshots({"users": lambda: raw(spark, "users", [{"id": 1}]), "gone": fails}, str(tmp_path))
    assert list(written) == ["users"]
    again = write_snapshots({"users": lambda: raw(spark, "users", [{"id": 2}, {"id": 3}])}, str(tmp_path))
    assert register_raw(spark, again) == ["raw_users"]
    assert spark.table("raw_users").count() == 2
    assert read_parquet_raw(spark, again["users"], "users").count() == 2
    with pytest.raises(ValueError, match="amount"):
        read_parquet_raw(spark, again["users"], "transactions")


def test_published_tables(spark, tmp_path):
    for name in MARTS:
        spark.catalog.dropTempView(name)
    with pytest.raises(LookupError, match="mart_event_funnel"):
        read_marts(spark, require_all=True)
    mart = mart_revenue(transactions(spark, [{"amount": 1.0}]))
    back = materialize_mart(mart, "mart_revenue", str(tmp_path / "m"), partition_by="metric_date")
    assert dicts(back.select(mart.columns)) == dicts(mart)
    assert list(read_marts(spark, require_all=False)) == ["mart_revenue"]
    spark.catalog.dropTempView("mart_revenue")


def test_versions_switch_when_they_are_complete(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_published(spark, path) is None
    numbers = [spark.range(n) for n in (1, 2, 3, 4)]
    materialize_mart(numbers[0], "numbers", path)
    waiting = stage_mart(numbers[1], "numbers", path)
    assert read_published(spark, path).count() == 1
    assert waiting.release().count() == 2 and read_published(spark, path).count() == 2
    broken = spark.range(5).selectExpr("assert_true(id < 3) as x", "id")
    with pytest.raises(Exception):
        materialize_mart(broken, "numbers", path)
    assert read_published(spark, path).count() == 2
    for df in numbers[2:]:
        materialize_mart(df, "numbers", path)
    assert read_published(spark, path).count() == 4
    assert len([n for n in os.listdir(path) if n.startswith("v")]) == 2
    spark.catalog.dropTempView("numbers")


def test_parts_of_a_source_table():
    split = split_range("id", 1, 1_000_000_000, 2000)
    assert split.options()["numPartitions"] == "2000" and split.options()["upperBound"] == "1000000001"
    assert split_range("id", 1, 3, 50).parts == 3
    for dialect in ("mysql", "postgresql"):
        conditions = HashSplit("uid", 3).predicates(dialect)
        assert len(conditions) == 3 and conditions[0].endswith("OR uid IS NULL") and "= 2" in conditions[2]


def test_session_rules(spark):
    assert build_session() is not None
    require_utc(spark)
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_empty_raw_tables_work(spark):
    assert empty_raw(spark, "transactions").count() == 0
    assert users(spark, []).count() == 0 and events(spark, [{"created_at": at(1)}]).count() == 1


def test_extraction(spark, tmp_path):
    tables = {"users": raw(spark, "users", [{"id": 1}]), "transactions": raw(spark, "transactions", [{"id": 5}])}

    def read(_, __, table):
        return tables[table]

    def available(*_):
        return ["audit", "transactions", "users"]

    written = extract(spark, database(), str(tmp_path / "a"), available=available, read=read)
    assert list(written) == ["users", "transactions"] and spark.table("raw_transactions").first()["id"] == 5
    assert list(extract(spark, database(), str(tmp_path / "b"), "gone, users", read=read)) == ["users"]
    with pytest.raises(RuntimeError, match="no table"):
        extract(spark, database(), str(tmp_path / "c"), "gone", read=read)
