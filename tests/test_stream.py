import json
import os
from datetime import date, timedelta

import pytest
from fixtures import dicts
from test_ingest import batches, posted

from tidemark.operators.ingest import ENVELOPE_SCHEMA, ingest_batch_policy
from tidemark.sinks import compact_ingested, store_ingested
from tidemark.streaming import ingest_stream, read_ingested


def run(spark, source, root, policy):
    stream = spark.readStream.schema(ENVELOPE_SCHEMA).parquet(source)
    query = ingest_stream(stream, f"{root}/out", f"{root}/bad", f"{root}/state", policy, once=True)
    query.awaitTermination()
    return read_ingested(spark, f"{root}/out").drop("arrival_date"), read_ingested(spark, f"{root}/bad", rejected=True).drop("arrival_date")


def test_stream_equals_batch(spark, tmp_path):
    good = {"event_name": "a", "user_id": "u", "properties": {"k": 1}}
    env = posted(spark, good, "{oops").union(batches(spark, [good, {"event_name": ""}, good], [good]).selectExpr(
        "concat('x', batch_id) as batch_id", "endpoint", "value", "arrival_ts", "auth_user_id", "forwarded_for", "peer_address", "user_agent"
    ))
    source = str(tmp_path / "in")
    env.write.parquet(source)
    for policy in ("atomic", "lenient"):
        stored, rejected = run(spark, source, str(tmp_path / policy), policy)
        want_stored, want_rejected = ingest_batch_policy(env, policy)
        assert dicts(stored, "id") == dicts(want_stored, "id")
        assert dicts(rejected, "batch_id") == dicts(want_rejected, "batch_id")


def test_long_batches_are_stored_whole(spark, tmp_path):
    source = str(tmp_path / "in")
    batches(spark, [{"event_name": "a"}] * 501).write.parquet(source)
    stored, rejected = run(spark, source, str(tmp_path / "run"), "lenient")
    assert stored.count() == 501 and rejected.count() == 0
    assert [d for d in os.listdir(tmp_path / "run" / "out") if "=" in d] == ["arrival_date=2024-05-01"]


def test_batch_store(spark, tmp_path):
    env = batches(spark, [{"event_name": "a"}, {"event_name": ""}])
    for _ in range(2):
        store_ingested(env, str(tmp_path / "out"), str(tmp_path / "bad"), writer="load-1", policy="lenient")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    assert [r["pos"] for r in dicts(spark.read.parquet(str(tmp_path / "bad")))] == [1]


def test_restart_reads_only_new_files(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "run")
    posted(spark, {"event_name": "a"}).write.parquet(source)
    assert run(spark, source, root, "atomic")[0].count() == 1
    assert run(spark, source, root, "atomic")[0].count() == 1
    posted(spark, {"event_name": "b"}).write.mode("append").parquet(source)
    stored, _ = run(spark, source, root, "atomic")
    assert [r["event_name"] for r in dicts(stored, "event_name")] == ["a", "b"]
    assert json.dumps(stored.columns).count("epoch") == 0


def names_of(spark, path, rejected=False):
    return sorted(r["event_name"] for r in dicts(read_ingested(spark, str(path), rejected)))


def test_two_loads_of_one_day_keep_all_rows(spark, tmp_path):
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    store_ingested(posted(spark, {"event_name": "a"}, "{oops"), out, bad, writer="load-1")
    store_ingested(posted(spark, {"event_name": "b"}, "{oops"), out, bad, writer="load-2")
    assert names_of(spark, out) == ["a", "b"]
    assert read_ingested(spark, bad, rejected=True).count() == 2
    store_ingested(posted(spark, {"event_name": "b"}, "{oops"), out, bad, writer="load-2")
    assert names_of(spark, out) == ["a", "b"]
    with pytest.raises(TypeError):
        store_ingested(posted(spark, {"event_name": "b"}), out, bad)
    for name in ("", "a/b", "x=1", "compacted"):
        with pytest.raises(ValueError):
            store_ingested(posted(spark, {"event_name": "b"}), out, bad, writer=name)


def test_two_streams_into_one_folder(spark, tmp_path):
    """The second checkpoint starts at epoch 0 again; nothing of the first is lost."""
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    for name in ("a", "b"):
        source = str(tmp_path / f"in-{name}")
        posted(spark, {"event_name": name}).write.parquet(source)
        stream = spark.readStream.schema(ENVELOPE_SCHEMA).parquet(source)
        ingest_stream(stream, out, bad, str(tmp_path / f"state-{name}"), once=True).awaitTermination()
    store_ingested(posted(spark, {"event_name": "c"}), out, bad, writer="by-hand")
    assert names_of(spark, out) == ["a", "b", "c"]


def test_a_micro_batch_that_runs_again_adds_nothing(spark, tmp_path):
    """The commit of the last micro-batch is lost, as in a crash after its write."""
    source, root = str(tmp_path / "in"), str(tmp_path / "run")
    posted(spark, {"event_name": "a"}, {"event_name": "b"}).write.parquet(source)
    assert run(spark, source, root, "atomic")[0].count() == 2
    for name in os.listdir(f"{root}/state/commits"):
        os.rename(f"{root}/state/commits/{name}", str(tmp_path / name.strip(".")))
    assert run(spark, source, root, "atomic")[0].count() == 2


def test_repeated_posts_are_left_out_over_restarts(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "run")
    first = posted(spark, {"event_name": "a"}, {"event_name": "b"})
    again = first.where("batch_id = 'b0'").selectExpr("batch_id", "endpoint", "value", "arrival_ts + INTERVAL 5 MINUTES AS arrival_ts", *first.columns[4:])
    later = first.where("batch_id = 'b1'").selectExpr("'b7' AS batch_id", *first.columns[1:])
    for part in (first, again, later.union(again)):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(ENVELOPE_SCHEMA).parquet(source)
        query = ingest_stream(stream, f"{root}/out", f"{root}/bad", f"{root}/state", once=True, repeats_within=timedelta(hours=1))
        query.awaitTermination()
    assert names_of(spark, f"{root}/out") == ["a", "b", "b"]


def test_compaction_of_a_closed_day(spark, tmp_path):
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    for i in range(4):
        day = f"arrival_ts + INTERVAL {i // 3} DAYS AS arrival_ts"
        env = posted(spark, {"event_name": f"e{i}"}, "{oops").selectExpr("batch_id", "endpoint", "value", day, "auth_user_id", "forwarded_for", "peer_address", "user_agent")
        store_ingested(env, out, bad, writer=f"load-{i}")
    before, rejected = dicts(read_ingested(spark, out), "event_name"), dicts(read_ingested(spark, bad, rejected=True), "arrival_date")
    assert compact_ingested(spark, out, date(2024, 5, 1)) == 3
    assert compact_ingested(spark, bad, date(2024, 5, 1), rejected=True) == 3
    assert dicts(read_ingested(spark, out), "event_name") == before
    assert dicts(read_ingested(spark, bad, rejected=True), "arrival_date") == rejected
    assert os.listdir(f"{out}/arrival_date=2024-05-01") == ["writer=compacted"]
    assert compact_ingested(spark, out, date(2024, 5, 1)) == 1 and compact_ingested(spark, out, date(2020, 1, 1)) == 0
    store_ingested(posted(spark, {"event_name": "e9"}), out, bad, writer="load-9")
    assert compact_ingested(spark, out, date(2024, 5, 1)) == 2
    assert names_of(spark, out) == ["e0", "e1", "e2", "e3", "e9"]


def test_a_broken_off_compaction_is_finished(spark, tmp_path):
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    for name in ("a", "b"):
        store_ingested(posted(spark, {"event_name": name}), out, bad, writer=name)
    day = "arrival_date=2024-05-01"
    rows = read_ingested(spark, out).drop("arrival_date")
    rows.coalesce(1).write.parquet(f"{out}/_fresh/{day}/writer=compacted/epoch=0")
    os.makedirs(f"{out}/_aside")
    os.rename(f"{out}/{day}", f"{out}/_aside/{day}")
    assert compact_ingested(spark, out, date(2024, 5, 1)) == 0
    assert names_of(spark, out) == ["a", "b"] and os.listdir(f"{out}/_aside") == []
