import base64
import hashlib

import pytest
from check_oracle import connect, difference
from llm.helpers import SF_DIR

from tidemark.llm import archive
from tidemark.llm.registry import ORACLE, QUERIES
from tidemark.session import scratch_path

ROWS = [(5, "u5", "same"), (2, "u2\r\nX: y", "same"), (9, None, "same"), (3, "u3", None), (4, "u4", ""), (7, "u7", "é\r\n\r\nx" * 9000), (8, "u8", "one")]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS sha256", "1 AS payload")


def test_records_round_trip(spark):
    records, payloads = archive.write_archive(pages(spark, ROWS), scratch_path(spark, "a"))
    assert payloads.count() == 4
    got = {r.page_id: r for r in archive.read_archive(records, payloads).collect()}
    for page, _, html in ROWS:
        body = (html or "").encode()
        assert got[page].payload_bytes == len(body)
        assert got[page].payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
    assert {p: (r.record_type, r.refers_to) for p, r in got.items()} == {
        2: ("response", None), 5: ("revisit", 2), 9: ("revisit", 2), 3: ("response", None), 4: ("revisit", 3), 7: ("response", None), 8: ("response", None),
    }
    built = [archive.parse_record(bytes(r.record)) for r in archive.rebuild_records(records, payloads).collect()]
    assert {f["warc-target-uri"] for f, _ in built} >= {"u2%0D%0AX: y", "u7"}
    assert sorted(b for f, b in built if f["warc-type"] == "response") == sorted([b"", b"one", b"same", ROWS[5][2].encode()])


def test_short_payloads_are_all_responses(spark):
    records, payloads = archive.write_archive(pages(spark, ROWS), scratch_path(spark, "a"), least_revisit=5)
    assert {r.record_type for r in archive.read_archive(records, payloads).collect()} == {"response"}
    assert payloads.count() == 4


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "n", "t"), (1, "a", "t"), (1, "a", "t"), (None, "m", "only"), (None, "m", "only")]
    records, payloads = archive.write_archive(pages(spark, rows), scratch_path(spark, "a"))
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in archive.read_archive(records, payloads).collect()), key=str)
    assert got == sorted([(None, "revisit", 1), (1, "response", None), (1, "response", None), (None, "response", None), (None, "response", None)], key=str)
    assert payloads.count() == 2
    assert archive.read_archive(*archive.write_archive(pages(spark, []), scratch_path(spark, "a"))).count() == 0


def test_damage_is_seen(spark):
    records, payloads = archive.write_archive(pages(spark, ROWS), scratch_path(spark, "a"))
    wrong = payloads.selectExpr("sha256", "encode('xxxx', 'UTF-8') AS payload")
    with pytest.raises(Exception):
        archive.read_archive(records, wrong).collect()


def test_query_equals_sql(spark):
    assert difference(QUERIES["op4_content_archive"](spark, SF_DIR), connect(SF_DIR), ORACLE["op4_content_archive"]) is None
