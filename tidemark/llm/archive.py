"""Content-addressed web archive.

Payload bytes are stored once, under their SHA-256, in a payload table; the exact header
of each record stands in a record table. A join of the two gives back every record byte
for byte, and readers verify length and both digests.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import add_columns
from tidemark.llm.tables import table

# Fixed values of the record format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2024-01-01T00:00:00Z"
PAYLOAD_TYPE = "text/html; charset=utf-8"


def record_header(page: str, url: str, kind: str, digest: str, length: int, refers: str | None, refers_url: str | None) -> bytes:
    """Header lines of a record and the empty line after them; a revisit has an empty block."""
    lines = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Date: {RECORD_DATE}",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {length}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>", f"WARC-Refers-To-Target-URI: {_line(refers_url)}"]
    lines += [f"Content-Type: {PAYLOAD_TYPE}", f"Content-Length: {length if kind == 'response' else 0}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _line(value: str | None) -> str:
    """A header value: controls would end the line, so they are percent-escaped."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value or "")


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields (lower case) and the block of one record; raises if its parts do not fit."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or lines[0] != VERSION:
        raise ValueError("not a record of this version")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("the block does not have its stated length")
    return fields, rest[:size]


def write_archive(pages: DataFrame, path: str, least_revisit: int = 0, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> tuple[DataFrame, DataFrame]:
    """Writes ``path/payloads`` (sha256, payload) and ``path/records`` (one row per record) and reads both back.

    Of records with equal payloads of at least ``least_revisit`` bytes, the one with the
    smallest id is the response and the others revisit it; shorter payloads are all
    responses. NULL payloads count as empty. Rows with a NULL id are the last to be chosen;
    of repeated rows with the smallest id all are responses, as none can refer to another.
    Payloads move once, keyed by id, and only those of responses are stored; groups of
    equal payloads are reduced to one row per digest before anything is joined.
    """
    spark = pages.sparkSession
    body = F.encode(F.coalesce(F.col(html_column), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), body.alias("payload"))
    digests = rows.select("page_id", "url", F.sha2("payload", 256).alias("sha256"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    digests.write.parquet(f"{path}/digests")
    digests = spark.read.schema(digests.schema).parquet(f"{path}/digests")
    first = F.min_by(F.struct("page_id", "url"), F.struct(F.col("page_id").isNull(), F.col("page_id"), F.coalesce(F.col("url"), F.lit(""))))
    owners = digests.groupBy("sha256").agg(first.alias("owner"))
    owners.write.parquet(f"{path}/owners")
    owners = spark.read.schema(owners.schema).parquet(f"{path}/owners")
    known = digests.join(owners, "sha256")
    revisit = (F.col("payload_bytes") >= least_revisit) & ~F.col("page_id").eqNullSafe(F.col("owner.page_id"))

    def heads(batch: pa.RecordBatch) -> list:
        get = {n: batch.column(n).to_pylist() for n in ("page_id", "url", "sha1", "payload_bytes", "kind", "refers", "refers_url")}
        digest = [base64.b32encode(bytes.fromhex(s)).decode() for s in get["sha1"]]
        made = [record_header(str(p), u, k, d, n, r, v) for p, u, k, d, n, r, v in zip(get["page_id"], get["url"], get["kind"], digest, get["payload_bytes"], get["refers"], get["refers_url"])]
        return [pa.array(made, pa.binary())]

    plain = known.select(
        "page_id", "url", "sha256", "sha1", "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("owner.page_id").cast("string")).alias("refers"),
        F.when(revisit, F.col("owner.url")).alias("refers_url"),
    )
    records = add_columns(plain, heads, [T.StructField("header", T.BinaryType())]).select("sha256", "kind", "header")
    records.write.parquet(f"{path}/records")
    # one copy per digest: that of its owner; ids repeat only in repeated rows
    owned = owners.select(F.col("owner.page_id").alias("owner_id"), "sha256")
    found = rows.join(owned, rows.page_id.eqNullSafe(owned.owner_id) & (F.sha2(rows.payload, 256) == owned.sha256)).select("sha256", "payload")
    # only repeated rows can bring a payload twice; payloads move once more if there are any
    repeated = digests.groupBy("page_id", "sha256").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    (found.dropDuplicates(["sha256"]) if repeated else found).write.parquet(f"{path}/payloads")
    return spark.read.schema("sha256 string, kind string, header binary").parquet(f"{path}/records"), spark.read.schema("sha256 string, payload binary").parquet(f"{path}/payloads")


def rebuild_records(records: DataFrame, payloads: DataFrame) -> DataFrame:
    """``sha256`` and ``record``: each record as written, header, block and end mark."""
    responses = records.where("kind = 'response'").join(payloads, "sha256")
    end = F.encode(F.lit("\r\n\r\n"), "UTF-8")
    full = responses.select("sha256", F.concat("header", "payload", end).alias("record"))
    return full.union(records.where("kind <> 'response'").select("sha256", F.concat("header", end).alias("record")))


def read_archive(records: DataFrame, payloads: DataFrame) -> DataFrame:
    """Fields of each record, parsed from its rebuilt bytes; blocks are checked against both digests and their length.

    page_id, payload_bytes, payload_digest, record_type, refers_to. A payload that does not have its
    digest stops the read.
    """
    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for sha256, record in zip(batch.column("sha256").to_pylist(), batch.column("record")):
                named, block = parse_record(record.as_py())
                digest = named["warc-payload-digest"].removeprefix("sha1:")
                if named["warc-type"] == "response":
                    if hashlib.sha256(block).hexdigest() != sha256 or base64.b32encode(hashlib.sha1(block).digest()).decode() != digest:
                        raise ValueError(f"payload {sha256} is damaged")
                out.append((_page(named["warc-record-id"]), int(named["x-payload-length"]), digest, named["warc-type"], _page(named.get("warc-refers-to"))))
            columns = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return rebuild_records(records, payloads).mapInArrow(run, schema)


def _page(urn: str | None) -> int | None:
    value = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value not in ("", "None") else None


def op4_content_archive(spark, sf_dir: str) -> DataFrame:
    """Per page, from the archive read back: payload size and digest, record type, the response referred to."""
    from tidemark.session import scratch_path

    return read_archive(*write_archive(table(spark, sf_dir, "pages"), scratch_path(spark, "archive")))


# SHA-1 to base32 needs the 160 bits in groups of five.
OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
o AS (SELECT hex, payload_bytes, min(page_id) AS owner FROM p GROUP BY hex, payload_bytes),
b AS (SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + ((('0x' || substr(hex || '0', 1 + (i * 5) // 4, 2))::INT >> (3 - (i * 5) % 4)::INT) % 32), 1), '' ORDER BY i) AS b32
  FROM (SELECT DISTINCT hex FROM o), range(32) r(i) GROUP BY hex)
SELECT p.page_id, p.payload_bytes, b.b32 AS payload_digest, CASE WHEN p.page_id = o.owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id <> o.owner THEN o.owner END AS refers_to
FROM p JOIN o USING (hex, payload_bytes) JOIN b USING (hex)
"""
