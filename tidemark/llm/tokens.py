"""Token ids of documents in a seekable binary format.

A file is a run of independent zstandard frames, one for each run of documents, then the
frame directory (JSON) as a frame of its own, and a trailing seek table in the skippable
frame of the zstandard seekable format, with a checksum per frame. A reader of one
document reads the table, one frame, and nothing else.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import blocks, byte_class, lower_ascii, text_buffer
from tidemark.llm.tables import table
from tidemark.llm.units import UnitTable

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FRAME_TOKENS = 1 << 16
PART_BYTES = 32_000_000
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
CACHED_UNITS = 400_000

_BLANK = byte_class(lambda b: b == 32 or 9 <= b <= 13)
_LETTER = byte_class(lambda b: 97 <= b <= 122 or 65 <= b <= 90)
# Bytes next to which a word is never divided: they may join their neighbours in the tokenizer's own pattern.
_TIED = byte_class(lambda b: b >= 128 or chr(b) in "'<|>")


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of stretches that the tokenizer encodes apart from each other, and each text's first.

    White space parts them, and so does a change between ASCII letters and other ASCII
    characters where neither side nor its surroundings may join.
    """
    n = len(data)
    blank, letter, tied = _BLANK[data], _LETTER[data], _TIED[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins, stops = np.zeros(n, bool), np.zeros(n, bool)
    if n:
        change = np.zeros(n, bool)
        change[1:] = (letter[1:] != letter[:-1]) & ~tied[1:] & ~tied[:-1]
        begins = ~blank & (edge[:n] | change | np.append(True, blank[:-1]))
        stops = ~blank & (edge[1:] | np.append(change[1:], True) | np.append(blank[1:], True))
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class TokenEncoder:
    """Ids of whole texts by the tokenizer library, which sees each distinct unit once while the table lasts."""

    def __init__(self, path: str, limit: int = CACHED_UNITS):
        self.path = path
        self.table = UnitTable(self._encode, np.uint32, limit)

    def _encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        texts = [raw[a:b].decode("utf-8") for a, b in zip(starts.tolist(), ends.tolist())]
        got = [e.ids for e in _tokenizer(self.path).encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.uint32, int(size.sum())), size

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind each other and the n + 1 offsets into them."""
        lowered = lower_ascii(data)  # the tokenizer lower-cases anyway, but finds added tokens first
        starts, ends, first = _units(lowered, offsets)
        marks = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))  # "<|"
        if len(marks):
            for unit in np.unique(np.searchsorted(starts, marks, side="right") - 1).tolist():
                lowered[starts[unit] : ends[unit]] = data[starts[unit] : ends[unit]]
        ids, at = self.table(lowered, starts, ends)
        return ids, at[first]


@lru_cache(maxsize=2)
def _encoder(path: str) -> TokenEncoder:
    return TokenEncoder(path)


def pack_frames(frames: list[tuple[bytes, dict]]) -> bytes:
    """One file: frames, their directory, and the seek table (sizes and a CRC of each frame's content)."""
    packer = zstandard.ZstdCompressor(level=3, write_content_size=True)
    directory = json.dumps([d for _, d in frames], separators=(",", ":")).encode()
    body, entries = [], []
    for content in [c for c, _ in frames] + [directory]:
        packed = packer.compress(content)
        body.append(packed)
        entries.append(struct.pack("<III", len(packed), len(content), zlib.crc32(content)))
    footer = struct.pack("<IBI", len(entries), 0x80, SEEKABLE_MAGIC)
    payload = b"".join(entries) + footer
    return b"".join(body) + struct.pack("<II", SKIPPABLE_MAGIC, len(payload)) + payload


def seek_table(tail: bytes) -> list[tuple[int, int, int]]:
    """(packed size, content size, CRC) of each frame from the end of a file; ``tail`` must hold the whole table."""
    count, flags, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEKABLE_MAGIC or not flags & 0x80:
        raise ValueError("no seek table with checksums at the end")
    start = len(tail) - 9 - 12 * count
    if start < 8 or struct.unpack("<II", tail[start - 8 : start]) != (SKIPPABLE_MAGIC, 12 * count + 9):
        raise ValueError("the seek table is cut off")
    return [struct.unpack_from("<III", tail, start + 12 * i) for i in range(count)]


def read_frame(data: bytes, table: list[tuple[int, int, int]], number: int) -> bytes:
    """The checked content of one frame; no other frame is decompressed."""
    start = sum(size for size, _, _ in table[:number])
    content = zstandard.ZstdDecompressor().decompress(data[start : start + table[number][0]], max_output_size=table[number][1] or 1)
    if len(content) != table[number][1] or zlib.crc32(content) != table[number][2]:
        raise ValueError(f"frame {number} is damaged")
    return content


def read_documents(data: bytes, wanted: set[int] | None = None) -> Iterator[tuple[dict, np.ndarray]]:
    """(directory entry, ids) of the documents at the wanted places of a file (all if None)."""
    frames = seek_table(data)
    for number, frame in enumerate(json.loads(read_frame(data, frames, len(frames) - 1))):
        places = [p for p in range(len(frame["ids"])) if wanted is None or frame["place"] + p in wanted]
        if places:
            ids = np.frombuffer(read_frame(data, frames, number), "<u4")
            ends = np.cumsum(frame["counts"])
            for p in places:
                yield {"doc_id": frame["ids"][p], "place": frame["place"] + p}, ids[ends[p] - frame["counts"][p] : ends[p]]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", end_id: int = END_ID, part_bytes: int = PART_BYTES) -> DataFrame:
    """Writes the files as a table (part, piece, file) below ``path`` and reads it back.

    Documents stand by ascending id (NULL first, equal ids by text) over all parts: the
    ids are range-partitioned into about ``part_bytes`` of text each, every part is sorted
    and written in order. NULL texts are empty documents with the end id alone. Repeated
    rows are documents of their own. An empty table gives no files.
    """
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text_column)), F.lit(0))).first()[0]
    parts = max(1, -(-int(total) // part_bytes))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    # the hash splits a run of equal ids
    ordered = rows.repartitionByRange(parts, F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    schema = T.StructType(
        [T.StructField(n, t) for n, t in (("low_id", T.LongType()), ("low_hash", T.LongType()), ("piece", T.LongType()), ("n_docs", T.LongType()), ("n_tokens", T.LongType()), ("file", T.BinaryType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, piece, low = _encoder(tokenizer), 0, None
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            marks = batch.column("mark")
            if low is None and batch.num_rows:
                low = (ids[0], marks[0].as_py())
            data, offsets = text_buffer(batch.column("text"))
            frames, place, tokens = [], 0, 0
            for first, end, part, part_offsets in blocks(data, offsets):
                values, at = encoder.encode(part, part_offsets)
                counts = np.diff(at) + 1
                stream = np.insert(values, at[1:], end_id).astype("<u4")
                ends = np.cumsum(counts)
                start = 0
                while start < end - first:
                    done = ends[start - 1] if start else 0
                    stop = max(start + 1, int(np.searchsorted(ends, done + FRAME_TOKENS, side="right")))
                    content = stream[done : ends[stop - 1]].tobytes()
                    frames.append((content, {"place": place, "ids": ids[first + start : first + stop], "counts": counts[start:stop].tolist()}))
                    place += stop - start
                    start = stop
                tokens += len(stream)
            if frames:
                columns = [pa.array([v], t) for v, t in ((low[0], pa.int64()), (low[1], pa.int64()), (piece, pa.int64()), (place, pa.int64()), (tokens, pa.int64()), (pack_frames(frames), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)
                piece += 1

    ordered.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(run, schema).write.parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32; frames are checked against their sums.

    Only the small table of files (one row for each) is put in order; its running total
    of tokens, at most one row per ``PART_BYTES`` of text or Arrow batch, gives each file's start.
    """
    from pyspark.sql import Window as W

    key = ["low_id", "low_hash", "piece"]
    order = W.orderBy(F.col("low_id").asc_nulls_first(), "low_hash", "piece").rowsBetween(W.unboundedPreceding, -1)
    starts = files.select(*key, F.coalesce(F.sum("n_tokens").over(order), F.lit(0).cast("long")).alias("file_start"))
    fields = ["doc_id", "file_place", "n_tokens", "ids_crc32"]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in key + fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, file in enumerate(batch.column("file")):
                rows, at = [], 0
                for entry, values in read_documents(file.as_py()):
                    rows.append((entry["doc_id"], at, len(values), zlib.crc32(values.tobytes())))
                    at += len(values)
                heads = [pa.array([batch.column(k)[row].as_py()] * len(rows), pa.int64()) for k in key]
                yield pa.RecordBatch.from_arrays(heads + [pa.array(x, pa.int64()) for x in zip(*rows)], schema.names)

    places = files.select(*key, "file").mapInArrow(run, schema).alias("p")
    same = F.col("p.low_id").eqNullSafe(F.col("s.low_id")) & (F.col("p.low_hash") == F.col("s.low_hash")) & (F.col("p.piece") == F.col("s.piece"))
    joined = places.join(starts.alias("s"), same)
    return joined.select("p.doc_id", (F.col("file_place") + F.col("file_start")).alias("start"), "p.n_tokens", "p.ids_crc32")


def op3_token_files(spark, sf_dir: str) -> DataFrame:
    """Per document of the files read back: place in the token stream, tokens, checksum."""
    import public_tokenizers

    from tidemark.session import scratch_path

    files = write_token_files(table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"), public_tokenizers.path(VOCABULARY))
    return read_token_files(files)
