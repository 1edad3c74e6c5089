"""Removal of repeated byte strings by suffix arrays over shards.

Every window of 200 bytes belongs to the shard of its smallest k-gram hash, so equal
windows meet, and windows that follow each other with the same smallest hash travel as
one segment. Hashes that occur once drop out. Segments that occur twice whole are repeats
as they are. The distinct contents that are left, the edges of repeated passages, are
sorted by induced sorting, and the permuted common prefixes tell which windows recur.

A hash with many distinct contents is split by longer k-grams, at the last by the windows
themselves, so no shard grows with the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import BYTE_VALUES, U64, add_columns, blocks, mix, powers, ranges, text_buffer
from tidemark.llm.suffixes import induced_suffix_array, permuted_lcp
from tidemark.llm.tables import cut, table

WINDOW = 200
GRAM = 32
LONGER_GRAMS = (128, 176, 192, WINDOW)
SEGMENT_BYTES = 1_000_000  # text handled at a time; the arrays on it take about 150 bytes for each
LONGEST_RUN = 512  # windows in a segment
GROUP = 512  # distinct contents of one hash that are sorted together
SHARD_BYTES = 500_000


def segments(data: np.ndarray, offsets: np.ndarray, gram: int, window: int = WINDOW) -> dict[str, np.ndarray]:
    """Runs of windows with the same smallest gram hash, inside single texts.

    row, start (in the text), count (windows), key (that hash), content (hash of the bytes),
    and whether the key occurs more than once inside, so that windows may recur there.
    """
    n = len(data)
    up, down = powers(n)
    sums = np.zeros(n + 1, U64)
    np.cumsum(BYTE_VALUES[data] * up[:n], out=sums[1:], dtype=U64)
    sizes = np.maximum(np.diff(offsets) - window + 1, 0)
    empty = np.zeros(0, np.int64)
    if n < window or not sizes.any():
        return {"row": empty, "start": empty, "count": empty, "key": empty.view(U64), "content": empty.view(U64), "again": empty.astype(bool)}
    hashes = mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    smallest = _sliding_min(hashes, window - gram + 1)
    place = ranges(offsets[:-1], sizes)
    least = smallest[place]
    fresh = np.append(True, (least[1:] != least[:-1]) | (place[1:] != place[:-1] + 1))
    first = np.flatnonzero(fresh)
    length = np.diff(np.append(first, len(place)))
    if length.max() > LONGEST_RUN:
        pieces = -(-length // LONGEST_RUN)
        step = ranges(np.zeros(len(first), np.int64), pieces) * LONGEST_RUN
        length = np.minimum(np.repeat(length, pieces) - step, LONGEST_RUN)
        first = np.repeat(first, pieces) + step
    begin, key = place[first], least[first]
    end = begin + length + window - 1
    content = mix((sums[end] - sums[begin]) * down[begin] + length.astype(U64))
    inner = length + window - gram
    seen = np.add.reduceat((hashes[ranges(begin, inner)] == np.repeat(key, inner)).astype(np.int32), np.cumsum(inner) - inner)
    row = np.searchsorted(offsets, begin, side="right") - 1
    return {"row": row, "start": begin - offsets[row], "count": length, "key": key, "content": content, "again": seen > 1}


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _by_block(batch: pa.RecordBatch) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    data, offsets = text_buffer(batch.column("text"))
    for low, _, part, part_offsets in blocks(data, offsets, SEGMENT_BYTES):
        yield low, segments(part, part_offsets, GRAM)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _repeated_keys(texts: DataFrame) -> DataFrame:
    """(key, same): keys that occur more than once, and whether with one content only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, s in _by_block(batch):
                # a key that recurs inside its segment counts as two contents
                key, content = np.concatenate([s["key"], s["key"][s["again"]]]), np.concatenate([s["content"], ~s["content"][s["again"]]])
                order = np.argsort(key, kind="stable")
                key, content = key[order], content[order]
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
                low = np.minimum.reduceat(content, first) if len(first) else content
                high = np.maximum.reduceat(content, first) if len(first) else content
                yield pa.RecordBatch.from_arrays([_signed(key[first]), pa.array(np.diff(np.append(first, len(key)))), _signed(low), _signed(high)], ["key", "n", "low", "high"])

    counted = texts.mapInArrow(run, "key long, n long, low long, high long").groupBy("key")
    # low and high are compared as signed here and unsigned there; both tell one content from several
    counted = counted.agg(F.sum("n").alias("n"), F.min(F.least("low", "high")).alias("low"), F.max(F.greatest("low", "high")).alias("high"))
    return counted.where("n > 1").select("key", (F.col("low") == F.col("high")).alias("same"))


def _all_segments(texts: DataFrame) -> DataFrame:
    """(key, content, text1, text2, at): each segment with its text's key; ``at`` holds start and count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [batch.column(c) for c in ("text1", "text2")]
            for low, s in _by_block(batch):
                row = pa.array(low + s["row"])
                at = pa.array(s["start"] * 1024 + s["count"])
                yield pa.RecordBatch.from_arrays([_signed(s["key"]), _signed(s["content"]), *(c.take(row) for c in names), at], ["key", "content", "text1", "text2", "at"])

    return texts.mapInArrow(run, "key long, content long, text1 long, text2 long, at long")


def _cut_out(rows: DataFrame) -> DataFrame:
    """The bytes of wanted segments from their texts; equal texts give the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            wanted = batch.column("wanted").to_pylist()
            out: list[tuple] = []
            for row, asked in enumerate(wanted):
                base = int(offsets[row])
                for w in asked:
                    start, count = w["at"] >> 10, w["at"] & 1023
                    out.append((w["key"], w["n"], start, count, data[base + start : base + start + count + WINDOW - 1].tobytes(), row))
            at = pa.array([o[5] for o in out], pa.int64())
            columns = [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns + [batch.column(c).take(at) for c in ("text1", "text2")], ["key", "n", "start", "count", "bytes", "text1", "text2"])

    return rows.select("text", "text1", "text2", "wanted").mapInArrow(run, _CONTENTS)


_CONTENTS = "key long, n long, start long, count long, bytes binary, text1 long, text2 long"
_SPANS = "text1 long, text2 long, start long, end long"


def sorted_repeats(contents: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """For each content, the starts of windows that also start elsewhere in any of them."""
    sizes = np.array([len(c) for c in contents], np.int64)
    first = np.cumsum(sizes + 1) - sizes - 1
    s = np.ones(int((sizes + 1).sum()) + 1, np.int16)
    s[-1] = 0
    flat = np.frombuffer(b"".join(contents), np.uint8)
    s[ranges(first, sizes)] = flat.astype(np.int16) + 2
    sa = induced_suffix_array(s)
    shared = permuted_lcp(s, sa, 1)[sa] >= window
    marked = np.zeros(len(s), bool)
    marked[sa[shared]] = True
    marked[sa[:-1][shared[1:]]] = True
    places = np.flatnonzero(marked)
    edges = np.searchsorted(places, np.append(first, len(s)))
    return [places[a:b] - f for a, b, f in zip(edges, edges[1:], first)]


def _runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(starts):
        return starts, starts
    fresh = np.append(True, starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(fresh)
    return starts[first], starts[np.append(first[1:], len(starts)) - 1]


def _sort_shards(contents: DataFrame) -> DataFrame:
    """Spans of repeated windows in contents that occur once; contents of a key stay in one shard."""

    def solve(shard: list[tuple]) -> pa.RecordBatch:
        out: list[tuple] = []
        for (n, start, _, text1, text2), found in zip(shard, sorted_repeats([r[2] for r in shard])):
            if n == 1:
                for a, b in zip(*_runs(found)):
                    out.append((text1, text2, start + int(a), start + int(b) + WINDOW))
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(4)], ["text1", "text2", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size, key = [], 0, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "n", "start", "bytes", "text1", "text2")]
            for k, *row in zip(*columns):
                if k != key and size >= SHARD_BYTES:
                    yield solve(shard)
                    shard, size = [], 0
                key = k
                shard.append(tuple(row))
                size += len(row[2])
        if shard:
            yield solve(shard)

    ordered = contents.select("key", "n", "start", "bytes", "text1", "text2").repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(run, _SPANS)


def _divide(contents: DataFrame, gram: int) -> DataFrame:
    """The same windows under the hashes of longer grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("bytes").to_pylist()
            offsets = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)
            data = np.frombuffer(b"".join(raw), np.uint8)
            for low, _, part, part_offsets in blocks(data, offsets, SEGMENT_BYTES):
                s = segments(part, part_offsets, gram)
                row = low + s["row"]
                at, base = pa.array(row), np.asarray(batch.column("start"))[row]
                cuts = [raw[r][a : a + c + WINDOW - 1] for r, a, c in zip(row.tolist(), s["start"].tolist(), s["count"].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [_signed(s["key"]), batch.column("n").take(at), pa.array(base + s["start"]), pa.array(s["count"]), pa.array(cuts, pa.binary()), batch.column("text1").take(at), batch.column("text2").take(at), pa.array(s["again"])],
                    ["key", "n", "start", "count", "bytes", "text1", "text2", "again"],
                )

    return contents.mapInArrow(run, _CONTENTS + ", again boolean")


def _sorted_spans(contents: DataFrame) -> DataFrame:
    """Spans from contents by key: small groups are sorted, large ones divided and looked at again."""
    spans = None
    for gram in (*LONGER_GRAMS, None):
        sizes = cut(contents.groupBy("key").agg(F.count("*").alias("size")), "group-sizes")
        sized = contents.join(sizes, "key")
        small = cut(_sort_shards(sized.where(F.col("size") <= GROUP).drop("size")), "sorted-spans")
        spans = small if spans is None else spans.union(small)
        large = sized.where(F.col("size") > GROUP).drop("size")
        if not sizes.where(F.col("size") > GROUP).limit(1).count():
            return spans
        if gram is None:  # single windows: all of a key are equal
            here = large.select("text1", "text2", "start", (F.col("start") + F.col("count") + WINDOW - 1).alias("end"), "n")
            return spans.union(here.where("n = 1").drop("n"))
        divided = cut(_divide(large, gram), "divided")
        # one content per (key, bytes); a key alone is no repeat unless it recurs inside
        held = F.struct("start", "count", "text1", "text2")
        one = divided.groupBy("key", F.sha2("bytes", 256).alias("sha")).agg(
            F.sum("n").alias("n"), F.min_by("bytes", held).alias("bytes"), F.min(held).alias("held"), F.max("again").alias("again")
        )
        one = cut(one, "divided-contents")
        # those that occur twice whole are repeats as they are
        twice = divided.withColumn("sha", F.sha2("bytes", 256)).join(one.where("n > 1").select("key", "sha"), ["key", "sha"])
        whole = cut(twice.where("n = 1").select("text1", "text2", "start", (F.col("start") + F.col("count") + WINDOW - 1).alias("end")), "divided-spans")
        spans = spans.union(whole)
        several = cut(one.groupBy("key").agg(F.count("*").alias("contents"), F.max("again").alias("inside")).where("contents > 1 or inside").select("key"), "divided-keys")
        contents = cut(one.join(several, "key").select("key", "n", "held.start", "held.count", "bytes", "held.text1", "held.text2"), "contents")
    return spans


def find_repeats(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Spans (text1, text2, start, end) in bytes of all windows that also start elsewhere, by the two hashes of a text."""
    texts = docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    named = texts.withColumns(_text_key(F.col("text")))
    keys = cut(_repeated_keys(texts), "repeated-keys")
    hits = cut(_all_segments(named).join(keys, "key"), "repeated-segments")
    ends = [(F.shiftright("at", 10)).alias("start"), (F.shiftright("at", 10) + F.col("at").bitwiseAND(F.lit(1023)) + WINDOW - 1).alias("end")]
    whole = hits.where("same").select("text1", "text2", *ends)
    mixed = hits.where("not same")
    held = F.struct("text1", "text2", "at")
    one = cut(mixed.groupBy("key", "content").agg(F.count("*").alias("n"), F.min(held).alias("held")), "distinct-contents")
    twice = mixed.join(one.where("n > 1").select("key", "content"), ["key", "content"]).select("text1", "text2", *ends)
    wanted = one.groupBy("held.text1", "held.text2").agg(F.collect_list(F.struct("key", "n", F.col("held.at").alias("at"))).alias("wanted"))
    wanted = cut(wanted, "wanted-segments")
    contents = cut(_cut_out(named.join(wanted, ["text1", "text2"])).dropDuplicates(["key", "text1", "text2", "start"]), "contents")
    return whole.union(twice).union(_sorted_spans(contents))


def _text_key(text) -> dict:
    return {"text1": F.xxhash64(text), "text2": F.xxhash64(text, F.lit(7))}


REPEATED = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_REPEATED = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def mark_repeats(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """All columns and ``repeated``: maximal byte ranges covered by strings of 200 bytes that also start elsewhere.

    Elsewhere is any other place, in the same text too; strings are judged on the input and
    never cross texts. NULL and texts of fewer than 200 bytes have no repeats; repeated rows
    are copies of each other, so all of a long enough one is repeated. An own column
    ``repeated`` is replaced. Texts and segments count as equal with their 128-bit hashes.
    """
    spans = find_repeats(docs, text_column).distinct().groupBy("text1", "text2").agg(F.collect_list(F.struct("start", "end")).alias("__found"))
    spans = cut(spans.withColumnsRenamed({"text1": "__text1", "text2": "__text2"}), "spans-by-text")
    own = _text_key(F.coalesce(F.col(text_column), F.lit("")))
    named = docs.withColumns({f"__{k}": v for k, v in own.items()})
    joined = named.join(spans, ["__text1", "__text2"], "left").drop("__text1", "__text2")

    def build(batch: pa.RecordBatch) -> list:
        return [pa.array([_union(r) for r in batch.column("__found").to_pylist()], _REPEATED)]

    return add_columns(joined, build, [T.StructField("repeated", REPEATED)]).drop("__found")


def _union(found: list[dict] | None) -> list[dict]:
    out: list[dict] = []
    for start, end in sorted((f["start"], f["end"]) for f in found or []):
        if out and start <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"start": start, "end": end})
    return out


def keep_bytes(text: bytes, repeated: list[dict]) -> bytes:
    out, at = [], 0
    for r in repeated:
        out.append(text[at : r["start"]])
        at = r["end"]
    return b"".join(out + [text[at:]])


def remove_repeats(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The same columns; repeated byte ranges are gone from the text (a character cut in two becomes U+FFFD), NULL stays NULL."""

    def build(batch: pa.RecordBatch) -> list:
        texts, found = batch.column(text_column).to_pylist(), batch.column("repeated").to_pylist()
        return [pa.array([keep_bytes(t.encode(), r).decode("utf-8", "replace") if t and r else t for t, r in zip(texts, found)], pa.string())]

    return add_columns(mark_repeats(docs, text_column), build, [T.StructField(text_column, T.StringType())]).select(docs.columns)


def op10_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: bytes, removed bytes and runs, hash of what is kept."""
    marked = mark_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def build(batch: pa.RecordBatch) -> list:
        data, offsets = text_buffer(batch.column("text"))
        found = batch.column("repeated").to_pylist()
        kept = [hashlib.sha256(keep_bytes(data[a:b].tobytes(), r)).hexdigest() for a, b, r in zip(offsets, offsets[1:], found)]
        removed = [sum(r["end"] - r["start"] for r in rs) for rs in found]
        return [pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array([len(r) for r in found], pa.int64()), pa.array(kept, pa.string())]

    fields = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept_sha256", T.StringType())]
    return add_columns(marked, build, fields).drop("text", "repeated")
