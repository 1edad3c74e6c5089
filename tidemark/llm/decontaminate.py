"""Benchmark decontamination by training suffix arrays.

Each task is a shard of the documents. Runs of 10 benchmark words (or whole shorter
items) that a shard holds at all point out its documents of interest; the words of
those documents form the shard's suffix array. Every test suffix that can start a
window is binary-searched in it, which gives all verbatim places and the longest match.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import U64, add_columns, blocks, byte_class, grams, lower_ascii, member, ranges, span_hashes, spans, text_buffer

WINDOW = 10
BENCHMARK_BLOCK_BYTES = 32_000_000

# [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing: digits, letters, and all bytes of non-ASCII characters
_IN_WORD = byte_class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and per text the index of its first word (n + 1 values)."""
    lowered = lower_ascii(data)
    starts, ends, first = spans(lowered, offsets, _IN_WORD)
    return span_hashes(lowered, starts, ends), first


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by their first ``depth`` symbols at least, by prefix doubling."""
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    n, width = len(symbols), 1
    order = np.argsort(rank, kind="stable")
    while width < depth:
        following = np.full(n, -1, np.int64)
        following[: max(0, n - width)] = rank[width:]
        key = rank * (n + 1) + following + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.zeros(n, np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank, width = fresh, width * 2
        if n and rank.max() == n - 1:
            break
    return order


@dataclass
class TestSuffixes:
    """The words of a block of items behind each other, and which places start a window of which length."""

    symbols: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    owner: np.ndarray  # item of each start
    items: list[str]

    @classmethod
    def of(cls, rows: list[tuple[str, str]]) -> TestSuffixes:
        data, offsets = text_buffer(pa.array([t or "" for _, t in rows], pa.large_string()))
        symbols, first = words_of(data, offsets)
        counts = np.diff(first)
        lengths = np.minimum(counts, WINDOW)
        windows = np.where(counts > 0, counts - lengths + 1, 0)
        owner = np.repeat(np.arange(len(rows)), windows)
        return cls(symbols, ranges(first[:-1], windows), np.repeat(lengths, windows), owner, [i for i, _ in rows])

    def seeds(self) -> dict[int, np.ndarray]:
        """Sorted hashes of all windows by their length."""
        out = {}
        for k in np.unique(self.lengths).tolist():
            out[k] = np.unique(grams(self.symbols, k)[self.starts[self.lengths == k]])
        return out


def _compare(text: np.ndarray, at: np.ndarray, test: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """-1, 0, 1: the suffix of ``text`` against the first ``length`` symbols of the test suffix."""
    out = np.zeros(len(at), np.int8)
    live = np.arange(len(at))
    for d in range(int(length.max(initial=0))):
        live = live[length[live] > d]
        if not len(live):
            break
        place = at[live] + d
        inside = place < len(text)
        a = np.where(inside, text[np.minimum(place, len(text) - 1)], 0)
        b = test[start[live] + d]
        out[live] = np.where(~inside | (a < b), -1, np.where(a > b, 1, 0))
        live = live[out[live] == 0]
    return out


def search(
    text: np.ndarray, order: np.ndarray, test: np.ndarray, start: np.ndarray, length: np.ndarray, least: np.ndarray | None = None, most: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """For each test suffix the range of the suffix array that begins with its first ``length`` symbols, looked for from ``least`` to ``most``."""
    bounds = []
    for upper in (False, True):
        low = np.zeros(len(start), np.int64) if least is None else least.copy()
        high = np.full(len(start), len(order), np.int64) if most is None else most.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            sign = _compare(text, order[middle], test, start[open_], length[open_])
            right = sign <= 0 if upper else sign < 0
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
        bounds.append(low)
    return bounds[0], bounds[1]


def matches_in(words: np.ndarray, first: np.ndarray, test: TestSuffixes, seeds: dict[int, np.ndarray]) -> tuple[np.ndarray, ...]:
    """(row, word place in the row, window length, item, words that agree from there on) of every occurrence of a window."""
    doc_end = np.repeat(first[1:], np.diff(first))
    seen: dict[int, np.ndarray] = {}
    rows: list[np.ndarray] = []
    for k, known in seeds.items():
        found = grams(words, k)
        hit = np.flatnonzero(member(found, known))
        hit = hit[hit + k <= doc_end[hit]]
        seen[k] = np.unique(found[hit])
        rows.append(np.searchsorted(first, hit, side="right") - 1)
    wanted = np.unique(np.concatenate(rows)) if rows else np.zeros(0, np.int64)
    none = np.zeros(0, np.int64)
    if not len(wanted):
        return none, none, none, none, none
    sizes = first[wanted + 1] - first[wanted]
    # a symbol that no word has ends each document
    new_first = np.concatenate([[0], np.cumsum(sizes + 1)])
    shard = np.zeros(int(new_first[-1]), U64)
    shard[ranges(new_first[:-1], sizes)] = words[ranges(first[wanted], sizes)]
    order = suffix_array(shard, int(test.lengths.max()))
    ask = np.zeros(len(test.starts), bool)
    for k, present in seen.items():
        mine = np.flatnonzero(test.lengths == k)
        ask[mine] = member(grams(test.symbols, k)[test.starts[mine]], present)
    ask = np.flatnonzero(ask)
    start, length = test.starts[ask], test.lengths[ask]
    low, high = search(shard, order, test.symbols, start, length)
    which = np.repeat(np.arange(len(ask)), high - low)
    place = order[ranges(low, high - low)]
    local = np.searchsorted(new_first, place, side="right") - 1
    # neighbouring windows of one item that follow each other are one longer match
    item = test.owner[ask][which]
    key = np.lexsort((place, place - start[which], item))
    place, which, item, local = place[key], which[key], item[key], local[key]
    diagonal = place - start[which]
    new_run = np.ones(len(place), bool)
    new_run[1:] = (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (place[1:] != place[:-1] + 1)
    run = np.cumsum(new_run) - 1
    last = np.flatnonzero(np.append(new_run[1:], True))
    agree = place[last][run] - place + length[which] if len(place) else none
    return wanted[local], place - new_first[local], length[which], item, agree


MATCH = T.StructType([T.StructField(n, t) for n, t in (("item_id", T.StringType()), ("word", T.LongType()), ("length", T.LongType()))])
RANGE = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_MATCHES = pa.list_(pa.struct([("item_id", pa.string()), ("word", pa.int64()), ("length", pa.int64())]))
_RANGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _benchmark_blocks(benchmark: DataFrame, id_column: str, text_column: str, limit: int) -> Iterator[list[tuple[str, str]]]:
    """Items in parts of about ``limit`` bytes of text each (a longer item stands alone), one after the other."""
    size = F.coalesce(F.octet_length(text_column), F.lit(0))
    total = benchmark.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    n = max(1, -(-int(total) // limit))
    rows = benchmark.select(F.col(id_column).cast("string").alias("i"), F.col(text_column).alias("t")).where("t is not null")
    part = F.pmod(F.xxhash64("i", "t"), F.lit(n))
    for k in range(n):
        yield [(r.i, r.t) for r in rows.where(part == k).toLocalIterator()]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_id: str = "item_id", item_text: str = "text", limit: int = BENCHMARK_BLOCK_BYTES
) -> DataFrame:
    """All columns of ``docs`` and ``n_words``, ``hit_ranges``, ``matches`` (item, first word, words; the longest per item).

    The benchmark is broadcast in blocks of at most ``limit`` bytes, which the same pass
    over the documents takes in turn. No shuffle. NULL texts have no words; items without
    words match nothing; repeated items and rows are each their own; own columns of the
    three names are replaced; an empty benchmark or table gives no matches.
    """
    spark = docs.sparkSession
    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_ranges", T.ArrayType(RANGE)),
        T.StructField("matches", T.ArrayType(MATCH)),
    ]
    out = docs.drop("n_words", "hit_ranges", "matches")
    for number, rows in enumerate(_benchmark_blocks(benchmark, item_id, item_text, limit)):
        shared = spark.sparkContext.broadcast(rows)
        out = add_columns(out, _matcher(shared, text_column, number > 0), fields)
    return out


def _matcher(shared, text_column: str, again: bool):
    prepared: dict[str, tuple] = {}

    def build(batch: pa.RecordBatch) -> list:
        if "test" not in prepared:
            test = TestSuffixes.of(shared.value)
            prepared["test"] = (test, test.seeds())
        test, seeds = prepared["test"]
        data, offsets = text_buffer(batch.column(text_column))
        n = batch.num_rows
        counts = np.zeros(n, np.int64)
        hits: list[list] = batch.column("hit_ranges").to_pylist() if again else [[] for _ in range(n)]
        found: list[list] = batch.column("matches").to_pylist() if again else [[] for _ in range(n)]
        for low, _, part, part_offsets in blocks(data, offsets):
            words, first = words_of(part, part_offsets)
            counts[low : low + len(first) - 1] = np.diff(first)
            row, place, length, item, agree = matches_in(words, first, test, seeds)
            for r in np.unique(row).tolist():
                mine = row == r
                hits[low + r] = _union(hits[low + r], place[mine], length[mine])
                best: dict[int, tuple[int, int]] = {}
                for i, p, a in sorted(zip(item[mine].tolist(), place[mine].tolist(), agree[mine].tolist())):
                    if a > best.get(i, (0, 0))[1]:
                        best[i] = (p, a)
                found[low + r] = found[low + r] + [{"item_id": test.items[i], "word": p, "length": a} for i, (p, a) in best.items()]
        return [pa.array(counts), pa.array(hits, _RANGES), pa.array(found, _MATCHES)]

    return build


def _union(known: list[dict], place: np.ndarray, length: np.ndarray) -> list[dict]:
    pieces = sorted([(k["start"], k["end"]) for k in known] + list(zip(place.tolist(), (place + length).tolist())))
    out: list[list[int]] = []
    for start, end in pieces:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [{"start": a, "end": b} for a, b in out]


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """The documents, same columns, that hold no window of any item."""
    return find_contamination(docs, benchmark, **names).where(F.size("matches") == 0).select(docs.columns)


def op1_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Per document: words, hit words, items; ``longest`` is the longest verbatim match in words."""
    from tidemark.llm.tables import table

    found = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")).drop("text")

    def build(batch: pa.RecordBatch) -> list:
        items = [sorted({m["item_id"] for m in r}) for r in batch.column("matches").to_pylist()]
        return [pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items], pa.string()), pa.array([len(i) for i in items], pa.int64())]

    digest = add_columns(found, build, [T.StructField("items_sha256", T.StringType()), T.StructField("n_items", T.LongType())])
    n_hit = F.aggregate("hit_ranges", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"])
    longest = F.coalesce(F.array_max(F.transform("matches", lambda m: m["length"])), F.lit(0).cast("long"))
    return digest.select("doc_id", "n_words", n_hit.alias("n_hit"), "n_items", "items_sha256", (n_hit > 0).alias("contaminated"), longest.alias("longest"))
