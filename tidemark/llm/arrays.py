"""Byte-level text work on Arrow string columns with numpy, in blocks of bounded size.

A word is a maximal run of bytes of a class, so UTF-8 letters outside ASCII are kept
whole. Hashes are 64 bits, the same in every process.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLOCK_BYTES = 2_000_000
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_MULTIPLIER = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(_MULTIPLIER)
    x = x ^ (x >> U64(29))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(32))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))

_powers = {"n": 0, "up": np.ones(1, U64), "down": np.ones(1, U64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i up to n; the tables grow and are kept."""
    if _powers["n"] < n:
        size = max(n, BLOCK_BYTES)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size + 1, U64(base))
            table[0] = 1
            _powers[key] = np.cumprod(table, dtype=U64)
        _powers["n"] = size
    return _powers["up"][: n + 1], _powers["down"][: n + 1]


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda spare: 0)  # the GNU library's; others give memory back by themselves


def release() -> None:
    """Gives the system what is free in this process, which Arrow and the C library would keep."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def released(run: Run) -> Run:
    """``run`` for ``mapInArrow``, after which its worker, which stays for the tasks of later stages, keeps no free memory.

    Before it as well: an earlier stage's broadcasts go only when the next task begins.
    """

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from run(batches)
        release()

    return tidy


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets into them; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(data: np.ndarray, offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about ``limit`` bytes; a longer text stands alone."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def byte_class(keep: Callable[[int], bool]) -> np.ndarray:
    return np.array([keep(b) for b in range(256)])


def lower_ascii(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def spans(data: np.ndarray, offsets: np.ndarray, in_class: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of a class inside single texts, and per text the index of its first run (n + 1 values)."""
    n = len(data)
    inside = in_class[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_HASH_BYTES = 256_000
_NEAR = 256  # places in a span whose values stand in a table


def _place_values(place: np.ndarray, data: np.ndarray) -> np.ndarray:
    """A value for each pair of a byte and its place, which has no pattern along the places."""
    pair = (place.astype(np.int64) << 8) | data
    far = pair >= len(_PLACES)
    if not far.any():
        return _PLACES[pair]
    values = _PLACES[np.where(far, 0, pair)]
    values[far] = _pair_values(pair[far].astype(U64))
    return values


def _pair_values(pair: np.ndarray) -> np.ndarray:
    return mix((pair + U64(1)) * U64(_BASE))


_PLACES = _pair_values(np.arange(_NEAR << 8, dtype=U64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span, equal for equal bytes wherever they stand.

    It sums a value per byte and place. A polynomial modulo 2**64 would give equal sums to
    certain long words of two letters, whatever its base; here no arrangement is special.
    """
    lengths = ends - starts
    total, sums, low = np.cumsum(lengths), np.zeros(len(starts), U64), 0
    while low < len(starts):
        before = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, before + _HASH_BYTES, side="right")))
        if lengths[low] > _HASH_BYTES:
            word, one = data[starts[low] : ends[low]], 0
            for at in range(0, len(word), _HASH_BYTES):
                part = word[at : at + _HASH_BYTES]
                one += int(_place_values(np.arange(at, at + len(part)), part).sum(dtype=U64))
            sums[low], low = U64(one % (1 << 64)), low + 1
            continue
        begin, size = starts[low:high], lengths[low:high]
        at = ranges(begin, size)
        running = np.zeros(len(at) + 1, U64)
        np.cumsum(_place_values(at - np.repeat(begin, size), data[at]), out=running[1:])
        after = np.cumsum(size)
        sums[low:high] = running[after] - running[after - size]
        low = high
    return mix(sums + lengths.astype(U64) * U64(_MULTIPLIER))


def grams(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` neighbours (len - k + 1 of them, none if there are fewer)."""
    if len(values) < k:
        return np.zeros(0, U64)
    total, width = None, 0
    power, span = values, 1
    rest = k
    while rest:
        if rest & 1:
            if total is None:
                total, width = power, span
            else:
                m = len(values) - width - span + 1
                total = total[:m] * U64(pow(_MULTIPLIER, span, 1 << 64)) + power[width : width + m]
                width += span
        rest >>= 1
        if rest:
            m = len(power) - span
            power = power[:m] * U64(pow(_MULTIPLIER, span, 1 << 64)) + power[span : span + m]
            span *= 2
    return mix(total[: len(values) - k + 1])


def member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array; a bit table turns most of them away."""
    if not len(ordered) or not len(values):
        return np.zeros(len(values), bool)
    table = np.zeros(1 << 20, bool)
    table[(ordered & U64((1 << 20) - 1)).astype(np.int64)] = True
    maybe = np.flatnonzero(table[(values & U64((1 << 20) - 1)).astype(np.int64)])
    at = np.minimum(np.searchsorted(ordered, values[maybe]), len(ordered) - 1)
    out = np.zeros(len(values), bool)
    out[maybe[ordered[at] == values[maybe]]] = True
    return out


class Finder:
    """Places of values in a sorted array of distinct hashes, by their first bits: right for any values, fast where they are spread."""

    SHIFT = U64(44)

    def __init__(self, ordered: np.ndarray):
        self.ordered = np.append(ordered, U64(0))
        self.first = np.zeros((1 << 20) + 1, np.int32)
        self.first[1:] = np.cumsum(np.bincount((ordered >> self.SHIFT).astype(np.int64), minlength=1 << 20))

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value, -1 for none."""
        bucket = (values >> self.SHIFT).astype(np.int64)
        at, end = self.first[bucket], self.first[bucket + 1]
        out = np.full(len(values), -1, np.int64)
        ask = np.flatnonzero(at < end)
        at, end, values = at[ask], end[ask], values[ask]
        while len(ask):
            same = self.ordered[at] == values
            out[ask[same]] = at[same]
            on = np.flatnonzero(~same & (at + 1 < end))
            ask, at, end, values = ask[on], at[on] + 1, end[on], values[on]
        return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, one after the other."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def add_columns(df: DataFrame, build: Callable[[pa.RecordBatch], list], fields: list[T.StructField]) -> DataFrame:
    """All columns of ``df`` and new ones computed per Arrow batch; a column of the same name is replaced."""
    names = [f.name for f in fields]
    keep = [c for c in df.columns if c.lower() not in {n.lower() for n in names}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + build(batch), keep + names)

    return df.mapInArrow(released(run), T.StructType([df.schema[c] for c in keep] + fields))
