"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples stand in an inverted index whose postings are cut into blocks of examples, with
the largest weight of a term in each block. A document's blocks are visited by falling
upper bound until no block can change its nearest neighbours. Their votes, weighted by
cosine and by how often their class was sampled, give the score and its evidence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import U64, Finder, add_columns, blocks, byte_class, lower_ascii, mix, ranges, release, released, span_hashes, spans, text_buffer
from tidemark.llm.tables import cut, table

PREFIXES = (4, 5, 6)
LEVELS = (2, 4, 8)
FOLDS = 5
# Examples stand in GROUPS groups of like ones. Terms that 1 / HEAD_SHARE of a group have, at most HEAD_TERMS, stand in its
# dense matrix; ROWS documents are multiplied at a time, those with fewer than FEW such terms one by one.
GROUPS, GROUP_SIZE, GROUP_TERMS, GROUP_ROUNDS = 8, 64, 512, 4
HEAD_TERMS, HEAD_SHARE, ROWS, FEW = 3072, 12, 256, 64
TOGETHER = 16  # documents whose lists are summed together
LONG = 512  # lists of so many examples are read by block
TEXT_BYTES = 1_000_000  # text whose terms are found at a time beside the index
ROUNDING = 1e-5  # more than single precision loses in a cosine

_IN_WORD = byte_class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


@dataclass(frozen=True)
class ToxicityParams:
    """Bounds of the fit: examples per class and the size of a block; ``neighbours`` vote."""

    examples_per_class: int = 4000
    block: int = 256
    neighbours: int = 15
    prior_weight: float = 0.5


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, term) of every occurrence: lower-cased words, and their first 4, 5 and 6 bytes if they have more."""
    lowered = lower_ascii(data)
    starts, ends, first = spans(lowered, offsets, _IN_WORD)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    rows, terms = [row], [span_hashes(lowered, starts, ends)]
    for k in PREFIXES:
        longer = np.flatnonzero(ends - starts > k)
        value = np.zeros(len(longer), U64)
        for i in range(k):
            value = (value << U64(8)) | lowered[starts[longer] + i].astype(U64)
        rows.append(row[longer])
        terms.append(mix(value + U64(k << 56)))
    return np.concatenate(rows), np.concatenate(terms)


def _leveled(row: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term) with counts and the plain term, and for each term a term of its own per level that its count reaches.

    A cosine forgets how often a lone term occurs; the levels keep it.
    """
    row, term, count = _counted(row, term)
    rows, terms, plain = [row], [term], [term]
    for level in LEVELS:
        often = count >= level
        rows.append(row[often])
        plain.append(term[often])
        terms.append(mix(term[often] + U64(level)))
    return np.concatenate(rows), np.concatenate(terms), np.concatenate([count] + [np.ones(len(r), np.int64) for r in rows[1:]]), np.concatenate(plain)


def _counted(row: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term) and how often each occurs, ordered."""
    if not len(row):
        return row, term, np.zeros(0, np.int64)
    order = np.argsort(term)
    narrow = row[order].astype(np.int16) if row.max() < 1 << 15 else row[order]
    order = order[np.argsort(narrow, kind="stable")]
    row, term = row[order], term[order]
    start = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (term[1:] != term[:-1])))
    return row[start], term[start], np.diff(np.append(start, len(row)))


INVERTED = {"finders", "groups", "place_of", "slot_of", "asked", "dense_term", "dense_code", "dense_first", "rank", "amount", "scale", "unit", "cell_of", "run_of", "run_code", "runs", "postings", "place", "block_max", "long_norm"}
WEIGHED = 256  # examples weighed at a time, which bounds what this takes
CODED = 1_000_000  # values coded at a time


def _pack(values: np.ndarray, differences: bool = True) -> tuple[str, bytes]:
    """The values, or their differences, byte by byte in a zstandard frame."""
    kept = np.diff(values, prepend=values.dtype.type(0)) if differences else values
    return values.dtype.str + "-+"[differences], zstandard.compress(np.ascontiguousarray(kept).view(np.uint8).reshape(len(kept), -1).T.tobytes() if len(kept) else b"")


def _unpack(packed: tuple[str, bytes]) -> np.ndarray:
    kind, data = np.dtype(packed[0][:-1]), np.frombuffer(zstandard.decompress(packed[1]), np.uint8)
    values = np.ascontiguousarray(data.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)
    return np.cumsum(values, dtype=kind) if packed[0][-1] == "+" else values


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ordered, and the place of each value among them in as few bytes as hold it; part by part, so that little stands beside the result."""
    parts = range(0, len(values), CODED)
    distinct = np.unique(np.concatenate([values[:0], *(np.unique(values[low : low + CODED]) for low in parts)]))
    code = np.empty(len(values), np.uint16 if len(distinct) <= 1 << 16 else np.uint32)
    for low in parts:
        code[low : low + CODED] = np.searchsorted(distinct, values[low : low + CODED])
    return distinct, code


class Runs:
    """Numbers of 0 to ``most`` in a run per row; ``take`` copies the runs of any rows, whole, into one array."""

    def __init__(self, first: np.ndarray, numbers: np.ndarray, most: int):
        numbers = numbers.astype(np.min_scalar_type(most))
        self.kind, self.runs = numbers.dtype, pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first) - 1, [None, pa.py_buffer(first.astype(np.int64) * numbers.itemsize), pa.py_buffer(numbers)])

    def take(self, rows: np.ndarray) -> np.ndarray:
        _, edges, data = self.runs.take(pa.array(rows, pa.int64())).buffers()
        size = int(np.frombuffer(edges, np.int64)[len(rows)]) // self.kind.itemsize if len(rows) else 0
        return np.frombuffer(data, self.kind, size) if size else np.zeros(0, self.kind)


@dataclass
class Index:
    """Example vectors by term and block; ``zero`` is the smoothed share of toxic examples without any term."""

    vocabulary: np.ndarray
    plain: np.ndarray
    idf: np.ndarray
    params: ToxicityParams
    ids: list = field(default_factory=list)
    toxic: np.ndarray | None = None
    weight: np.ndarray | None = None
    base: float = 0.0
    zero: float = 0.0
    counts: np.ndarray | None = None

    def __getstate__(self) -> dict:
        """Small, for broadcasts: without what the vectors give again, numbers as packed differences."""
        if "packed" in self.__dict__:
            return self.packed
        state = {k: v for k, v in self.__dict__.items() if k not in INVERTED}
        state["plain"] = _pack(np.searchsorted(self.vocabulary, self.plain))
        state["vocabulary"], state["idf"] = _pack(self.vocabulary), _pack(self.idf.view(np.int64), False)
        if self.counts is not None:
            distinct, code = _coded(self.counts)
            state["term"], state["counts"] = _pack(self.term), (_pack(distinct), _pack(code, False))
            state.pop("given", None)
        return state

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.packed = state
        self.vocabulary, self.idf = _unpack(self.vocabulary), _unpack(self.idf).view(np.float64)
        self.plain = self.vocabulary[_unpack(self.plain)]
        if self.counts is not None:
            self.term, (self.distinct, self.code), self.counts = _unpack(self.term), map(_unpack, self.counts), None

    @property
    def entry(self) -> np.ndarray:
        """The weights in the example vectors."""
        if "code" not in self.__dict__:
            return self.given
        sizes = np.diff(self.first)
        return self.weigh(np.repeat(np.arange(len(sizes)), sizes), self.term, self.distinct[self.code], len(sizes))

    def finder(self) -> Finder:
        """Of ``plain``, made once in each process."""
        held = self.__dict__.setdefault("finders", {})
        if "plain" not in held:
            held["plain"] = Finder(self.plain)
        return held["plain"]

    def levels(self) -> list[np.ndarray]:
        """For each of ``plain`` its number as a term, and that of its term of each level; -1 for none."""
        held = self.__dict__.setdefault("finders", {})
        if "levels" not in held:
            find = Finder(self.vocabulary).find  # of no use after this
            held["levels"] = [find(t).astype(np.int32) for t in (self.plain, *(mix(self.plain + U64(level)) for level in LEVELS))]
        return held["levels"]

    def occurrences(self, column: pa.Array) -> Iterator[tuple]:
        """(first row, end row, first entry of each row, row, term number, count) by block: the known terms of each text and their levels.

        Terms are found and sorted as plain ones. The entries of a row are in an order that only its text decides.
        """
        finder, levels = self.finder(), self.levels()
        bits = len(self.plain).bit_length()
        data, offsets = text_buffer(column)
        for low, high, part, part_offsets in blocks(data, offsets, TEXT_BYTES):
            row, term = terms_of(part, part_offsets)
            place = finder.find(term)
            keep = np.flatnonzero(place >= 0)
            key = np.sort(row[keep] << bits | place[keep])
            del row, term, place, keep
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            count = np.diff(np.append(start, len(key)))
            row, place = key[start] >> bits, key[start] & ((1 << bits) - 1)
            rows, numbers, counts = [row], [levels[0][place]], [count]
            for level, number in zip(LEVELS, levels[1:]):
                often = np.flatnonzero(count >= level)
                often = often[number[place[often]] >= 0]
                rows.append(row[often])
                numbers.append(number[place[often]])
                counts.append(np.ones(len(often), np.int64))
            row, number, count = (np.concatenate(x) for x in (rows, numbers, counts))
            narrow = row.astype(np.int16) if high - low < 1 << 15 else row
            order = np.argsort(narrow, kind="stable")
            row, number, count = row[order], number[order], count[order]
            yield low, high, np.searchsorted(row, np.arange(high - low + 1)), row, number, count

    def weigh(self, row: np.ndarray, number: np.ndarray, count: np.ndarray, rows: int) -> np.ndarray:
        """TF-IDF weights of rows of length 1."""
        weight = (1 + np.log(count)) * self.idf[number]
        return weight / np.sqrt(np.bincount(row, weight**2, minlength=rows))[row]

    def build(self, ids: list, toxic: np.ndarray, weight: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], base: float) -> Index:
        full = [i for i in range(len(ids)) if len(vectors[i][0])]
        bare = [i for i in range(len(ids)) if not len(vectors[i][0])]
        m = self.params.prior_weight
        self.base = base
        bare_weight = weight[bare].sum() if bare else 0.0
        self.zero = float((weight[bare][toxic[bare] > 0].sum() + m * base) / (bare_weight + m)) if bare else base
        # examples with the same heaviest term share blocks, which keeps the bounds tight
        full.sort(key=lambda i: (int(vectors[i][0][np.argmax(vectors[i][1])]), i))
        self.order, self.ids = full, [ids[i] for i in full]
        self.toxic, self.weight = toxic[full], weight[full]
        number = np.concatenate([vectors[i][0] for i in full]) if full else np.zeros(0, np.int64)
        value = np.concatenate([vectors[i][1] for i in full]) if full else np.zeros(0)
        example = np.repeat(np.arange(len(full)), [len(vectors[i][0]) for i in full])
        self.first = np.searchsorted(example, np.arange(len(full) + 1))
        self.term, self.given = number.astype(np.int32), value
        return self

    def invert(self) -> None:
        """Makes the index of the vectors, once in each process.

        An entry's weight is its amount, one of few and kept by number, times the scale of its term and the unit of its example.
        """
        n, terms, counted = len(self.ids), len(self.vocabulary), True
        if "code" in self.__dict__:
            distinct, code = self.__dict__.pop("distinct"), self.__dict__.pop("code")
        elif self.counts is not None:
            distinct, code = _coded(self.counts)
        else:
            (distinct, code), counted = _coded(self.given), False
        self.amount = 1 + np.log(distinct) if counted else distinct
        # inside, terms are numbered from the most frequent one on, so that what most texts ask for lies together
        first, held = self.first, np.zeros(terms, np.int64)
        for _, _, part in self._stretches(first):
            held += np.bincount(self.term[part], minlength=terms)
        by = np.argsort(-held, kind="stable")
        self.rank = np.empty(terms, np.int32)
        self.rank[by] = np.arange(terms)
        number = np.empty(len(self.term), np.int32)
        for _, _, part in self._stretches(first):
            number[part] = self.rank[self.term[part]]
        if "packed" in self.__dict__:  # which has them for the next process
            del self.term, self.first
        self.scale, self.unit = self.idf[by] if counted else np.ones(terms), np.ones(n)
        if counted:
            for low, high, part in self._stretches(first):
                squares = np.bincount(np.repeat(np.arange(high - low), np.diff(first[low : high + 1])), (self.amount[code[part]] * self.scale[number[part]]) ** 2, minlength=high - low)
                self.unit[low:high] = 1 / np.sqrt(squares)
        # inside, examples stand by group; ``place_of`` leads back
        group = self._grouped(number, code, first)
        self.place_of = np.argsort(group, kind="stable")
        edges = np.searchsorted(group[self.place_of], np.arange(group.max(initial=-1) + 2))
        runs, sizes = [slice(first[i], first[i + 1]) for i in self.place_of.tolist()], np.diff(first)[self.place_of]
        number = np.concatenate([number[run] for run in runs] or [number])
        code = np.concatenate([code[run] for run in runs] or [code])
        self.unit, first = self.unit[self.place_of], np.append(0, np.cumsum(sizes))
        narrow = np.int16 if n < 1 << 15 else np.int32
        example = np.repeat(np.arange(n, dtype=narrow), sizes)
        # single precision for the product, and the weights as they are for the few examples that are near
        dense, self.groups = np.zeros(len(number), bool), []
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
            held = np.zeros(terms, np.int64)
            for _, _, part in self._stretches(first, low, high):
                held += np.bincount(number[part], minlength=terms)
            often = np.argsort(-held, kind="stable")[:HEAD_TERMS]
            often = np.sort(often[held[often] * HEAD_SHARE >= high - low])
            slot = np.full(terms, -1, np.int16)
            slot[often] = np.arange(len(often))
            head = np.zeros((len(often), high - low), np.float32)
            for _, _, part in self._stretches(first, low, high):
                place = slot[number[part]]
                at = np.flatnonzero(place >= 0)
                dense[part][at] = True
                head[place[at], example[part][at] - low] = self._weights(number[part][at], code[part][at], example[part][at])
            self.groups.append((low, high, slot, head))
        slots = np.flatnonzero(np.max([slot for _, _, slot, _ in self.groups], axis=0, initial=-1) >= 0) if self.groups else np.zeros(0, np.int64)
        self.slot_of = np.full(terms, -1, np.int32)
        self.slot_of[slots] = np.arange(len(slots))
        self.asked = np.zeros(len(slots))
        self.dense_first = np.append(0, np.cumsum([np.count_nonzero(dense[low:high]) for low, high in zip(first[:-1].tolist(), first[1:].tolist())], dtype=np.int64))
        self.dense_term = Runs(self.dense_first, self.slot_of[number[dense]], len(slots))
        self.dense_code = Runs(self.dense_first, code[dense], len(self.amount))
        # the vectors go as soon as they are dealt out: each process must hold all of this
        np.logical_not(dense, out=dense)
        number, code, example = (x[dense] for x in (number, code, example))
        del dense
        key = self._keys(number, code, example)
        del number, code, example
        self._cut_lists(key)

    def _stretches(self, first: np.ndarray, low: int = 0, high: int | None = None) -> Iterator[tuple[int, int, slice]]:
        """(first example, end example, their entries) of WEIGHED examples at a time."""
        high = len(first) - 1 if high is None else high
        for at in range(low, high, WEIGHED):
            end = min(at + WEIGHED, high)
            yield at, end, slice(first[at], first[end])

    def _weights(self, number: np.ndarray, code: np.ndarray, example: np.ndarray) -> np.ndarray:
        return self.amount[code] * self.scale[number] * self.unit[example]

    def _keys(self, number: np.ndarray, code: np.ndarray, example: np.ndarray) -> np.ndarray:
        """Cell, amount and example of each posting in one number, ordered.

        A list of LONG examples or more is cut into cells, one per block of examples; a shorter one is a cell.
        """
        n, block, terms = len(self.ids), self.params.block, len(self.vocabulary)
        long_ = np.flatnonzero(np.bincount(number, minlength=terms) >= LONG)
        self.place = np.full(terms, -1, np.int32)
        self.place[long_] = np.arange(len(long_))
        many = np.ones(terms, np.int64)
        many[long_] = -(-n // block)
        self.cell_of = np.append(0, np.cumsum(many))
        amounts, examples = max(1, len(self.amount)), n.bit_length()
        if (int(self.cell_of[-1]) * amounts) << examples >= 1 << 63:
            raise OverflowError("too many terms, amounts and examples for one number")
        key = self.cell_of[number]
        for part in (slice(low, low + CODED) for low in range(0, len(key), CODED)):
            at = np.flatnonzero(self.place[number[part]] >= 0)
            key[part][at] += example[part][at] // block
        key *= amounts
        key += code
        key <<= examples
        key |= example
        key.sort()
        return key

    def _cut_lists(self, key: np.ndarray) -> None:
        """A cell's postings are a run of examples per amount, so that amounts are told once a run; cells of long lists have their largest weight."""
        n, turns, amounts, examples = len(self.ids), -(-len(self.ids) // self.params.block), max(1, len(self.amount)), len(self.ids).bit_length()
        long_ = np.flatnonzero(self.place >= 0)
        example = (key & ((1 << examples) - 1)).astype(np.min_scalar_type(n))
        key >>= examples
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        cell, self.run_code = np.divmod(key[start], amounts)
        self.run_code = self.run_code.astype(np.min_scalar_type(amounts))
        self.run_of = np.searchsorted(cell, np.arange(self.cell_of[-1] + 1))
        self.runs = np.append(start, len(example))
        self.postings = Runs(self.runs, example, n)
        self.block_max, squares = np.zeros((len(long_), turns)), np.zeros(n)
        for place, term in enumerate(long_.tolist()):
            runs = self.run_of[self.cell_of[term] : self.cell_of[term + 1] + 1]
            edges = self.runs[runs[0] : runs[-1] + 1]
            own = example[edges[0] : edges[-1]]
            weight = np.repeat(self.amount[self.run_code[runs[0] : runs[-1]]], np.diff(edges)) * self.scale[term] * self.unit[own]
            begin = self.runs[runs] - edges[0]
            full = np.flatnonzero(np.diff(begin))
            self.block_max[place, full] = np.maximum.reduceat(weight, begin[full])
            squares[own] += weight**2
        self.long_norm = np.sqrt(squares)

    def _grouped(self, number: np.ndarray, code: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A group for each example, by a few rounds of spherical means over frequent terms; any groups give the same results."""
        n = len(self.ids)
        k = max(1, min(GROUPS, n // GROUP_SIZE))
        points = np.zeros((n, min(GROUP_TERMS, len(self.vocabulary))), np.float32)
        for low, high, part in self._stretches(first):
            some, example = np.flatnonzero(number[part] < GROUP_TERMS), np.repeat(np.arange(low, high), np.diff(first[low : high + 1]))
            points[example[some], number[part][some]] = self._weights(number[part][some], code[part][some], example[some])
        points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)
        means, near = points[:1], None
        while len(means) < min(k, n):  # the example least like those so far
            near = points @ means[-1] if near is None else np.maximum(near, points @ means[-1])
            means = np.concatenate([means, points[np.argmin(near)][None]])
        for _ in range(GROUP_ROUNDS):
            group = np.argmax(points @ means.T, axis=1) if n else np.zeros(0, np.int64)
            means = np.stack([points[group == g].sum(axis=0) for g in range(len(means))]) if n else means
            means /= np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-9)
        return np.unique(group, return_inverse=True)[1]

    def nearest(self, number: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The examples of largest cosine above 0 and these cosines; ties go to the earlier example."""
        return next(self.nearest_rows(np.array([0, len(number)]), number, weight))

    def nearest_rows(self, first: np.ndarray, number: np.ndarray, weight: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of each row of entries; the dense part is one matrix product for many rows."""
        if "groups" not in self.__dict__:
            release()
            self.invert()
            release()
        for low in range(0, len(first) - 1, ROWS):
            edges = first[low : low + ROWS + 1]
            part, heavy = self.rank[number[edges[0] : edges[-1]]], weight[edges[0] : edges[-1]]
            bounds = (edges - edges[0]).tolist()
            scores = self._dense_scores(part, heavy, bounds)
            for at in range(0, len(scores), TOGETHER):
                own = bounds[at : at + TOGETHER + 1]
                yield from self._nearest_of(scores[at : at + TOGETHER], part[own[0] : own[-1]], heavy[own[0] : own[-1]], [b - own[0] for b in own])

    def _nearest_of(self, score: np.ndarray, number: np.ndarray, weight: np.ndarray, bounds: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The nearest of a few rows; ``score`` holds their dense parts."""
        row, near, cosine = self._candidates(score, np.repeat(np.arange(len(score)), np.diff(bounds)), number, weight)
        first = np.searchsorted(row, np.arange(len(score) + 1)).tolist()
        size = self.dense_first[near + 1] - self.dense_first[near]
        term, value = self.dense_term.take(near), self.amount.take(self.dense_code.take(near))
        slot, scaled = self.slot_of[number], weight * self.scale[number]
        at = np.append(0, np.cumsum(size))
        for a, b, low, high in zip(bounds[:-1], bounds[1:], at[first[:-1]].tolist(), at[first[1:]].tolist()):
            own = slot[a:b][kept := slot[a:b] >= 0]
            self.asked[own] = scaled[a:b][kept]
            value[low:high] *= self.asked.take(term[low:high])
            self.asked[own] = 0.0
        full = np.flatnonzero(size)
        if len(full):
            cosine[full] += np.add.reduceat(value, at[full])
        cosine *= self.unit[near]
        near = self.place_of[near]
        rounded = -np.round(cosine, 9)
        for low, high in zip(first[:-1], first[1:]):
            order = np.lexsort((near[low:high], rounded[low:high]))[: self.params.neighbours] + low
            yield near[order], np.minimum(cosine[order], 1.0)

    def _dense_scores(self, number: np.ndarray, weight: np.ndarray, bounds: list[int]) -> np.ndarray:
        """What the dense terms of each group give each row of entries, in single precision."""
        rows = len(bounds) - 1
        row, weight = np.repeat(np.arange(rows), np.diff(bounds)), weight.astype(np.float32)
        scores = np.zeros((rows, len(self.ids)), np.float32)
        for low, high, slot, head in self.groups:
            place = slot[number]
            at = np.flatnonzero(place >= 0)
            first = np.searchsorted(at, bounds)
            held = np.diff(first)
            many = np.flatnonzero(held >= FEW)
            if len(many):
                asked = np.zeros((rows, len(head)), np.float32)
                asked[row[at], place[at]] = weight[at]
                scores[many, low:high] = asked[many] @ head
            for r in np.flatnonzero((held > 0) & (held < FEW)).tolist():
                own = at[first[r] : first[r + 1]]
                scores[r, low:high] = weight[own] @ head[place[own]]
        return scores

    def _candidates(self, score: np.ndarray, row: np.ndarray, number: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, example, what the lists give before its unit) of the examples that may be among a row's nearest; ``score`` holds the dense parts.

        Short lists are summed up. What long ones can add to an example is bounded by the
        maxima of its block and by the lengths of both vectors there; their blocks are
        read only where that bound reaches the nearest so far.
        """
        k, block, (rows, n) = self.params.neighbours, self.params.block, score.shape
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        place = self.place[number]
        short, long_ = np.flatnonzero(place < 0), np.flatnonzero(place >= 0)
        scaled, cell = weight * self.scale[number], self.cell_of[number]
        total = self._sum(row[short], cell[short], scaled[short], score.shape)
        least = lambda whole: np.partition(whole, n - k, axis=1)[:, n - k, None] - 2 * ROUNDING if n > k else 0.0
        if len(long_):
            row, place, weight, scaled, cell = row[long_], place[long_], weight[long_], scaled[long_], cell[long_]
            first = np.searchsorted(row, np.arange(rows + 1)).tolist()
            most = np.stack([weight[a:b] @ self.block_max[place[a:b]] for a, b in zip(first[:-1], first[1:])])
            length = np.sqrt(np.bincount(row, weight**2, minlength=rows))
            most = np.minimum(np.repeat(most, block, axis=1)[:, :n], length[:, None] * self.long_norm)
            whole = total * self.unit + score
            most = np.maximum.reduceat(whole + most, np.arange(0, n, block), axis=1)
            # what is known so far is the least that the nearest have
            at, turn = np.nonzero((most >= least(whole))[row])
            total += self._sum(row[at], cell[at] + turn, scaled[at], score.shape)
        # single precision must not hide a tie
        whole = total * self.unit + score
        row, near = np.nonzero((whole > 0) & (whole >= least(whole)))
        return row, near, total[row, near]

    def _sum(self, row: np.ndarray, cell: np.ndarray, weight: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
        """Weighted sum of amounts per row and example of cells of postings."""
        many = self.run_of[cell + 1] - self.run_of[cell]
        run = ranges(self.run_of[cell], many)
        end = np.cumsum(self.runs[run + 1] - self.runs[run])
        if not len(run):
            return np.zeros(shape)
        value = pa.RunEndEncodedArray.from_arrays(pa.array(end), pa.array(np.repeat(weight, many) * self.amount[self.run_code[run]]))
        value, example = pc.run_end_decode(value).to_numpy(), self.postings.take(run)
        edges = np.append(0, end)[np.append(0, np.cumsum(many))[np.searchsorted(row, np.arange(shape[0] + 1))]].tolist()
        return np.stack([np.bincount(example[low:high], value[low:high], minlength=shape[1]) for low, high in zip(edges[:-1], edges[1:])])

    def score(self, near: np.ndarray, cosine: np.ndarray) -> float:
        votes = cosine**2 * self.weight[near]
        # what the vote lacks in closeness goes to documents without any term
        m = self.params.prior_weight * max(0.0, 1 - float(cosine[0]))
        return float((votes[self.toxic[near] > 0].sum() + m * self.zero) / (votes.sum() + m))


def _sample(labels: DataFrame, params: ToxicityParams) -> tuple[dict, dict[int, int]]:
    """(id -> label) of at most ``examples_per_class`` ids per class, the lowest by a hash, and the size of each class."""
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max(F.col("label").cast("int")).alias("label"))
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = {}
    for label in sizes:
        rows = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.examples_per_class)
        chosen |= {r.doc_id: r.label for r in rows.collect()}
    return chosen, sizes


def _pairs(batch: pa.RecordBatch, text_column: str) -> Iterator[tuple]:
    """(first row, end row, row, term, count, plain term) by block."""
    data, offsets = text_buffer(batch.column(text_column))
    for low, high, part, part_offsets in blocks(data, offsets):
        row, term = terms_of(part, part_offsets)
        yield low, high, *_leveled(row, term)


def fit_toxicity(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> Index:
    """The index of labelled examples. ``docs`` has doc_id and text, ``labels`` doc_id and label (0 or 1).

    Fitted on a sample bounded by ``params``; how many documents hold a term is counted
    over all documents. Rows with a NULL id or label teach nothing, of differing labels
    of an id the larger counts. Without examples of both classes every score is the share
    of toxic labels (0 without labels).
    """
    spark = docs.sparkSession
    chosen, sizes = _sample(labels, params)
    total = sum(sizes.values())
    base = sizes.get(1, 0) / total if total else 0.0
    if not sizes.get(1) or not sizes.get(0):
        return Index(np.zeros(0, U64), np.zeros(0, U64), np.zeros(0), params).build([], np.zeros(0, int), np.zeros(0), [], base)
    shared = spark.sparkContext.broadcast(chosen)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = [shared.value.get(i, -1) for i in batch.column("doc_id").to_pylist()]
            label = pa.array(known, pa.int32())
            mask = pa.array([k >= 0 for k in known])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), label], ["doc_id", "text", "label"]).filter(mask)

    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("text", T.StringType()), T.StructField("label", T.IntegerType())])
    # repeated rows are one example; ids of several texts must not exceed the bound either
    examples = docs.select("doc_id", "text").mapInArrow(released(choose), schema).groupBy("doc_id", "text", "label").agg(F.count("*").alias("copies")).drop("copies")
    examples = cut(examples, "toxicity-examples")
    if examples.groupBy("label").count().where(F.col("count") > params.examples_per_class).count():
        named = examples.withColumn("hash", F.sha2(F.coalesce("text", F.lit("")), 256))
        lowest = [named.where(F.col("label") == label).select("doc_id", "hash").orderBy(F.xxhash64("doc_id"), "doc_id", "hash").limit(params.examples_per_class) for label in (0, 1)]
        kept = F.broadcast(lowest[0].union(lowest[1]))
        examples = cut(named.join(kept, ["doc_id", "hash"], "left_semi").drop("hash"), "toxicity-examples-bounded")

    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.asarray(batch.column("label"))
            for low, _, row, term, _, plain in _pairs(batch, "text"):
                values, first, inverse = np.unique(term, return_index=True, return_inverse=True)
                toxic = np.bincount(inverse, label[low + row], minlength=len(values)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), pa.array(plain[first].view(np.int64)), pa.array(toxic), pa.array(np.bincount(inverse, minlength=len(values)) - toxic)],
                    ["term", "plain", "toxic", "clean"],
                )

    taught = examples.select("text", "label").mapInArrow(released(count_terms), "term long, plain long, toxic long, clean long").groupBy("term", "plain").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    taught = taught.toArrow()
    terms = taught.column("term").to_numpy().view(U64)
    vocabulary, at = np.unique(terms, return_index=True)
    plain = np.unique(taught.column("plain").to_numpy().view(U64))
    toxic, clean = (taught.column(c).to_numpy()[at] for c in ("toxic", "clean"))
    n1, n0 = (sum(1 for v in chosen.values() if v == label) for label in (1, 0))
    del taught, terms
    held = spark.sparkContext.broadcast(Index(vocabulary, plain, np.ones(len(vocabulary)), params))
    index = Index(vocabulary, plain, _idf(docs, held) * telling(toxic, clean, n1, n0), params)

    def number_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, first, _, number, count in held.value.occurrences(batch.column("text")):
                first = pa.array(first, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        batch.column("label").slice(low, high - low),
                        pa.ListArray.from_arrays(first, pa.array(number, pa.int32())),
                        pa.ListArray.from_arrays(first, pa.array(count, pa.int32())),
                    ],
                    ["doc_id", "label", "number", "count"],
                )

    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("label", T.IntegerType()), T.StructField("number", T.ArrayType(T.IntegerType())), T.StructField("count", T.ArrayType(T.IntegerType()))])
    rows = examples.mapInArrow(released(number_terms), schema).toArrow()
    held.destroy()
    ids, toxic = rows.column("doc_id").to_pylist(), np.asarray(rows.column("label"), int)
    numbers, counts = ([v.values.to_numpy() for v in rows.column(c)] for c in ("number", "count"))
    order = sorted(range(len(ids)), key=lambda i: (ids[i], numbers[i].tobytes(), counts[i].tobytes()))
    ids, toxic, numbers, counts = [ids[i] for i in order], toxic[order], [numbers[i] for i in order], [counts[i] for i in order]
    vectors = [(n, index.weigh(np.zeros(len(n), np.int64), n, c, 1)) for n, c in zip(numbers, counts)]
    seen = np.bincount(toxic, minlength=2)
    share = np.array([sizes[0] / max(1, seen[0]), sizes[1] / max(1, seen[1])])
    weight = share[toxic] / share.max() if len(ids) else np.zeros(0)
    index.build(ids, toxic, weight, vectors, base)
    index.counts = np.concatenate([counts[i] for i in index.order]) if index.order else None
    return index


def telling(toxic: np.ndarray, clean: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Per term at least 1, and the more the surer its share among toxic examples differs from that among clean ones.

    No term is left out. This is the root of 1 + G2, the log-likelihood ratio of the counts.
    """
    both = toxic + clean
    total = np.zeros(len(both))
    for seen, rows in ((toxic, n1), (clean, n0)):
        for part, whole in ((seen, both), (rows - seen, n1 + n0 - both)):
            part = np.maximum(part, 0)
            want = np.maximum(whole, 0) * (rows / max(1, n1 + n0))
            total += np.where(part > 0, part * np.log(np.maximum(part, 1) / np.maximum(want, 1e-12)), 0.0)
    return np.sqrt(1 + np.maximum(2 * total, 0.0))


def _idf(docs: DataFrame, shared) -> np.ndarray:
    """log(1 + documents / documents with the term) of a broadcast index's terms, over all documents; one row per term and task is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(len(shared.value.vocabulary), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, _, _, number, _ in shared.value.occurrences(batch.column("text")):
                held += np.bincount(number, minlength=len(held))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(held[some], n))], ["number", "n"])

    counts = docs.select("text").mapInArrow(released(count), "number long, n long").groupBy("number").agg(F.sum("n").alias("n")).toArrow()
    number, n = (counts.column(c).to_numpy() for c in ("number", "n"))
    held = np.zeros(len(shared.value.vocabulary) + 1, np.int64)
    held[number] = n  # the last is the number of documents
    return np.log1p(held[-1] / np.maximum(held[:-1], 1))


EVIDENCE = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("cosine", T.DoubleType()), T.StructField("toxic", T.IntegerType())])
_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.string()), ("cosine", pa.float64()), ("toxic", pa.int32())]))


def score_toxicity(docs: DataFrame, index: Index, text_column: str = "text", evidence: int = 3) -> DataFrame:
    """All columns and ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and ``evidence`` (the nearest examples).

    One pass over whole texts without a shuffle; the index, bounded by its parameters, is
    broadcast. Equal texts get equal scores. NULL, empty texts and texts without a term of
    the index get the share of toxic examples among those without one, and no evidence.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def build(batch: pa.RecordBatch) -> list:
        index = shared.value
        scores, proof = np.full(batch.num_rows, index.zero), [[] for _ in range(batch.num_rows)]
        for low, high, first, row, number, count in index.occurrences(batch.column(text_column)):
            for r, (near, cosine) in enumerate(index.nearest_rows(first, number, index.weigh(row, number, count, high - low))):
                if len(near):
                    scores[low + r] = index.score(near, cosine)
                    proof[low + r] = [{"doc_id": str(index.ids[i]), "cosine": c, "toxic": int(index.toxic[i])} for i, c in zip(near[:evidence].tolist(), cosine[:evidence].tolist())]
        return [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array(proof, _EVIDENCE)]

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("evidence", T.ArrayType(EVIDENCE))]
    return add_columns(docs, build, fields)


def held_out(id_column: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(FOLDS)) == 0, F.lit(False))


def training_labels(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", F.col("toxic").alias("label"))


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """Per document: fold, score and label, with evidence."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = fit_toxicity(docs, training_labels(spark, sf_dir))
    return score_toxicity(docs, index).select("doc_id", held_out().alias("held_out"), "score", "predicted", "evidence")
