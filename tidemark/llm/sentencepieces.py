"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch stand behind each other in one index text. Its suffix array
is binary-searched for every piece, which gives the ranges of its occurrences: the edges
of a lattice. Sorted by position, the edges are relaxed from left to right.

The model is a BPE model. Its segmentation of a text is the one whose neighbouring
pieces agree: a piece may follow another if encoding the two as one text gives these two
again. Exactly one edge that ends at a position does so, and relaxing keeps it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import U64, add_columns, blocks, mix, ranges, released, text_buffer
from tidemark.llm.decontaminate import search
from tidemark.llm.tables import table
from tidemark.llm.units import UnitTable

MODEL = "piece_bpe_32k.model"
CACHED_UNITS = 400_000
PAIR_BITS = 21  # 2**21 places for pairs of pieces looked at before (19 MB)
INDEX_BYTES = 256_000  # of distinct units in one index text; a longer unit stands alone
PIECE_BYTES = 1_000_000  # of text looked at a time, an output batch; a longer text stands alone
BLANK = "▁"
_STOP = 0xFF  # no byte of UTF-8


class PieceModel:
    """Pieces of a BPE model file, with blanks for word marks; identity normalisation and a dummy prefix are required."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        # by the library's reader, which knows more stores than open()
        proto.ParseFromString(SentencePieceProcessor(model_file=path).serialized_model_proto())
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not proto.trainer_spec.byte_fallback:
            raise ValueError("only BPE models with byte fallback, a dummy prefix and no normalisation")
        self.size = len(proto.pieces)
        self.score: dict[str, tuple[float, int]] = {}
        self.bytes_of: list[bytes] = []
        self.byte_id = np.zeros(256, np.int64)
        for number, piece in enumerate(proto.pieces):
            if piece.type == 6:
                value = int(piece.piece[1:-1], 16)
                self.byte_id[value] = number
                self.bytes_of.append(bytes([value]))
            elif piece.type == 1:
                self.bytes_of.append(piece.piece.replace(BLANK, " ").encode())
                self.score[piece.piece.replace(BLANK, " ")] = (piece.score, number)
            else:
                self.bytes_of.append(" ⁇ ".encode() if piece.type == 2 else b"")
        self.ids = np.array([i for _, i in self.score.values()])
        texts = [self.bytes_of[i] for i in self.ids.tolist()]
        self.symbols = np.frombuffer(b"".join(texts), np.uint8)
        self.lengths = np.array([len(t) for t in texts])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.longest = int(self.lengths.max())
        self.barrier = np.ones(256, bool)
        self.barrier[self.symbols] = False
        self.barrier[128:] = False
        # pairs looked at before: a key at the place of its hash, the last one that came there
        self.pairs, self.fits = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)

    def text_of(self, symbol: int) -> str:
        """The text of a piece, or of a character without one (numbered from ``size`` on)."""
        return chr(symbol - self.size) if symbol >= self.size else self.bytes_of[symbol].decode()

    def merge(self, text: str) -> list[str]:
        """BPE of a short text: the best-scored neighbours join first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best = None
            for i in range(len(parts) - 1):
                known = self.score.get(parts[i] + parts[i + 1])
                if known and (best is None or known[0] > best[0]):
                    best = (known[0], i)
            if best is None:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def agree(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether pieces may follow each other; -1 on the left is the start of a unit."""
        keys = (left + 1) * (1 << 32) + right
        place = (mix(keys.astype(U64)) >> U64(64 - PAIR_BITS)).astype(np.int64)
        fits = self.fits[place]
        new = np.flatnonzero(self.pairs[place] != keys)
        if len(new):
            asked, inverse = np.unique(keys[new], return_inverse=True)
            found = np.zeros(len(asked), bool)
            for n, key in enumerate(asked.tolist()):
                a, b = (key >> 32) - 1, key & 0xFFFFFFFF
                want = [self.text_of(x) for x in (a, b) if x >= 0]
                found[n] = self.merge("".join(want)) == want
            fits[new] = found[inverse]
            # keys that share a place: one of them, with its own answer
            place, chosen = np.unique(place[new], return_index=True)
            self.pairs[place], self.fits[place] = keys[new[chosen]], fits[new[chosen]]
        return fits

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units and how many each has, from index texts of bounded size."""
        total, low, ids, sizes = np.cumsum(ends - starts), 0, [], []
        while low < len(starts):
            before = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, before + INDEX_BYTES, side="right")))
            part, size = self.encode_units(data, starts[low:high], ends[low:high])
            ids.append(part.astype(np.int32))
            sizes.append(size)
            low = high
        return (np.concatenate(ids), np.concatenate(sizes)) if ids else (np.zeros(0, np.int32), np.zeros(0, np.int64))

    def encode_units(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units and how many each has."""
        size = ends - starts
        first = np.cumsum(size + 1) - size - 1
        index = np.full(int((size + 1).sum()), _STOP, np.uint8)
        place = ranges(first, size)
        index[place] = data[ranges(starts, size)]
        order = _suffixes(index, self.longest)
        low, high = self._ranges(index, order)
        kind = np.int32 if len(index) < 1 << 31 else np.int64  # edges are many
        at = order.astype(kind)[ranges(low, high - low)]
        symbol = np.repeat(self.ids.astype(np.int32), high - low)
        length = np.repeat(self.lengths.astype(kind), high - low)
        # characters that are no piece are edges of their own
        lead = np.flatnonzero((index & 0xC0) != 0x80)
        lead = lead[index[lead] != _STOP]
        width = np.where(index[lead] < 0x80, 1, np.where(index[lead] < 0xE0, 2, np.where(index[lead] < 0xF0, 3, 4)))
        single = np.zeros(len(index), bool)
        single[at[length == _width_of(index, at)]] = True
        own = ~single[lead]
        lone, lone_width = lead[own], width[own]
        raw = index.tobytes()
        points = [ord(raw[p : p + w].decode()) for p, w in zip(lone.tolist(), lone_width.tolist())]
        at = np.concatenate([at, lone.astype(kind)])
        symbol = np.concatenate([symbol, np.array(points, np.int32) + np.int32(self.size)])
        length = np.concatenate([length, lone_width.astype(kind)])
        # edges by their place inside the unit, all units together; one edge at most is kept for each end, whatever their order
        step = (np.arange(len(index)) - np.repeat(first, size + 1)).astype(kind)[at]
        by_step = np.argsort(step.astype(np.int16) if len(index) < 1 << 15 or size.max(initial=0) < 1 << 15 else step, kind="stable")
        at, symbol, length, step = at[by_step], symbol[by_step], length[by_step], step[by_step]
        last = np.full(len(index) + 1, -1, np.int64)
        cost = np.zeros(len(index) + 1, np.int64)  # width of the kept edge that ends here; 0: none
        reached = np.zeros(len(index) + 1, bool)
        reached[first] = True
        bounds = np.flatnonzero(np.append(True, step[1:] != step[:-1])) if len(step) else np.zeros(0, np.int64)
        for a, b in zip(bounds.tolist(), np.append(bounds[1:], len(step)).tolist()):
            live = np.flatnonzero(reached[at[a:b]]) + a
            fits = live[self.agree(last[at[live]], symbol[live])]
            end = at[fits] + length[fits]
            last[end], cost[end], reached[end] = symbol[fits], length[fits], True
        return self._walk_back(index, first, size, last, cost)

    def _ranges(self, index: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each piece the range of the suffix array that begins with it, searched among the suffixes with its first two bytes."""
        pair = index.astype(np.int64) << 8
        pair[:-1] |= index[1:]
        edges = np.concatenate([[0], np.cumsum(np.bincount(pair, minlength=1 << 16))])
        lead = self.symbols[self.starts].astype(np.int64) << 8
        both = lead | self.symbols[np.minimum(self.starts + 1, len(self.symbols) - 1)]
        one = self.lengths == 1
        low, high = np.where(one, edges[lead], edges[both]), np.where(one, edges[lead + 256], edges[both + 1])
        far = np.flatnonzero((self.lengths > 2) & (low < high))
        low[far], high[far] = search(index, order, self.symbols, self.starts[far], self.lengths[far], low[far], high[far])
        return low, high

    def _walk_back(self, index: np.ndarray, first: np.ndarray, size: np.ndarray, last: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The kept edges from each unit's end to its start, in text order, with bytes for characters without a piece."""
        here, unit = first + size, np.arange(len(first))
        units, places, symbols = [], [], []
        while True:
            open_ = here > first[unit]
            here, unit = here[open_], unit[open_]
            if not len(here):
                break
            if not cost[here].all():
                raise ValueError("a unit has no segmentation")
            units.append(unit)
            symbols.append(last[here])
            here = here - cost[here]
            places.append(here)
        if not units:
            return np.zeros(0, np.int64), np.zeros(len(first), np.int64)
        unit, place, symbol = np.concatenate(units), np.concatenate(places), np.concatenate(symbols)
        order = np.argsort(place, kind="stable")
        unit, place, symbol = unit[order], place[order], symbol[order]
        known = symbol < self.size
        width = np.where(known, 1, _width_of(index, place))
        ids = np.repeat(np.where(known, symbol, -1), width)
        missing = np.flatnonzero(ids < 0)
        ids[missing] = self.byte_id[index[ranges(place[~known], width[~known])]]
        return ids, np.bincount(unit, width, minlength=len(first)).astype(np.int64)

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of units, across which no piece reaches: a run of blanks and what follows it, or bytes in no piece."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        blank, odd = data == 32, self.barrier[data]
        begin = np.zeros(n + 1, bool)
        begin[offsets] = True
        begin = begin[:n]
        begin[1:] |= blank[1:] & ~blank[:-1] | (odd[1:] != odd[:-1])
        starts = np.flatnonzero(begin)
        return starts, np.append(starts[1:], n), np.searchsorted(starts, offsets)


def _suffixes(index: np.ndarray, depth: int) -> np.ndarray:
    """The suffix array of bytes that end with _STOP, by the first ``depth`` bytes at least: sorted by eight, then doubled."""
    n, width = len(index), 8
    wide = np.concatenate([index, np.zeros(width, np.uint8)])
    key = np.zeros(n, U64)
    for i in range(width):
        key = key << U64(8) | wide[i : n + i]
    while True:
        order = np.argsort(key)
        ordered = key[order]
        fresh = np.append(False, ordered[1:] != ordered[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if width >= depth or rank[order[-1]] == n - 1:
            return order
        following = np.zeros(n, np.int64)
        following[: max(0, n - width)] = rank[width:] + 1
        key, width = rank * (n + 1) + following, width * 2


def _width_of(index: np.ndarray, at: np.ndarray) -> np.ndarray:
    lead = index[at]
    return np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))


@lru_cache(maxsize=2)
def _model(path: str) -> tuple[PieceModel, UnitTable]:
    model = PieceModel(path)
    return model, UnitTable(model.encode, np.int32, CACHED_UNITS)


def encode_texts(column: pa.Array, path: str) -> pa.Array:
    """list<int32> of ids per text; NULL and empty texts have none."""
    model, known = _model(path)
    data, offsets = text_buffer(column)
    values, counts = [], []
    for _, _, part, part_offsets in blocks(data, offsets):
        if b"\xe2\x96\x81" in part.tobytes():  # word marks in a text read as blanks
            texts = [part[a:b].tobytes().replace(b"\xe2\x96\x81", b" ") for a, b in zip(part_offsets, part_offsets[1:])]
            part, part_offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        full = np.diff(part_offsets) > 0
        part = np.insert(part, part_offsets[:-1][full], 32)
        part_offsets = part_offsets + np.concatenate([[0], np.cumsum(full)])
        ids, at = known(part, *(u := model.units(part, part_offsets))[:2])
        values.append(ids)
        counts.append(np.diff(at[u[2]]))
    sizes = np.concatenate([[0]] + counts) if counts else np.zeros(1, np.int64)
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(flat, pa.int32()))


def decode_ids(ids: list[int] | None, path: str) -> str:
    """The text of ids: pieces, bytes (ill-formed ones become U+FFFD), no dummy prefix; control ids are empty."""
    pieces = _model(path)[0].bytes_of
    raw = b"".join([pieces[i] for i in ids or []])
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def _small(batch: pa.RecordBatch, text_column: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about PIECE_BYTES of text."""
    _, offsets = text_buffer(batch.column(text_column))
    low = 0
    while low < batch.num_rows:
        high = int(np.searchsorted(offsets, offsets[low] + PIECE_BYTES, side="right")) - 1
        high = min(max(high, low + 1), batch.num_rows)
        yield batch.slice(low, high - low)
        low = high


def encode_pieces(docs: DataFrame, model: str, text_column: str = "text", decoded: bool = False) -> DataFrame:
    """All columns, ``ids`` (array of int, empty for NULL and empty texts) and ``n_tokens``; on demand the ids' text as ``decoded``.

    One pass over whole texts without a shuffle, in one Python worker per task, which holds
    the model, bounded tables of words and pairs of pieces, and a few MB of text. Words are
    encoded once per block of about 2 MB, or not at all if they stand in the table. Own
    columns of these names are replaced.
    """
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("decoded", T.StringType())] if decoded else []
    names = [f.name for f in fields]
    keep = [c for c in docs.columns if c.lower() not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _small(whole, text_column):
                ids = encode_texts(batch.column(text_column), model)
                new = [ids, ids.value_lengths().cast(pa.int64())] + ([decode_column(ids, model)] if decoded else [])
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + new, keep + names)

    return docs.mapInArrow(released(run), T.StructType([docs.schema[c] for c in keep] + fields))


def decode_column(column: pa.Array, model: str) -> pa.Array:
    if column.null_count:
        column = pa.array([x or [] for x in column.to_pylist()], column.type)
    flat, at = column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
    return pa.array([decode_ids(flat[a:b].tolist(), model) for a, b in zip(at, at[1:])], pa.string())


def decode_pieces(docs: DataFrame, model: str, ids_column: str = "ids") -> DataFrame:
    """All columns and ``decoded``; NULL and empty ids give an empty text."""

    def build(batch: pa.RecordBatch) -> list:
        return [decode_column(batch.column(ids_column), model)]

    return add_columns(docs, build, [T.StructField("decoded", T.StringType())])


def op6_sentencepieces(spark, sf_dir: str) -> DataFrame:
    """Per document: ids, their number, and whether decoding them gives the text again."""
    import public_tokenizers

    model = public_tokenizers.path(MODEL)
    docs = encode_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), model, decoded=True)
    return docs.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same_text"))
