"""Secret scan: fixed patterns, and values in credential contexts whose guessing cost is high.

The cost of a value is the cheapest way to spell it, found by dynamic programming over
its positions: each segment is a common word, a date, a repeat, a keyboard or alphabet
walk, or brute force. A value that stays expensive is a secret. Common words are those of
a public vocabulary whose order is their rank; counts of the corpus itself would let the
copies of one secret make it a word.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.arrays import add_columns, blocks, byte_class, spans, text_buffer

KINDS = ("assign", "access", "hex", "guess")

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

# Contexts in which a value counts as a credential.
CONTEXT_WORDS = "password passwd passphrase pass pwd secret token bearer credential credentials authorization apikey api_key api-key accesskey access_key access-key privatekey private_key private-key".split()
CONTEXT = re.compile(
    r"(?<![A-Za-z0-9])(?:" + "|".join(sorted(CONTEXT_WORDS, key=len, reverse=True)) + r""")(?:["']?\x20*[:=]\x20*|\x20+(?=[^\s"':=]*[0-9]))(?:"([^"\n]{6,})"|'([^'\n]{6,})'|([^\s"',;]{6,}))""",
    re.ASCII | re.IGNORECASE,
)
# Found from its "://", so that no run of letters before one is searched from each of its places.
LOGIN = re.compile(r"(?<=[A-Za-z0-9+.-]://)[^\s/:@]+:([^\s/@]{6,})@")
# Bytes of which a text must hold one before its contexts are searched.
HINTS = (b"pass", b"pwd", b"secret", b"token", b"bearer", b"credential", b"authorization", b"api", b"access", b"private", b"://")

# Words that guessers try first, commonest first.
COMMON_WORDS = (
    "password admin welcome login letmein master secret monkey dragon football baseball sunshine princess shadow "
    "superman michael jordan test guest user root default changeme example hello love summer winter spring autumn "
    "pass word token key qwerty abc super computer internet server system account private public company office"
).split()
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SUBSTITUTES = str.maketrans("@4310$57!", "aaeiosstl")
LONGEST_SEGMENT = 64
DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:(?:19|20)\d\d|\d\d)")


VOCABULARY = "word_bpe_49k.json"
LEAST_WORD, MOST_WORDS = 3, 50_000  # a word's letters; so many words are known to every task (about 1 MB)


@dataclass(frozen=True)
class Words:
    """Words by rank, the commonest being 1."""

    rank: dict[str, int]
    longest: int

    @classmethod
    def ranked(cls, words: list[str]) -> Words:
        rank: dict[str, int] = {}
        for word in words[:MOST_WORDS]:
            rank.setdefault(word, len(rank) + 1)
        return cls(rank, max(map(len, rank), default=0))


COMMON = Words.ranked(COMMON_WORDS)


def vocabulary_words(path: str) -> Words:
    """The fixed words, then the whole words of a word-piece vocabulary in its order, which is one of frequency."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    end = model["end_of_word_suffix"]
    pieces = sorted(model["vocab"], key=model["vocab"].get)
    words = [p.removesuffix(end) for p in pieces if p.endswith(end)]
    return Words.ranked(COMMON_WORDS + [w for w in words if len(w) >= LEAST_WORD and w.isascii() and w.isalpha()])


def _neighbours() -> dict[str, str]:
    near: dict[str, str] = {}
    for r, row in enumerate(KEY_ROWS):
        for c, key in enumerate(row):
            around = row[max(0, c - 1) : c] + row[c + 1 : c + 2]
            for other in KEY_ROWS[max(0, r - 1) : r] + KEY_ROWS[r + 1 : r + 2]:
                around += other[max(0, c - 1) : c + 2]
            near[key] = around
    return near


NEAR = _neighbours()


def _alphabet(char: str) -> float:
    """Bits of one brute-forced character."""
    if char.isdigit():
        return math.log2(10)
    if char.isascii() and char.isalpha():
        return math.log2(26)
    return math.log2(33) if char.isascii() else math.log2(1000)


def _walk_ends(text: str, linked) -> list[int]:
    """For each position, the end of the longest walk that starts there."""
    ends = list(range(1, len(text) + 1))
    for i in range(len(text) - 2, -1, -1):
        if linked(text[i], text[i + 1]):
            ends[i] = ends[i + 1]
    return ends


def guess_bits(value: str, enough: float = math.inf, words: Words = COMMON) -> float:
    """log2 of the guesses that the cheapest segmentation needs; 0 for an empty value.

    A brute-force span costs its characters; each further segment costs one bit more
    for the choice of its kind. Once every way on costs ``enough`` or more, a lower
    bound that has reached it is returned.
    """
    n, lower = len(value), value.lower()
    if len(lower) != n:
        lower = value
    plain = lower.translate(SUBSTITUTES)
    repeats = _walk_ends(value, lambda a, b: a == b)
    keys = _walk_ends(lower, lambda a, b: b in NEAR.get(a, ""))
    letters = _walk_ends(lower, lambda a, b: a.isalnum() and b.isalnum() and abs(ord(a) - ord(b)) == 1)
    best = [0.0] + [math.inf] * n
    brute = [False] * (n + 1)  # does the cheapest way to a position end in brute force
    far = 0  # the last position that a long segment reached for less than enough

    def offer(end: int, bits: float) -> None:
        if bits < best[end]:
            best[end], brute[end] = bits, False

    for i in range(n):
        if i % LONGEST_SEGMENT == 0 and far <= i + LONGEST_SEGMENT and min(best[i : i + LONGEST_SEGMENT + 1]) >= enough:
            return min(best[i : i + LONGEST_SEGMENT + 1])
        bits = best[i] + _alphabet(value[i]) + (0 if brute[i] else 1)
        if bits < best[i + 1]:
            best[i + 1], brute[i + 1] = bits, True
        base = best[i] + 1
        for size in range(LEAST_WORD, min(words.longest, n - i) + 1 if plain[i].isalpha() else 0):
            rank = words.rank.get(lower[i : i + size]) or words.rank.get(plain[i : i + size])
            if rank:
                part = value[i : i + size]
                changed = 0 if part == lower[i : i + size] else 1 if part[:1].isupper() and part[1:] == lower[i + 1 : i + size] else size
                offer(i + size, base + math.log2(rank + 1) + changed + (size / 2 if lower[i : i + size] not in words.rank else 0))
        if value[i].isdigit():
            for m in (DATE.match(value, i),):
                if m:
                    offer(m.end(), base + math.log2(366 * 120))
                    offer(min(i + 4, m.end()), base + math.log2(120) if m.end() >= i + 4 and value[i : i + 2] in ("19", "20") else math.inf)
        for end, cost in ((repeats[i], _alphabet(value[i])), (keys[i], math.log2(47) + 2), (letters[i], math.log2(36) + 1)):
            for size in range(3, min(end - i, LONGEST_SEGMENT) + 1):
                offer(i + size, base + cost + math.log2(size))
            if end - i > LONGEST_SEGMENT:  # a longer one goes to its end
                offer(end, base + cost + math.log2(end - i))
                if best[end] < enough:
                    far = max(far, end)
    return best[n]


@dataclass(frozen=True)
class SecretRules:
    """``least_bits``: a value in a credential context counts from this guessing cost on."""

    least_bits: float = 36.0


def find_spans(text: str, rules: SecretRules = SecretRules(), bits=guess_bits) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start and then kind; base spans first by their own rules.

    ``bits(value, enough)`` is the guessing cost. Linear in the text.
    """
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    taken = sorted((a, b) for a, b, _ in found)
    starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    for pattern in (CONTEXT, LOGIN):
        for m in pattern.finditer(text):
            group = next(g for g in range(1, pattern.groups + 1) if m[g] is not None)
            start, end = m.span(group)
            before = bisect_right(starts, start)
            if before and end <= reach[before - 1]:  # inside a base span
                continue
            if bits(text[start:end], rules.least_bits) >= rules.least_bits:
                found.append((start, end, "guess"))
    return sorted(set(found), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


_HEX_BYTES = byte_class(lambda b: chr(b) in "0123456789abcdef")


def _rows_to_search(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that can hold a span at all: a hint, the access prefix, or a long hex run."""
    raw = data.tobytes()
    lower, places = raw.lower(), []
    for hint, source in [(h, lower) for h in HINTS] + [(b"AKIA", raw)]:
        at = source.find(hint)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, side="right")) - 1
            places.append(row)
            at = source.find(hint, int(offsets[row + 1]))
    starts, ends, _ = spans(data, offsets, _HEX_BYTES)
    long_runs = starts[ends - starts >= HEX_LEAST]
    return np.unique(np.concatenate([np.array(places, np.int64), np.searchsorted(offsets, long_runs, side="right") - 1]))


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())])
SPAN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def scan_secrets(docs: DataFrame, text_column: str = "text", rules: SecretRules = SecretRules(), vocabulary: str | None = None) -> DataFrame:
    """All columns and ``secret_spans``: array of (start, end, kind), code points, end exclusive.

    One pass without a shuffle, whole texts. NULL and empty texts have no spans; equal
    texts have equal spans; an own column ``secret_spans`` is replaced. Words are the
    fixed ones and, given the driver's path of a ``vocabulary``, its whole words, at most
    ``MOST_WORDS`` of which are broadcast.
    """
    search = _search(docs, text_column, rules, vocabulary)
    return add_columns(docs, lambda batch: [pa.array(search(batch), SPAN_ARROW)], [T.StructField("secret_spans", T.ArrayType(SPAN))])


def _search(docs: DataFrame, text_column: str, rules: SecretRules, vocabulary: str | None) -> Callable[[pa.RecordBatch], list[list[dict]]]:
    """The spans of each row of a batch; words are broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary_words(vocabulary) if vocabulary else COMMON)

    def search(batch: pa.RecordBatch) -> list[list[dict]]:
        words = shared.value
        short = lru_cache(maxsize=20_000)(lambda value, enough: guess_bits(value, enough, words))
        bits = lambda value, enough: (short if len(value) <= LONGEST_SEGMENT else short.__wrapped__)(value, enough)
        column = batch.column(text_column)
        data, offsets = text_buffer(column)
        out: list[list] = [[] for _ in range(len(column))]
        for low, _, part, part_offsets in blocks(data, offsets):
            for row in _rows_to_search(part, part_offsets).tolist():
                text = part[part_offsets[row] : part_offsets[row + 1]].tobytes().decode("utf-8", "surrogatepass")
                out[low + row] = [{"start": a, "end": b, "kind": k} for a, b, k in find_spans(text, rules, bits)]
        return out

    return search


def span_digest(items: list[dict], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in items if s["kind"] in kinds)


def redact(text: str | None, found: list[dict], mark: str = "[SECRET]") -> str | None:
    """The text with each run of overlapping or touching spans replaced by ``mark``."""
    if not text or not found:
        return text
    out, at, i = [], 0, 0
    ordered = sorted((s["start"], s["end"]) for s in found)
    while i < len(ordered):
        start, end = ordered[i]
        while i + 1 < len(ordered) and ordered[i + 1][0] <= end:
            i += 1
            end = max(end, ordered[i][1])
        out += [text[at:start], mark]
        at, i = end, i + 1
    return "".join(out + [text[at:]])


def redact_secrets(docs: DataFrame, text_column: str = "text", rules: SecretRules = SecretRules(), vocabulary: str | None = None) -> DataFrame:
    """The same columns and rows, with secrets in the text replaced; NULL stays NULL.

    Found and replaced in one pass: two would take two Python workers a task, and idle ones stay and fill memory.
    """
    search = _search(docs, text_column, rules, vocabulary)

    def build(batch: pa.RecordBatch) -> list:
        found, texts = search(batch), batch.column(text_column)
        if not any(found):
            return [texts]
        return [pa.array([redact(t, s) for t, s in zip(texts.to_pylist(), found)], pa.string())]

    return add_columns(docs, build, [T.StructField(text_column, T.StringType())]).select(docs.columns)


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Per document: spans of each kind; the contract's digest columns."""
    import public_tokenizers

    from tidemark.llm.tables import table

    def build(batch: pa.RecordBatch) -> list:
        rows = batch.column("secret_spans").to_pylist()
        count = [pa.array([sum(s["kind"] == k for s in r) for r in rows], pa.int64()) for k in KINDS[:3]]
        digest = [hashlib.sha256(span_digest(r, KINDS[:3]).encode()).hexdigest() for r in rows]
        return [*count, pa.array(digest, pa.string()), pa.array([span_digest(r, KINDS) for r in rows], pa.string())]

    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary=public_tokenizers.path(VOCABULARY)).select("doc_id", "secret_spans")
    fields = [T.StructField(n, T.LongType()) for n in ("n_assign", "n_access", "n_hex")]
    fields += [T.StructField(n, T.StringType()) for n in ("base_sha256", "spans")]
    return add_columns(found, build, fields).drop("secret_spans")
