"""Periodic runs of words: a suffix automaton whose link tree keeps last occurrences by link-cut access.

Every appended word recolours the path from its prefix to the root with its own
position. The path falls into segments by the position that they held before; the
deepest string of a segment ends at both positions, so a distance no larger than its
length is the period of a square, and the string tells how far back it reaches. Each
position inside a run gives the same start and period, so the last one is its end.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import add_columns
from tidemark.llm.tables import table

MIN_LENGTH = 24
MIN_PERIODS = 3

Run = tuple[int, int, int]
RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])


def link_tree(ids: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix automaton of a sequence: longest length and suffix link of every state, and the state of every prefix."""
    length, link, moves, prefixes = [0], [-1], [{}], []
    last = 0
    for c in ids:
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        moves.append({})
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                moves.append(moves[q].copy())
                link[q] = link[new] = clone
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
        prefixes.append(new)
        last = new
    return length, link, prefixes


class LastOccurrences:
    """Paths of the link tree by last occurrence: each is a splay tree by depth, its position is kept at the root.

    State 0, the empty string, is on every path and stands for "none".
    """

    def __init__(self, link: list[int]):
        self.up = [max(parent, 0) for parent in link]
        self.left, self.right = [0] * len(link), [0] * len(link)
        self.at = [-1] * len(link)

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner:
            up[inner] = p
        if left[g] == p:
            left[g] = x
        elif right[g] == p:
            right[g] = x
        up[x], up[p] = g, x

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        top = x
        while (p := up[x]) and (left[p] == x or right[p] == x):
            g = up[p]
            top = p
            if g and (left[g] == p or right[g] == p):
                top = g
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            self._rotate(x)
        self.at[x] = self.at[top]

    def visit(self, state: int, position: int) -> list[tuple[int, int]]:
        """Gives the path of ``state`` a new position; returns (deepest state, old position) of its segments."""
        up, right, at = self.up, self.right, self.at
        segments, below, x = [], 0, state
        while x:
            self._splay(x)
            if at[x] >= 0:
                segments.append((x, at[x]))
            if right[x]:
                at[right[x]] = at[x]
            right[x] = below
            below, x = x, up[x]
        at[below] = position
        return segments


def runs_of(ids: Sequence[int]) -> dict[tuple[int, int], int]:
    """End by (start, smallest period) of every maximal repetition of two periods or more."""
    length, link, prefixes = link_tree(ids)
    tree, found = LastOccurrences(link), {}
    for position, state in enumerate(prefixes):
        for deepest, before in tree.visit(state, position):
            distance = position - before
            if distance <= length[deepest]:
                found[position + 1 - length[deepest] - distance, distance] = position + 1
    return found


def stretches(ids: np.ndarray, times: int, least: int) -> list[tuple[int, int]]:
    """Stretches of ``least`` words or more between the words that occur fewer than ``times`` times in the whole text."""
    often = np.bincount(ids)[ids] >= times
    edges = np.diff(np.concatenate(([0], often, [0])).astype(np.int8))
    lows, highs = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = highs - lows >= least
    return list(zip(lows[long].tolist(), highs[long].tolist()))


def find_runs(words: Sequence[bytes], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[Run]:
    """(start, length, period) of all runs, by start and period.

    Every word of a run of so many periods occurs that often, so no run holds a rarer
    word: the automaton is built over each stretch between such words that is long enough.
    """
    if min_periods < 2:
        raise ValueError("min_periods must be 2 or more")
    if len(words) < min_length:
        return []
    codes: dict[bytes, int] = {}
    ids = [codes.setdefault(word, len(codes)) for word in words]
    out = []
    for low, high in stretches(np.array(ids, np.int64), min_periods, min_length):
        for (start, period), end in runs_of(ids[low:high]).items():
            if end - start >= max(min_length, min_periods * period):
                out.append((low + start, end - start, period))
    return sorted(out, key=lambda run: (run[0], run[2]))


def collapse(words: Sequence[bytes], runs: list[Run]) -> list[bytes]:
    """The words outside the repeats: of each run only the first period stays."""
    if not runs:
        return list(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(drop)[:-1] == 0)]


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length by period, exactly; the first of equal ones."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None,
    min_length: int = MIN_LENGTH,
    min_periods: int = MIN_PERIODS,
) -> DataFrame:
    """``docs`` with n_words, runs (array of start, length, period), strongest and collapsed (the text without repeats).

    Words are split at ASCII white space and compared byte by byte. ``rewrite`` may change
    the words of a row, given ``key``, before they are searched. A projection: no shuffle,
    each text by itself, so repeated rows get equal results and an empty table stays empty.
    NULL and empty texts have no words, no runs and an empty collapsed text. A long text
    is handled whole, in n log n steps and memory in proportion to its words. Columns named as the new
    ones are replaced.
    """

    def build(batch: pa.RecordBatch) -> list:
        keys = batch.column(key).to_pylist() if rewrite else None
        counts, runs, best, collapsed = [], [], [], []
        for row, value in enumerate(batch.column(text)):
            words = (value.as_py() or "").encode().split()
            if rewrite:
                words = rewrite(keys[row], words)
            found = find_runs(words, min_length, min_periods)
            counts.append(len(words))
            runs.append([dict(zip(RUN.names, run)) for run in found])
            top = strongest(found)
            best.append(dict(zip(RUN.names, top)) if top else None)
            collapsed.append(b" ".join(collapse(words, found)).decode())
        run = pa.struct([(name, pa.int64()) for name in RUN.names])
        return [pa.array(counts, pa.int64()), pa.array(runs, pa.list_(run)), pa.array(best, run), pa.array(collapsed, pa.string())]

    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("strongest", RUN),
        T.StructField("collapsed", T.StringType()),
    ]
    return add_columns(docs, build, fields)


def repeat_tail(key: object, words: list[bytes]) -> list[bytes]:
    """The query's changed texts: of a tenth of the ids the words from some place on repeat 3 to 10 times. NULL ids change nothing."""
    h = zlib.crc32(str(key).encode())
    n = len(words)
    if key is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    head = words[a : a + period]
    return words[:a] + (head * (-(-(n - a) // period)))[: n - a]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, the strongest of them, and digests of all runs and of the text without repeats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    line = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    lines = F.when(F.size("runs") == 0, "").otherwise(F.concat(F.array_join(line, "\n"), F.lit("\n")))
    best = F.col("strongest")
    return periodic_runs(docs, rewrite=repeat_tail).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
