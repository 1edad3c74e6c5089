"""Suffix arrays by induced sorting, and permuted common prefixes.

Buckets of a small alphabet are handled a whole wave at a time with numpy. The reduced
strings of the recursion, with large alphabets, are ordered by prefix doubling, of which
each round takes only what is not yet told apart.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.arrays import span_hashes

SMALL_ALPHABET = 1024


def classify(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (S-type). The last symbol is the unique smallest and S."""
    n = len(s)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(s[1:].astype(np.int64) - s[:-1])
    step[-1] = 1
    # an equal neighbour takes the type of what follows
    place = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(place[::-1])[::-1]
    return step[following] > 0


def _induce_waves(s: np.ndarray, small: np.ndarray, ordered_lms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    n, k = len(s), len(counts)
    ends = np.cumsum(counts)
    heads = ends - counts
    sa = np.full(n, -1, np.int64)
    symbols = s[ordered_lms].astype(np.int64)
    lms_counts = np.bincount(symbols, minlength=k)
    lms_first = np.cumsum(lms_counts) - lms_counts
    by_symbol = ordered_lms[np.argsort(symbols.astype(np.uint16), kind="stable")]
    head = heads.copy()

    def push(entries: np.ndarray) -> None:
        c = s[entries].astype(np.int64)
        order = np.argsort(c.astype(np.uint16), kind="stable")
        entries, c = entries[order], c[order]
        first = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        size = np.diff(np.append(first, len(c)))
        sa[np.arange(len(c)) - np.repeat(first, size) + head[c]] = entries
        head[c[first]] += size

    def larger_before(entries: np.ndarray) -> np.ndarray:
        before = entries[entries > 0] - 1
        return before[~small[before]]

    for c in range(k):
        at = heads[c]
        while at < head[c]:
            wave = sa[at : head[c]].copy()
            at = head[c]
            before = larger_before(wave)
            if len(before):
                push(before)
        mine = by_symbol[lms_first[c] : lms_first[c] + lms_counts[c]]
        if len(mine):
            before = larger_before(mine)
            if len(before):
                push(before)
    tail = ends.copy()

    def push_back(entries: np.ndarray) -> None:
        c = s[entries].astype(np.int64)
        order = np.argsort(c.astype(np.uint16), kind="stable")
        entries, c = entries[order], c[order]
        first = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        size = np.diff(np.append(first, len(c)))
        sa[tail[c] - 1 - (np.arange(len(c)) - np.repeat(first, size))] = entries
        tail[c[first]] -= size

    def smaller_before(entries: np.ndarray) -> np.ndarray:
        before = entries[entries > 0] - 1
        return before[small[before]]

    sa[0] = n - 1
    tail[int(s[n - 1])] -= 1
    for c in range(k - 1, -1, -1):
        at = ends[c] if c != int(s[n - 1]) else tail[c] + 1
        while at > tail[c]:
            wave = sa[tail[c] : at][::-1].copy()
            at = tail[c]
            before = smaller_before(wave)
            if len(before):
                push_back(before)
        large = sa[heads[c] : head[c]][::-1]
        if len(large):
            before = smaller_before(large)
            if len(before):
                push_back(before)
    return sa


def _doubled(s: np.ndarray) -> np.ndarray:
    """The same by prefix doubling, for any alphabet: rounds grow with the logarithm of the longest repeat."""
    n = len(s)
    order = np.argsort(s, kind="stable")
    rank, live, key, width = np.empty(n, np.int64), np.arange(n), s[order], 1
    while len(live):
        fresh = np.append(True, key[1:] != key[:-1])
        # a suffix ranks by the place where those like it begin
        rank[order[live]] = live[np.maximum.accumulate(np.where(fresh, np.arange(len(live)), 0))]
        live = live[~(fresh & np.append(fresh[1:], True))]
        # what is not alone has no last symbol among its first ``width``, so more follows
        place = order[live]
        key = rank[place] * n + rank[place + width] if len(live) else live
        turn = np.argsort(key)
        order[live], key = place[turn], key[turn]
        width *= 2
    return order


def induced_suffix_array(s: np.ndarray) -> np.ndarray:
    """The suffix array of ``s``, non-negative integers of which the last is 0 and the only 0."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    counts = np.bincount(s)
    if len(counts) > SMALL_ALPHABET:
        return _doubled(s)
    small = classify(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) > 1:
        # leftmost-smaller substrings in order: one induction from their first symbols
        rough = _induce_waves(s, small, lms[np.argsort(s[lms], kind="stable")], counts)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        ordered = rough[is_lms[rough]]
        number = np.zeros(n, np.int64)
        number[lms] = np.arange(len(lms))
        until = np.append(lms[1:], n - 1) + 1
        keys = _substring_keys(s, lms, until)
        rank = number[ordered]
        fresh = np.append(0, np.cumsum((keys[rank][1:] != keys[rank][:-1]).any(axis=1)))
        names = np.zeros(len(lms), np.int64)
        names[rank] = fresh
        order = induced_suffix_array(names) if fresh[-1] + 1 < len(lms) else np.argsort(names)
        lms = lms[order]
    return _induce_waves(s, small, lms, counts)


def _substring_keys(s: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(hash, length) of each substring."""
    wide = np.ascontiguousarray(s.astype("<u4")).view(np.uint8) if s.max(initial=0) > 255 else s.astype(np.uint8)
    width = 4 if len(wide) != len(s) else 1
    return np.stack([span_hashes(wide, starts * width, ends * width).view(np.int64), ends - starts], axis=1)


def permuted_lcp(s: np.ndarray, sa: np.ndarray, stop: int) -> np.ndarray:
    """For each place, the symbols that its suffix shares with the one before it in order, none past a ``stop`` symbol.

    Only places whose left neighbours differ are compared; each other place shares one
    symbol less than the place before it.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    place = np.arange(n)
    left, other = np.maximum(place - 1, 0), np.maximum(before - 1, 0)
    own = (place == 0) | (before <= 0) | (s[left] != s[other]) | (s[left] <= stop)
    at = np.flatnonzero(own & (before >= 0))
    length = np.zeros(n, np.int64)
    live = at
    while len(live):
        a, b = live + length[live], before[live] + length[live]
        same = (s[np.minimum(a, n - 1)] == s[np.minimum(b, n - 1)]) & (a < n) & (b < n)
        same &= s[np.minimum(a, n - 1)] > stop
        live = live[same]
        length[live] += 1
    source = np.maximum.accumulate(np.where(own, place, 0))
    return np.maximum(length[source] - (place - source), 0) * (before >= 0)
