"""Encoding distinct stretches of text once, with a table of bounded size of those seen before."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tidemark.llm.arrays import ranges, span_hashes

Encode = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class UnitTable:
    """Ids by the hash of a unit. ``encode(data, starts, ends)`` gives the ids of units and how many each has.

    When the table would pass ``limit`` units, it starts anew with those of the block at hand.
    """

    def __init__(self, encode: Encode, dtype: type, limit: int):
        self.encode_units, self.dtype, self.limit = encode, dtype, limit
        self.keys = np.zeros(0, np.uint64)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, dtype)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units behind each other, and the n + 1 offsets of the units."""
        keys, index, inverse = _distinct(span_hashes(data, starts, ends))
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = self.keys[at] == keys
        fresh = index[~known]
        if len(fresh):
            ids, size = self.encode_units(data, starts[fresh], ends[fresh])
            if len(self.keys) + len(fresh) > self.limit:
                kept = at[known] if len(self.keys) else np.zeros(0, np.int64)
                self.ids = self.ids[ranges(self.first[kept], self.size[kept])]
                self.keys, self.size = self.keys[kept], self.size[kept]
                self.first = np.cumsum(self.size) - self.size
            place = np.searchsorted(self.keys, keys[~known])
            self.first = np.insert(self.first, place, len(self.ids) + np.cumsum(size) - size)
            self.size = np.insert(self.size, place, size)
            self.keys = np.insert(self.keys, place, keys[~known])
            self.ids = np.concatenate([self.ids, ids.astype(self.dtype)])
        unit = np.searchsorted(self.keys, keys)[inverse]
        size = self.size[unit]
        return self.ids[ranges(self.first[unit], size)], np.concatenate([[0], np.cumsum(size)])


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, one place of each, and for each place which of them it has."""
    order = np.argsort(values)
    ordered = values[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    which = np.empty(len(values), np.int64)
    which[order] = np.cumsum(fresh) - 1
    return ordered[fresh], order[fresh], which
