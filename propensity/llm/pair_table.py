"""A hash table from pairs of symbols to ranks, looked up for whole arrays at once."""

from __future__ import annotations

import numpy as np

#: The rank of a pair that no rule joins.
NEVER = np.iinfo(np.int64).max
_MIX = np.uint64(0x9E3779B97F4A7C15)      # fixed value: 2^64 over the golden ratio


class PairTable:
    """Open addressing with linear probing over 64-bit keys left * 2^32 + right."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        keys = (np.asarray(left, np.int64) << 32) | np.asarray(right, np.int64)
        bits = max(4, int(max(len(keys), 1) * 4 - 1).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._key = np.full(1 << bits, -1, dtype=np.int64)
        self._rank = np.full(1 << bits, NEVER, dtype=np.int64)
        self._merged = np.full(1 << bits, -1, dtype=np.int64)
        left_over, probe = np.arange(len(keys)), 0
        while len(left_over):
            slot = (self._home(keys[left_over]) + probe) & self._mask
            free = self._key[slot] < 0
            _, first = np.unique(slot, return_index=True)
            take = np.zeros(len(slot), dtype=bool)
            take[first] = True
            take &= free
            put = left_over[take]
            self._key[slot[take]], self._rank[slot[take]] = keys[put], np.asarray(rank)[put]
            self._merged[slot[take]] = np.asarray(merged)[put]
            left_over, probe = left_over[~take], probe + 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MIX) >> self._shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of each pair; NEVER and -1 where no rule joins it. Negative symbols never join."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        ranks, merged = np.full(len(keys), NEVER, dtype=np.int64), np.full(len(keys), -1, dtype=np.int64)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._home(keys[open_])
        while len(open_):
            held = self._key[slot]
            hit = held == keys[open_]
            ranks[open_[hit]], merged[open_[hit]] = self._rank[slot[hit]], self._merged[slot[hit]]
            on = ~hit & (held >= 0)
            open_, slot = open_[on], (slot[on] + 1) & self._mask
        return ranks, merged
