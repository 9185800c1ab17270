"""A hash table that is probed for whole arrays of keys."""

from __future__ import annotations

import numpy as np


class Lookup:
    """An open-addressed table of non-negative 64-bit keys to 32-bit values, probed for many keys at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(keys))
        at = self._home(keys)
        while len(left):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[left[free]]  # of several on one slot the last stays
            won = self.keys[at] == keys[left]
            self.values[at[won]] = values[left[won]]
            left, at = left[~won], (at[~won] + 1) % len(self.keys)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, -1 where absent."""
        at = self._home(keys)
        found = self.keys[at]
        out = self.values[at].copy()
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        out[found != keys] = -1
        at = at[open_]
        while len(open_):
            at = (at + 1) % len(self.keys)
            found = self.keys[at]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            go = ~hit & (found >= 0)
            open_, at = open_[go], at[go]
        return out
