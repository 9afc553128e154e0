"""Sorted hash arrays with a bucket directory, looked up a whole array at a time."""

from __future__ import annotations

import numpy as np


class SortedHashTable:
    """Sorted ``uint64`` keys, each with a row number.

    The directory holds where each run of equal leading bits begins, so that a
    lookup starts next to its key.  Keys are hashes, evenly spread, and there is
    about one to a bucket.
    """

    def __init__(self, keys: np.ndarray):
        if len(keys) > 1 and not (keys[1:] > keys[:-1]).all():
            raise ValueError("keys must rise")
        self.keys = keys.astype(np.uint64)
        bits = max(1, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        edges = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.begins = np.append(np.searchsorted(self.keys, edges), len(keys)).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The row of each wanted key, -1 where it is not in the table."""
        wanted = wanted.astype(np.uint64, copy=False)
        if not len(self.keys):
            return np.full(len(wanted), -1, dtype=np.int32)
        bucket = (wanted >> self.shift).astype(np.int64)
        at = self.begins[bucket]
        last = len(self.keys) - 1
        found = np.where(self.keys[np.minimum(at, last)] == wanted, at, np.int32(-1))
        open_ = np.flatnonzero(found < 0)
        at, end, wanted = at[open_] + 1, self.begins[bucket[open_] + 1], wanted[open_]
        while len(open_):
            inside = at < end
            open_, at, end, wanted = open_[inside], at[inside], end[inside], wanted[inside]
            hit = self.keys[at] == wanted
            found[open_[hit]] = at[hit]
            open_, at, end, wanted = open_[~hit], at[~hit] + 1, end[~hit], wanted[~hit]
        return found
