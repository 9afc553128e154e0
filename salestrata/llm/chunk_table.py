"""A table of the distinct chunks that a worker has met, with the ids of each."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

MOST = 300_000


class ChunkTable:
    """Encodes each distinct chunk once, as long as it stays in the table.  When the
    table holds ``most`` chunks, those looked up least are dropped; they would be
    encoded again, with the same ids.  That bounds its memory and changes no result."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = MOST, dtype=np.uint32):
        self.encode, self.most = encode, most
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, dtype=dtype)
        self.offsets = np.zeros(1 << 14, dtype=np.int64)
        self.uses = np.zeros(1 << 14, dtype=np.int32)

    def rows(self, chunks: list[bytes]) -> np.ndarray:
        """The rows of the chunks in the table, valid until the next call."""
        if len(self.known) > self.most:
            self._thin()
        known = self.known
        rows = np.fromiter([known.get(c, -1) for c in chunks], dtype=np.int64, count=len(chunks))
        missing = np.flatnonzero(rows < 0).tolist()
        if missing:
            new = list(dict.fromkeys([chunks[i] for i in missing]))
            self._add(new, *self.encode(new))
            rows[missing] = [known[chunks[i]] for i in missing]
        self.uses[rows] += 1
        return rows

    def _add(self, chunks: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        first, used = len(self.known), int(self.offsets[len(self.known)])
        last = first + len(chunks)
        self.ids = _fitted(self.ids, used + len(ids))
        self.offsets = _fitted(self.offsets, last + 1)
        self.uses = _fitted(self.uses, last + 1)
        self.ids[used:used + len(ids)] = ids
        self.offsets[first + 1:last + 1] = used + np.cumsum(lengths)
        self.uses[first:last] = 0
        self.known.update(zip(chunks, range(first, last)))

    def _thin(self) -> None:
        """Keeps the chunks looked up most, half of the table at most."""
        uses = self.uses[:len(self.known)]
        least = 2
        while (keep := uses >= least).sum() > self.most // 2:
            least *= 2
        kept = np.flatnonzero(keep)
        ids, lengths = self.joined(kept)
        chunks = list(self.known)
        self.known = {}
        self._add([chunks[i] for i in kept.tolist()], ids.copy(), lengths)

    def joined(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows one after the other, and how many each has."""
        size = len(self.known)
        lists = pa.LargeListArray.from_arrays(self.offsets[:size + 1], self.ids[:int(self.offsets[size])])
        return (lists.take(pa.array(rows)).flatten().to_numpy(),
                self.offsets[rows + 1] - self.offsets[rows])


def _fitted(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    larger = np.zeros(max(size, 2 * len(array)), dtype=array.dtype)
    larger[:len(array)] = array
    return larger
