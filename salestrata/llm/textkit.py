"""Whole Arrow text columns as numpy arrays: words, lines, hashes, blocks of rows.

The operators of this subpackage read texts in Arrow batches inside Spark tasks.
Working on the flat UTF-8 bytes of a block keeps memory bounded by the block and
the work per word a few array operations.  A null text counts as an empty one;
callers that treat it otherwise look at the null mask first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A block of rows holds at most so many text bytes, or a single row.
BLOCK_BYTES = 2 << 20
# What is several times its bytes is made of so many bytes of a text at a time.
PIECE_BYTES = 4 << 20

_MIX_1 = np.uint64(0x9E3779B97F4A7C15)
_MIX_2 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_3 = np.uint64(0x94D049BB133111EB)
_TAIL_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
_BLOCK = 8
_LOOK = 1 << 16  # bytes searched for a gap at a time

# Bytes that are part of a word.  Both classes are the same in UTF-8 bytes and in
# code points, as every byte of a non-ASCII character is 0x80 or more.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x80:] = True
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = True

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[0x41:0x5B] += 0x20


@dataclass
class Texts:
    """The texts of a block: ``data[offsets[i]:offsets[i + 1]]`` are row i's bytes.
    Eight zero bytes follow the last text."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


@dataclass
class Words:
    """Byte spans of the words of a block; row i has words ``first[i]:first[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def plain_array(column) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column if pa.types.is_large_string(column.type) else column.cast(pa.large_string())


def texts_of(column, lower: bool = False) -> Texts:
    """The column's bytes, ASCII letters lowered if asked for."""
    column = pc.fill_null(plain_array(column), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.zeros(high - low + _BLOCK, dtype=np.uint8)
    if high > low:
        data[:high - low] = np.frombuffer(column.buffers()[2], dtype=np.uint8)[low:high]
    if lower:
        data = ASCII_LOWER[data]
    return Texts(data, offsets - low)


def row_blocks(batches: Iterable[pa.RecordBatch], text: str = "text",
               limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into blocks of at most ``limit`` text bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < len(sizes):
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end
    pa.default_memory_pool().release_unused()  # the worker lives on after the task


def words_of(texts: Texts, word_bytes: np.ndarray) -> Words:
    """The runs of word bytes.  A word ends with its text at the latest."""
    inside = word_bytes[texts.data[:texts.offsets[-1]]]
    edge = np.zeros(len(inside) + 1, dtype=bool)
    edge[texts.offsets] = True
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, texts.offsets))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_2
    values = (values ^ (values >> np.uint64(27))) * _MIX_3
    return values ^ (values >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; spans of up to eight bytes and one length never
    share one.  ``data`` has eight spare bytes at its end."""
    blocks = np.ndarray((max(len(data) - _BLOCK + 1, 0),), dtype="<u8", buffer=data, strides=(1,))
    left = (ends - starts).astype(np.int64)
    hashes = left.astype(np.uint64) * _MIX_1
    at = starts.astype(np.int64)
    part = blocks[at] & _TAIL_MASK[np.minimum(left, _BLOCK)]
    hashes = mix(hashes ^ part)
    rest = np.flatnonzero(left > _BLOCK)
    while len(rest):
        at[rest] += _BLOCK
        left[rest] -= _BLOCK
        part = blocks[at[rest]] & _TAIL_MASK[np.minimum(left[rest], _BLOCK)]
        hashes[rest] = mix((hashes[rest] + _MIX_1) ^ part)
        rest = rest[left[rest] > _BLOCK]
    return hashes


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive word hashes, rows ignored; n - 1 fewer values."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    weight = _MIX_1
    for i in range(n):
        total += words[i:i + count] * weight
        weight = np.uint64((int(weight) * int(_MIX_2) + 2) & 0xFFFFFFFFFFFFFFFF) | np.uint64(1)
    return mix(total)


def window_rows(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of the windows of n words inside one row, and their rows."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    skipped = first[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else counts
    return np.arange(len(rows)) + np.repeat(skipped, counts), rows


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[i]:first[i + 1]]``."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[first[1:]] - total[first[:-1]]


def set_counts(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of ``mask[offsets[i]:offsets[i + 1]]`` are set, without a number per byte."""
    counts = np.zeros(len(offsets) - 1, dtype=np.int64)
    filled = np.flatnonzero(np.diff(offsets))
    if len(filled) == 1:
        counts[filled] = np.count_nonzero(mask[offsets[filled[0]]:offsets[filled[0] + 1]])
    elif len(filled):
        counts[filled] = np.add.reduceat(mask[:offsets[-1]], offsets[filled], dtype=np.int64)
    return counts


def overlapping(texts: Texts, spare: int, piece: int | None = None) -> Iterator[Texts]:
    """The block as it is; a single text of more than ``piece`` bytes in parts of that size, each with
    the first ``spare`` bytes of the next: every run of up to ``spare`` + 1 bytes is in one part."""
    piece = piece or PIECE_BYTES
    size = int(texts.offsets[-1])
    if len(texts) != 1 or size <= piece + spare:
        yield texts
        return
    for low in range(0, size - spare, piece):
        high = min(low + piece + spare, size)
        yield Texts(texts.data[low:high], np.array([0, high - low], dtype=np.int64))


def at_gaps(texts: Texts, word_bytes: np.ndarray, piece: int | None = None) -> Iterator[Texts]:
    """The block as it is; a single text of more than ``piece`` bytes in parts of that size or little more,
    each cut in front of a byte that is of no word."""
    piece = piece or PIECE_BYTES
    size = int(texts.offsets[-1])
    if len(texts) != 1 or size <= piece:
        yield texts
        return
    low = 0
    while low < size:
        high = low + piece
        while high < size and len(gap := word_bytes[texts.data[high:high + _LOOK]]):
            if not gap.all():
                high += int(np.argmin(gap))
                break
            high += len(gap)
        high = min(high, size)
        yield Texts(texts.data[low:high + _BLOCK], np.array([0, high - low], dtype=np.int64))
        low = high


def covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``size`` positions lie in ``[start, start + length)`` of any start."""
    change = np.zeros(size + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + length, size), -1)
    return np.cumsum(change[:-1]) > 0
