"""Hashed counts of byte n-grams of texts, as dense rows; a long text is counted in parts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow.compute as pc

from salestrata.llm import textkit
from salestrata.llm.textkit import Texts, plain_array, texts_of

SIZES = (1, 2, 3)
BUCKETS = 4096  # 2 ** 12
_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
# Rows made dense at a time.
ROWS = 256
_SHIFT = np.uint32(32 - 12)


def _letters(texts: Texts) -> Texts:
    """The texts with every run of other characters as one space, one at each end."""
    size = int(texts.offsets[-1])
    data = texts.data[:size]
    letter = _LETTER[data]
    # a space in front of each letter run, and one after a row's last
    edge = np.zeros(size + 1, dtype=bool)
    edge[texts.offsets] = True
    begins = letter & ~np.concatenate(([False], letter[:-1])) | (letter & edge[:-1]) if size else letter
    kept = np.cumsum(letter) + np.cumsum(begins)
    rows_end = np.concatenate(([0], kept))[texts.offsets]
    rows = np.arange(len(texts) + 1)
    out = np.full(int(rows_end[-1]) + len(texts), 0x20, dtype=np.uint8)
    at = np.flatnonzero(letter)
    row = np.searchsorted(texts.offsets, at, side="right") - 1
    out[kept[at] - 1 + row] = data[at]
    return Texts(out, rows_end + rows)


def _letter_part(data: np.ndarray, after_letter: bool) -> np.ndarray:
    """Part of a text as ``_letters`` has it, but for the space at the end; the part before may have ended in a letter."""
    letter = _LETTER[data]
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    begins[:1] &= not after_letter
    at = np.flatnonzero(letter)
    out = np.full(len(at) + np.count_nonzero(begins), 0x20, dtype=np.uint8)
    out[np.arange(len(at)) + np.cumsum(begins[at])] = data[at]
    return out


def _slots(data: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the n-gram that begins at each byte."""
    packed = data[:len(data) - n + 1].astype(np.uint32)
    for i in range(1, n):
        packed <<= np.uint32(8)
        packed |= data[i:len(data) - n + 1 + i]
    packed += np.uint32(n << 24)
    packed *= np.uint32(0x9E3779B1)
    packed ^= packed >> np.uint32(15)
    packed *= np.uint32(0x85EBCA77)
    return (packed >> _SHIFT).astype(np.int64)


def _long_counts(data: np.ndarray, letters: bool) -> np.ndarray:
    """The n-gram counts of one text, made a part at a time: sums of those that end in each part."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    before = np.zeros(0, dtype=np.uint8)  # the last bytes so far, as the counted n-grams have them
    for low in range(0, len(data), textkit.PIECE_BYTES):
        part = data[low:low + textkit.PIECE_BYTES]
        if letters:
            part = _letter_part(part, low > 0 and bool(_LETTER[data[low - 1]]))
            if low + textkit.PIECE_BYTES >= len(data):
                part = np.append(part, np.uint8(0x20))
        part = np.concatenate((before, part))
        for n in SIZES:
            fresh = part[max(len(before) - n + 1, 0):]
            if len(fresh) >= n:
                total += np.bincount(_slots(fresh, n), minlength=BUCKETS)
        before = part[len(part) - min(len(part), max(SIZES) - 1):]
    return total


def counts(column, letters: bool = False) -> Iterator[tuple[int, np.ndarray]]:
    """``(first row, counts)``: the n-gram counts of up to ``ROWS`` texts at a time, a row each.  With ``letters``
    those of the letters, lower case, runs of other characters as a space."""
    column = pc.fill_null(plain_array(column), "")
    texts = texts_of(pc.utf8_lower(column) if letters else column)
    if len(texts) == 1 and texts.offsets[-1] > textkit.PIECE_BYTES:
        yield 0, _long_counts(texts.data[:texts.offsets[-1]], letters)[None, :]
        return
    if letters:
        texts = _letters(texts)
    data = texts.data[:texts.offsets[-1]]
    hashed = [(n, _slots(data, n)) for n in SIZES if len(data) >= n]
    for first in range(0, len(texts), ROWS):
        last = min(first + ROWS, len(texts))
        total = np.zeros((last - first) * BUCKETS, dtype=np.int64)
        for n, slots in hashed:
            low = texts.offsets[first:last]
            high = np.maximum(texts.offsets[first + 1:last + 1] - n + 1, low)
            row = np.repeat(np.arange(last - first) * BUCKETS, high - low)
            if (high - low).sum() == 0:
                continue
            at = np.repeat(low - np.concatenate(([0], np.cumsum(high - low)[:-1])), high - low) + np.arange(len(row))
            total += np.bincount(slots[at] + row, minlength=len(total))
        yield first, total.reshape(-1, BUCKETS)
