"""Personal data by rule, over whole blocks of texts, and the stretches worth a closer look.

All patterns are ASCII, so they are found in UTF-8 bytes.  Digit runs are found with
array operations and put into chains by the character between them; no pattern is
tried again from each place of a long run, so the time is linear in the text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

from salestrata.llm.textkit import Texts

KINDS = ("email", "ip", "card", "phone")  # in the order in which spans of one start are listed

_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_LOCAL = _DIGIT.copy()
_LOCAL[0x41:0x5B] = _LOCAL[0x61:0x7B] = True
_LOCAL[list(b"._%+-")] = True
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_PHONE_RUN = re.compile(rb"[\x20().0-9-]+")
_LAST_DIGIT = re.compile(rb"[0-9][^0-9]*\Z")

# A stretch begins and ends so many bytes around what it is for.
CONTEXT = 48
_NEAR = 4  # bytes between digit runs of one cluster
_MANY_DIGITS, _MANY_RUNS = 7, 4
_AT = re.compile(rb"@|[\[({<] ?at ?[\])}>]", re.IGNORECASE)


@dataclass
class Spans:
    """Spans as byte offsets of the block, by text, start and kind."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    kind: np.ndarray


def luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = (c - 0x30) * (2 if i % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


class DigitRuns:
    """The digit runs of a block; ``links(bytes)`` are the chains of runs with one of these between."""

    def __init__(self, texts: Texts):
        size = int(texts.offsets[-1])
        self.data = texts.data
        inside = _DIGIT[texts.data[:size]]
        edge = np.zeros(size + 1, dtype=bool)
        edge[texts.offsets] = True
        change = np.zeros(size + 1, dtype=bool)
        change[1:-1] = inside[1:] != inside[:-1]
        bounds = np.flatnonzero(change | edge)
        starts = bounds[:-1] if len(bounds) else bounds
        keep = inside[starts] & (np.diff(bounds) > 0) if len(starts) else np.zeros(0, bool)
        self.start, self.end = starts[keep], bounds[1:][keep] if len(bounds) else bounds
        self.row = np.searchsorted(texts.offsets, self.start, side="right") - 1

    def links(self, between: bytes) -> np.ndarray:
        """The first run of each chain."""
        if not len(self.start):
            return np.zeros(0, dtype=np.int64)
        allowed = np.zeros(256, dtype=bool)
        allowed[list(between)] = True
        linked = ((self.start[1:] - self.end[:-1] == 1) & (self.row[1:] == self.row[:-1])
                  & allowed[self.data[np.minimum(self.end[:-1], len(self.data) - 1)]])
        return np.flatnonzero(np.concatenate(([True], ~linked)))


def _ips(runs: DigitRuns) -> list[tuple[int, int]]:
    found = []
    first = runs.links(b".")
    sizes = np.diff(np.append(first, len(runs.start)))
    for chain in np.flatnonzero(sizes >= 4).tolist():
        for at in range(int(first[chain]), int(first[chain] + sizes[chain]) - 3, 4):
            parts = [runs.data[runs.start[i]:runs.end[i]].tobytes() for i in range(at, at + 4)]
            if all(len(p.lstrip(b"0")) <= 3 and int(p.lstrip(b"0") or b"0") <= 255 for p in parts):
                found.append((int(runs.start[at]), int(runs.end[at + 3])))
    return found


def _cards(runs: DigitRuns) -> list[tuple[int, int]]:
    found = []
    first = runs.links(b" -")
    if not len(first):
        return found
    last = np.append(first[1:], len(runs.start)) - 1
    digits = np.add.reduceat(runs.end - runs.start, first)
    for chain in np.flatnonzero((digits >= 14) & (digits <= 19)).tolist():
        low, high = int(runs.start[first[chain]]), int(runs.end[last[chain]])
        if luhn(bytes(c for c in runs.data[low:high].tobytes() if 0x30 <= c <= 0x39)):
            found.append((low, high))
    return found


def _emails(texts: Texts) -> list[tuple[int, int]]:
    size = int(texts.offsets[-1])
    signs = np.flatnonzero(texts.data[:size] == 0x40)
    if not len(signs):
        return []
    outside = np.flatnonzero(~_LOCAL[texts.data[:size]])
    low = outside[np.maximum(np.searchsorted(outside, signs) - 1, 0)] + 1
    low[np.searchsorted(outside, signs) == 0] = 0
    row = np.searchsorted(texts.offsets, signs, side="right") - 1
    low = np.maximum(low, texts.offsets[row])
    found, before = [], 0
    for at, begin, end in zip(signs.tolist(), low.tolist(), texts.offsets[row + 1].tolist()):
        domain = _DOMAIN.match(texts.data, at + 1, end)
        begin = max(begin, before)
        if domain and begin < at:
            before = domain.end()
            found.append((begin, before))
    return found


def _phones(texts: Texts) -> list[tuple[int, int]]:
    size = int(texts.offsets[-1])
    data = texts.data
    plus = np.flatnonzero(data[:size] == 0x2B)
    plus = plus[_DIGIT[data[plus + 1]]]  # eight zero bytes follow the last text
    found = []
    for at, end in zip(plus.tolist(), texts.offsets[np.searchsorted(texts.offsets, plus, side="right")].tolist()):
        run = _PHONE_RUN.match(data, at + 2, end) if at + 2 < end else None
        last = _LAST_DIGIT.search(run[0], 1) if run else None
        if last:
            stop = run.start() + last.start() + 1
            if 10 <= int(_DIGIT[data[at:stop]].sum()) <= 15:
                found.append((at, stop))
    return found


def base_spans(texts: Texts, runs: DigitRuns) -> Spans:
    by_kind = (_emails(texts), _ips(runs), _cards(runs), _phones(texts))
    rows = [(a, kind, b) for kind, found in enumerate(by_kind) for a, b in found]
    start, kind, end = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3).T
    return Spans(np.searchsorted(texts.offsets, start, side="right") - 1, start, end, kind)


def stretches(texts: Texts, runs: DigitRuns) -> list[tuple[int, int, int]]:
    """``(row, start, end)``: where an address sign, many digits or many numbers stand close together."""
    spans = [(m.start(), m.end()) for m in _AT.finditer(texts.data[:texts.offsets[-1]])]
    if len(runs.start):
        apart = (runs.start[1:] - runs.end[:-1] > _NEAR) | (runs.row[1:] != runs.row[:-1])
        first = np.flatnonzero(np.concatenate(([True], apart)))
        last = np.append(first[1:], len(runs.start)) - 1
        digits = np.add.reduceat(runs.end - runs.start, first)
        many = np.flatnonzero((digits >= _MANY_DIGITS) | (last - first + 1 >= _MANY_RUNS))
        spans += zip(runs.start[first[many]].tolist(), runs.end[last[many]].tolist())
    found: list[tuple[int, int, int]] = []
    offsets = texts.offsets
    for low, high in sorted(spans):
        row = int(np.searchsorted(offsets, low, side="right")) - 1
        low, high = max(low - CONTEXT, int(offsets[row])), min(high + CONTEXT, int(offsets[row + 1]))
        if found and found[-1][0] == row and low <= found[-1][2]:
            found[-1] = (row, found[-1][1], max(high, found[-1][2]))
        else:
            found.append((row, low, high))
    return found


def code_points(texts: Texts, offsets: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Byte offsets of the block, in ascending order, as code points of their text."""
    out = np.zeros(len(offsets), dtype=np.int64)
    at, count, of = 0, 0, -1
    for i, (offset, r) in enumerate(zip(offsets.tolist(), row.tolist())):
        if r != of:
            at, count, of = int(texts.offsets[r]), 0, r
        count += int(np.count_nonzero((texts.data[at:offset] & 0xC0) != 0x80))
        at, out[i] = offset, count
    return out
