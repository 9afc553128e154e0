"""Operator 10, license scans: ordered signature rules.

Base: the words of ``PHRASES`` standing one after the other, words being runs of
ASCII letters and digits and of non-ASCII characters with A-Z lowered.

Method: the rules of ``license_rules`` are regular expressions over the whole text
with A-Z lowered.  A rule is tried only on texts that have its keyword, with any
separators as one space or as it stands.  Detections are taken by priority, then longest
first, then leftmost, then in the order of the rules; one that lies within a taken interval is suppressed, so
"gnu general public license version 3" is gpl-3.0 and not gpl as well.  Labels are those of the base
and of the detections taken; the score is the highest weight of any, 0.5 for a base
phrase alone, 0 for nothing.

A null text is empty and has no words and no label.  Repeated rows are scanned
each, other columns are not looked at, and an empty table gives an empty result.  A text
of any length is scanned whole in one task, its words in parts; it takes some ten times its size there.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestrata.llm.license_rules import WEIGHTS, Rule, rules
from salestrata.llm.shared import in_tasks
from salestrata.llm.textkit import (
    ALNUM,
    Texts,
    at_gaps,
    row_blocks,
    span_hashes,
    texts_of,
    window_hashes,
    words_of,
)

# Phrases of the base and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
BASE_SCORE = 0.5
_SPACED = bytes(b if ALNUM[b] else 0x20 for b in range(256))
_SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
           "labels string, score double, detections array<struct<start:int,end:int,label:string,priority:int>>")


@lru_cache(1)
def _rules_by_keyword() -> dict[str, list[tuple[int, Rule]]]:
    grouped: dict[str, list[tuple[int, Rule]]] = {}
    for number, rule in enumerate(rules()):
        grouped.setdefault(rule.keyword, []).append((number, rule))
    return grouped


@lru_cache(1)
def _keywords() -> list[tuple[str, bytes, bool]]:
    """The keywords, their bytes, and whether they have a mark, which only the text as it stands can have."""
    return [(k, k.encode(), k.encode().translate(_SPACED) != k.encode()) for k in _rules_by_keyword()]


def found_keywords(text: bytes) -> list[str]:
    """The keywords that the text has: those with a mark as it stands, the others with its words joined by a space."""
    plain = text.translate(_SPACED)
    while b"  " in plain:
        plain = plain.replace(b"  ", b" ")
    return [k for k, raw, marked in _keywords() if raw in (text if marked else plain)]


def detect(text: bytes) -> list[tuple[int, int, str, int]]:
    """``(start, end, label, priority)`` of the detections that stand, places in
    code points; ``text`` is UTF-8 with A-Z lowered."""
    keywords = found_keywords(text)
    if not keywords:
        return []
    whole = text.decode()
    raw = [(-rule.priority, m.start() - m.end(), m.start(), number, rule.label)
           for keyword in keywords for number, rule in _rules_by_keyword()[keyword]
           for m in rule.pattern.finditer(whole)]
    return sorted(suppressed(sorted(raw)))


def suppressed(ordered: list[tuple]) -> Iterator[tuple[int, int, str, int]]:
    """The detections, best first, that lie in none before them.

    ``starts`` and ``ends`` are the taken intervals that lie in no other: both rise, so
    the last one to start in time also ends last.
    """
    starts: list[int] = []
    ends: list[int] = []
    for priority, size, start, _, label in ordered:
        end = start - size
        at = bisect_right(starts, start)
        if at and ends[at - 1] >= end:
            continue
        low, high = bisect_left(starts, start), bisect_right(ends, end)
        starts[low:max(low, high)], ends[low:max(low, high)] = [start], [end]
        yield start, end, label, -priority


def _phrase_hashes() -> dict[int, list[tuple[np.uint64, str]]]:
    out: dict[int, list[tuple[np.uint64, str]]] = {}
    for phrase, label in PHRASES.items():
        texts = texts_of(pa.array([phrase]))
        words = words_of(texts, ALNUM)
        n = len(words.starts)
        out.setdefault(n, []).append((window_hashes(span_hashes(texts.data, words.starts, words.ends), n)[0], label))
    return out


def _places(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Words per row, and row, word and label of each place of a phrase.  A long text is
    read in parts; the last words of a part stand in front of the next one's."""
    phrases = _phrase_hashes()
    spare = max(phrases) - 1
    counts, before = np.zeros(len(texts), dtype=np.int64), np.zeros(0, dtype=np.uint64)
    rows, places, labels = [], [np.zeros(0, dtype=np.int64)], []
    for part in at_gaps(texts, ALNUM):
        words = words_of(part, ALNUM)
        seen = len(before)
        hashes = np.concatenate((before, span_hashes(part.data, words.starts, words.ends)))
        for n, wanted in phrases.items():
            windows = window_hashes(hashes, n)
            for value, label in wanted:
                start = np.flatnonzero(windows == value) - seen
                start = start[start + n > 0]  # the others lie in the part before
                row = np.searchsorted(words.first, np.maximum(start, 0), side="right") - 1
                inside = start + n <= words.first[row + 1]
                start, row = start[inside], row[inside]
                rows.append(row)
                places.append(start - words.first[row] + counts[row])
                labels += [label] * len(start)
        counts += np.diff(words.first)
        before = hashes[max(len(hashes) - spare, 0):]
    return counts, np.concatenate([np.zeros(0, dtype=np.int64), *rows]), np.concatenate(places), labels


def _scanning(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in row_blocks(parts):
        texts = texts_of(block.column("text"), lower=True)
        n_words, row, word, names = _places(texts)
        size = len(texts)
        base: list[list[tuple[int, str]]] = [[] for _ in range(size)]
        for r, w, name in zip(row.tolist(), word.tolist(), names):
            base[r].append((w, name))
        detections, labels, base_labels, scores = [], [], [], []
        for i in range(size):
            found = detect(texts.text(i))
            own = {name for _, name in base[i]}
            detections.append([{"start": s, "end": e, "label": label, "priority": p} for s, e, label, p in found])
            labels.append(",".join(sorted(own | {label for _, _, label, _ in found})))
            base_labels.append(",".join(sorted(own)))
            scores.append(max([WEIGHTS[p] for *_, p in found] + [BASE_SCORE] * bool(own), default=0.0))
        places = [[w for w, _ in b] for b in base]
        yield pa.RecordBatch.from_arrays([
            block.column("doc_id"), pa.array(n_words.astype(np.int64)), pa.array([len(p) for p in places], pa.int64()),
            pa.array([min(p, default=None) for p in places], pa.int64()),
            pa.array([max(p, default=None) for p in places], pa.int64()),
            pa.array(base_labels, pa.string()), pa.array(labels, pa.string()), pa.array(scores, pa.float64()),
            pa.array(detections, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                                      ("label", pa.string()), ("priority", pa.int32())])))],
            names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"])


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: places of base phrases, labels, score, the detections that stand."""
    return in_tasks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _scanning, _SCHEMA)
