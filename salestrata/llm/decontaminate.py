"""Operator 9, benchmark decontamination by a prefix-filtered set join.

Words are runs of ASCII letters and digits and of non-ASCII characters, with A-Z
lowered.  A window is ``WINDOW`` consecutive words of a benchmark item, or all
words of a shorter one.  A document word is hit if it lies in an occurrence of a
window.

Join: a window is the set of its ``SHINGLE``-word shingles.  An occurrence holds
all of them, so the necessary prefix is one shingle, and the rarest, by its count over all
documents, makes the fewest candidates.  A document's shingles meet the prefixes
by equality; a candidate must leave room for the window in front of and behind
the shingle within the document (position and length), must have the window's
hash, and is then compared word by word.

The windows are written once, and the shingles of all of them counted in the documents,
``COUNTED`` in a pass.  A benchmark of at most ``BLOCK`` (window, item) pairs is one index, sent to the
tasks.  A larger one is cut into blocks of about that size.  The documents are then written once with a
number; each block is a pass of its own that writes its hits, and its index is let go before the next is
made, so a worker holds one at a time.  The hits of all passes are joined to the documents by their number.

A null or empty text has no words and no hits.  An item with null or empty text has
no window; one without an id makes hits but is not listed.  Repeated items count
once, repeated documents each.  Other columns are not looked at.  Without
benchmark items nothing is hit; without documents the result is empty.  A long text takes some
fifteen times its size in a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from salestrata.llm.shared import columns, cut, in_tasks, stored
from salestrata.llm.textkit import (
    ALNUM,
    Texts,
    Words,
    row_blocks,
    row_sums,
    span_hashes,
    texts_of,
    window_hashes,
    words_of,
)

WINDOW = 10
SHINGLE = 5
BLOCK = 200_000
COUNTED = 1 << 22
_FILTER_BITS = 20


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``(window, item)``, distinct: windows as words joined by a space, ids as text."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.expr(r"filter(split(lowered, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', -1), w -> w <> '')")
    worded = (benchmark.select(F.col("item_id").cast("string").alias("item"), lowered.alias("lowered"))
              .select("item", words.alias("words")).where("size(words) > 0"))
    starts = F.explode(F.expr(f"sequence(1, greatest(size(words) - {WINDOW - 1}, 1))")).alias("start")
    return worded.select("item", "words", starts).select(
        F.expr(f"array_join(slice(words, start, {WINDOW}), ' ')").alias("window"), "item").distinct()


@dataclass
class Index:
    """The windows of a block, and the rows (window, offset) under each prefix shingle.

    ``lengths`` and ``hashes`` are by window; ``shingles[n]`` holds, for the
    windows whose shingles have n words, the sorted prefix hashes, the windows and
    the offsets.
    """

    windows: list[bytes]
    items: list[list[str]]
    lengths: np.ndarray
    hashes: np.ndarray
    shingles: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def _parsed(column) -> tuple[Texts, Words, np.ndarray]:
    texts = texts_of(column, lower=True)
    words = words_of(texts, ALNUM)
    return texts, words, span_hashes(texts.data, words.starts, words.ends)


class _Member:
    """Whether values are in a set: a bit table first, then the sorted values."""

    def __init__(self, values: np.ndarray):
        self.values = values  # sorted, distinct
        self.bits = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.bits[values & np.uint64((1 << _FILTER_BITS) - 1)] = True

    def rows(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``wanted`` that are in the set, and the row of each in ``values``."""
        at = np.flatnonzero(self.bits[wanted & np.uint64((1 << _FILTER_BITS) - 1)])
        row = np.minimum(np.searchsorted(self.values, wanted[at]), len(self.values) - 1)
        hit = self.values[row] == wanted[at]
        return at[hit], row[hit]


def _window_shingles(windows: list[str]) -> tuple[np.ndarray, np.ndarray, dict[int, tuple]]:
    """Lengths and hashes of the windows; by shingle length, the hash, window and
    offset of every shingle."""
    _, words, hashes = _parsed(pa.array(windows, pa.large_string()))
    lengths = np.diff(words.first)
    of_window = np.zeros(len(windows), dtype=np.uint64)
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        of_window[rows] = window_hashes(hashes, int(n))[words.first[rows]]
    shingles = {}
    sizes = np.minimum(lengths, SHINGLE)
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        per_row = lengths[rows] - n + 1
        window = np.repeat(rows, per_row)
        offset = np.arange(len(window)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        shingles[int(n)] = (window_hashes(hashes, int(n))[words.first[window] + offset], window, offset)
    return lengths, of_window, shingles


def _inside_row(words: Words, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of the positions whose n words lie in one row, as a mask, and all rows."""
    row = np.searchsorted(words.first, at, side="right") - 1
    return at + n <= words.first[row + 1], row


def _shingle_counts(wanted: dict[int, np.ndarray]):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = {n: _Member(values) for n, values in wanted.items()}
        counts = {n: np.zeros(len(values), dtype=np.int64) for n, values in wanted.items()}
        for block in row_blocks(parts):
            _, words, hashes = _parsed(block.column("text"))
            for n, member in members.items():
                at, row = member.rows(window_hashes(hashes, n))
                inside, _ = _inside_row(words, at, n)
                counts[n] += np.bincount(row[inside], minlength=len(member.values))
        for n, count in counts.items():
            seen = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen), n, dtype=np.int32)),
                 pa.array(wanted[n][seen].view(np.int64)), pa.array(count[seen])],
                names=["length", "shingle", "n"])
    return batches


def _shingle_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        _, _, shingles = _window_shingles(part.column("window").to_pylist())
        for n, (values, _, _) in shingles.items():
            distinct = np.unique(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(distinct), n, dtype=np.int32)),
                                              pa.array(distinct.view(np.int64))], names=["length", "shingle"])


def _shingles(windows: DataFrame) -> DataFrame:
    return in_tasks(windows.select("window"), _shingle_rows, "length int, shingle long").distinct()


def shingle_counts(windows: DataFrame, docs: DataFrame, at_once: int = COUNTED) -> DataFrame:
    """``(length, shingle, n)``: how often the shingles of the windows stand in the documents, if they do."""
    wanted = cut(_shingles(windows))
    passes = max(-(-wanted.count() // at_once), 1)
    counted = []
    for number in range(passes):
        rows = wanted.where(f"pmod(xxhash64(length, shingle), {passes}) = {number}").toArrow()
        lengths, values = rows.column("length").to_numpy(), rows.column("shingle").to_numpy().view(np.uint64)
        by_length = {int(n): np.sort(values[lengths == n]) for n in np.unique(lengths)}
        counted.append(cut(in_tasks(docs.select("text"), _shingle_counts(by_length), "length int, shingle long, n long")
                           .groupBy("length", "shingle").agg(F.sum("n").alias("n"))))
    return reduce(DataFrame.union, counted)


def index_of(rows: DataFrame, counts: DataFrame) -> Index:
    """The index of a block of (window, item) rows, prefixes by rarity."""
    by_window: dict[str, list[str]] = {}
    for window, item in rows.collect():
        by_window.setdefault(window, []).extend([] if item is None else [item])
    windows = sorted(by_window)
    lengths, hashes, shingles = _window_shingles(windows)
    wanted = {n: np.unique(values) for n, (values, _, _) in shingles.items()}
    # As many rows as the block has distinct shingles, at most.
    counted = counts.join(_shingles(rows), ["length", "shingle"]).toArrow()
    prefixes = {}
    for n, (values, window, offset) in shingles.items():
        here = counted.filter(pa.compute.equal(counted.column("length"), n))
        frequency = np.zeros(len(wanted[n]), dtype=np.int64)
        frequency[np.searchsorted(wanted[n], here.column("shingle").to_numpy().view(np.uint64))] = here.column("n").to_numpy()
        rarity = frequency[np.searchsorted(wanted[n], values)]
        order = np.lexsort((offset, rarity, window))
        first = order[np.concatenate(([True], window[order][1:] != window[order][:-1]))]
        first = first[np.argsort(values[first], kind="stable")]
        prefixes[n] = (values[first], window[first], offset[first])
    return Index([w.encode() for w in windows], [by_window[w] for w in windows], lengths, hashes, prefixes)


def _occurrences(index: Index, members: dict[int, _Member], texts: Texts, words: Words,
                 hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(start, window)``: verified occurrences in a block of documents."""
    starts, found = [], []
    windows_of = {}
    for n, member in members.items():
        values, window, offset = index.shingles[n]
        at, row = member.rows(window_hashes(hashes, n))
        inside, _ = _inside_row(words, at, n)
        at, key = at[inside], member.values[row[inside]]
        low, high = np.searchsorted(values, key, "left"), np.searchsorted(values, key, "right")
        entry = np.repeat(low, high - low) + _ramp(high - low)
        at = np.repeat(at, high - low)
        start, candidate = at - offset[entry], window[entry]
        length = index.lengths[candidate]
        of_row = np.searchsorted(words.first, at, side="right") - 1
        fits = (start >= words.first[of_row]) & (start + length <= words.first[of_row + 1])
        start, candidate, length = start[fits], candidate[fits], length[fits]
        for size in np.unique(length):
            if size not in windows_of:
                windows_of[size] = window_hashes(hashes, int(size))
            rows = np.flatnonzero(length == size)
            same = rows[windows_of[size][start[rows]] == index.hashes[candidate[rows]]]
            exact = [i for i in same.tolist() if index.windows[candidate[i]] == _joined(
                texts, words, int(start[i]), int(size))]
            starts.append(start[exact])
            found.append(candidate[exact])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *starts]), np.concatenate([none, *found])


def _joined(texts: Texts, words: Words, start: int, n: int) -> bytes:
    return b" ".join([texts.data[a:b].tobytes() for a, b in
                      zip(words.starts[start:start + n].tolist(), words.ends[start:start + n].tolist())])


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. up to each count."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


_SPANS = ArrayType(StructType([StructField("first", LongType()), StructField("end", LongType())]))


def _matching(broadcast):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = broadcast.value
        members = {n: _Member(np.unique(values)) for n, (values, _, _) in index.shingles.items()}
        for block in row_blocks(parts):
            texts, words, hashes = _parsed(block.column("text"))
            start, window = _occurrences(index, members, texts, words, hashes)
            change = np.zeros(len(hashes) + 1, dtype=np.int64)
            np.add.at(change, start, 1)
            np.add.at(change, start + index.lengths[window], -1)
            hit = np.cumsum(change[:-1]) > 0
            row = np.searchsorted(words.first, start, side="right") - 1
            items: list[set[str]] = [set() for _ in range(block.num_rows)]
            for r, w in zip(row.tolist(), window.tolist()):
                items[r].update(index.items[w])
            yield pa.RecordBatch.from_arrays(
                [block.column("document"), pa.array(np.diff(words.first).astype(np.int64)), _runs(hit, words.first),
                 pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                names=["document", "n_words", "spans", "items"])
    return batches


def _runs(hit: np.ndarray, first: np.ndarray) -> pa.Array:
    """Runs of hit words per row, positions within the row."""
    edge = np.zeros(len(hit) + 1, dtype=bool)
    edge[first] = True
    before = np.concatenate(([False], hit[:-1])) if len(hit) else hit
    after = np.concatenate((hit[1:], [False])) if len(hit) else hit
    begins = np.flatnonzero(hit & (~before | edge[:-1]))
    ends = np.flatnonzero(hit & (~after | edge[1:])) + 1
    row = np.searchsorted(first, begins, side="right") - 1
    offsets = np.searchsorted(begins, first).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(begins - first[row]), pa.array(ends - first[row])],
                                       names=["first", "end"])
    return pa.ListArray.from_arrays(offsets, spans)


def _word_counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in row_blocks(parts):
        counts = np.diff(words_of(texts_of(block.column("text")), ALNUM).first)
        yield pa.RecordBatch.from_arrays([block.column("document"), pa.array(counts.astype(np.int64))],
                                         names=["document", "n_words"])


def _put_together(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of several passes over a document as runs of hit words, its items once."""
    for part in parts:
        spans, items = [], []
        for row in part.select(["spans", "items"]).to_pylist():
            runs: list[list[int]] = []
            for first, end in sorted((s["first"], s["end"]) for s in row["spans"]):
                if runs and first <= runs[-1][1]:
                    runs[-1][1] = max(end, runs[-1][1])
                else:
                    runs.append([first, end])
            spans.append([{"first": a, "end": b} for a, b in runs])
            items.append(sorted(set(row["items"])))
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([part.column("number"), pa.array(spans, kind), pa.array(items, pa.list_(pa.string()))],
                                         names=["number", "spans", "items"])


def _matched(rows: DataFrame, document: StructField, index) -> DataFrame:
    """``(document, n_words, spans, items)`` of rows ``(document, text)`` against one index."""
    return in_tasks(rows, _matching(index), StructType([
        document, StructField("n_words", LongType()), StructField("spans", _SPANS), StructField("items", ArrayType(StringType()))]))


def hits(docs: DataFrame, benchmark: DataFrame, carry: list[str], block: int = BLOCK) -> DataFrame:
    """``(document struct of the carried columns, n_words, spans, items)`` per row;
    spans are runs of hit words, items the distinct ids of the occurring windows."""
    spark = docs.sparkSession
    windows = cut(benchmark_windows(benchmark))
    blocks = -(-windows.count() // block)
    document = StructField("document", docs.select(*columns(carry)).schema)
    whole = docs.select(F.struct(*columns(carry)).alias("document"), "text")
    no_hits = F.array().cast(_SPANS).alias("spans"), F.array().cast("array<string>").alias("items")
    words = StructType([document, StructField("n_words", LongType())])
    if not blocks:
        return in_tasks(whole, _word_counts, words).select("*", *no_hits)
    counts = shingle_counts(windows, docs)
    if blocks == 1:
        return _matched(whole, document, spark.sparkContext.broadcast(index_of(windows, counts)))
    whole = stored(whole.withColumn("number", F.monotonically_increasing_id()), "numbered")
    found = []
    for number in range(blocks):
        index = spark.sparkContext.broadcast(index_of(windows.where(f"pmod(xxhash64(window), {blocks}) = {number}"), counts))
        own = _matched(whole.select(F.col("number").alias("document"), "text"), StructField("document", LongType()), index)
        found.append(cut(own.where("size(spans) > 0").drop("n_words")))
        index.unpersist()
    together = reduce(DataFrame.union, found).groupBy(F.col("document").alias("number")).agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    hit = in_tasks(together, _put_together, StructType([StructField("number", LongType()), StructField("spans", _SPANS),
                                                        StructField("items", ArrayType(StringType()))]))
    numbered = whole.select(F.struct("document", "number").alias("document"), "text")
    counted = in_tasks(numbered, _word_counts, StructType([StructField("document", numbered.schema["document"].dataType),
                                                           StructField("n_words", LongType())]))
    return counted.select("document.*", "n_words").join(hit, "number", "left").select(
        "document", "n_words", *[F.coalesce(name, empty).alias(name) for name, empty in zip(("spans", "items"), no_hits)])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, hit words, the items that occur, the spans."""
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.first)")
    return hits(docs, benchmark, ["doc_id"]).select(
        "document.doc_id", "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.array_sort("items").alias("items"), (F.size("spans") > 0).alias("contaminated"), "spans")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit, with all their columns."""
    return hits(docs, benchmark, docs.columns).where("size(spans) = 0").select("document.*")
