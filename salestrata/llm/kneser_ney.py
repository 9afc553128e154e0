"""A modified Kneser-Ney model of byte n-grams, counted by Spark.

N-grams are ``ORDER`` consecutive bytes of one text, in one model per language.
Their exact counts over all rows, the continuation counts of the lower orders,
the discounts and the interpolated probabilities are Spark aggregations.  The
finished tables are keyed by a 64-bit hash of language and n-gram, one to one within a
language, and grow with the corpus: no n-gram stands for another.

``fit`` gives all orders as arrays, for any text.  ``scores`` is for the texts that were
counted: each of their n-grams has its probability in the table of the highest order,
which is broadcast as far as ``HELD`` entries go, the most frequent first.  The
n-grams beyond are joined to the texts' distinct ones in Spark (``open_sums``).

An n-gram of two bytes or more that the whole corpus has once is counted, but
its probability is left to the lower order: it is no evidence about the one text
that holds it, which would otherwise be scored by itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from salestrata.llm.hash_table import SortedHashTable
from salestrata.llm.shared import cut, in_tasks, small_side
from salestrata.llm.textkit import BLOCK_BYTES, Texts, mix, overlapping, row_blocks, texts_of

ORDER = 4
# Entries of a table that a worker holds, 16 bytes each and a directory.
HELD = 1 << 22
BYTES = 256
UNIT = 1_000_000  # logarithms are kept as whole millionths
NO_LANGUAGE = "und"


def grams(texts: Texts, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of ``order`` bytes, earlier bytes in higher places, and how many each row has."""
    size = int(texts.offsets[-1])
    counts = np.maximum(np.diff(texts.offsets) - order + 1, 0)
    if size < order:
        return np.zeros(0, dtype=np.uint32), counts
    data = texts.data[:size].astype(np.uint32)
    packed = data[:size - order + 1].copy()
    for i in range(1, order):
        packed <<= np.uint32(8)
        packed |= data[i:size - order + 1 + i]
    inside = np.ones(len(packed), dtype=bool)
    for i in range(1, order):  # those that begin so near a row's end run into the next row
        edge = texts.offsets[1:-1] - i
        inside[edge[(edge >= 0) & (edge < len(packed))]] = False
    # a text shorter than the order lies between two edges and is covered by them
    return packed[inside], counts


def _language_codes(column) -> tuple[np.ndarray, list[str]]:
    coded = column.cast(pa.string()).fill_null(NO_LANGUAGE).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


def _counting(order: int, view: Callable[[Texts], Texts] | None):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _count_blocks(parts, order, view or (lambda texts: texts))
    return batches


def _count_blocks(batches: Iterator[pa.RecordBatch], order: int,
                  view: Callable[[Texts], Texts]) -> Iterator[pa.RecordBatch]:
    for block in row_blocks(batches, limit=BLOCK_BYTES):
        codes, names = _language_codes(block.column("lang"))
        for part in overlapping(view(texts_of(block.column("text"))), order - 1):
            packed, counts = grams(part, order)
            keyed = np.sort(packed.astype(np.uint64)
                            | np.repeat(codes.astype(np.uint64) << np.uint64(32), counts))
            first = np.flatnonzero(np.concatenate(([True], keyed[1:] != keyed[:-1]))) if len(keyed) else np.zeros(0, int)
            distinct = keyed[first]
            yield pa.RecordBatch.from_arrays([
                pa.array(names, pa.string()).take(pa.array(distinct >> np.uint64(32))),
                pa.array((distinct & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                pa.array(np.diff(np.append(first, len(keyed))).astype(np.int64)),
            ], names=["lang", "gram", "n"])


def count_grams(texts: DataFrame, order: int = ORDER, view: Callable[[Texts], Texts] | None = None) -> DataFrame:
    """``(lang, gram, n)``: exact counts over all rows of ``(lang, text)``.  Each
    block of rows, or part of a long text, is counted in its task first; only its sums are shuffled."""
    return (in_tasks(texts.select("lang", "text"), _counting(order, view), "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def _discounts(level: DataFrame) -> DataFrame:
    """The three discounts of a level per language, from its counts of counts; half
    the count where a small corpus lacks one of those."""
    of = [F.sum(F.when(F.col("n") == i, 1).otherwise(0)).cast("double").alias(f"t{i}")
          for i in (1, 2, 3, 4)]
    y = F.expr("if(t1 > 0, t1 / (t1 + 2 * t2), 0D)")
    whole = "least(t1, t2, t3, t4) > 0"
    discount = [F.expr(f"if({whole}, least(greatest({i} - {i + 1} * y * t{i + 1} / nullif(t{i}, 0), 0D), {i}D), {i} * 0.5D)")
                .alias(f"d{i}") for i in (1, 2, 3)]
    return level.groupBy("lang").agg(*of).withColumn("y", y).select("lang", *discount)


def _probabilities(level: DataFrame, lower: DataFrame | None, order: int) -> DataFrame:
    """``(lang, gram, n, own, context, p, rest)`` of the n-grams of ``order`` bytes; ``own``
    is whether the probability is its own, ``rest`` what its context leaves to the next lower order."""
    own = "seen > 1" if order > 1 else "true"
    discounted = (level.join(small_side(_discounts(level)), "lang")
                  .withColumn("own", F.expr(own))
                  .withColumn("left", F.expr("if(own, n - case when n = 1 then d1 when n = 2 then d2 else d3 end, 0D)"))
                  .withColumn("context", F.expr("gram >> 8")))
    contexts = discounted.groupBy("lang", "context").agg(
        F.sum("n").alias("total"), (1 - F.sum("left") / F.sum("n")).alias("rest"))
    joined = discounted.join(contexts, ["lang", "context"])
    if lower is None:
        below = joined.withColumn("below", F.lit(1.0 / BYTES))
    else:
        suffix = lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below"))
        places = F.lit((1 << (8 * (order - 1))) - 1)
        below = (joined.withColumn("suffix", F.col("gram").bitwiseAND(places))
                 .join(suffix, ["lang", "suffix"]))
    return below.select("lang", "gram", "n", "own", "context",
                        F.expr("left / total + rest * below").alias("p"), "rest")


@dataclass
class Model:
    """Per order from 1: the table of n-grams with their log probabilities; per
    context length from 0: the table of contexts with the log of what they leave."""

    grams: list[tuple[SortedHashTable, np.ndarray]]
    contexts: list[tuple[SortedHashTable, np.ndarray]]


def language_seeds(names: list[str]) -> np.ndarray:
    return np.array([(zlib.crc32(name.encode()) << 32) | zlib.adler32(name.encode()) for name in names],
                    dtype=np.uint64)


def hash_keys(packed: np.ndarray, length: int, seeds: np.ndarray) -> np.ndarray:
    """The 64-bit keys of n-grams of ``length`` bytes; ``seeds`` is their languages' seed."""
    return mix(packed.astype(np.uint64) ^ seeds ^ np.uint64(length << 61))


def _whole(logarithm: str):
    """A logarithm as a whole number, so that sums are the same in any order."""
    return F.round(F.col(logarithm) * UNIT).cast("int").alias(logarithm)


def _keyed(length: int):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            codes, names = _language_codes(part.column("lang"))
            seeds = language_seeds(names)[codes]
            keys = hash_keys(part.column("key").to_numpy(zero_copy_only=False), length, seeds)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), part.column("value")],
                                             names=["key", "value"])
    return batches


def _table(entries: DataFrame, length: int) -> tuple[SortedHashTable, np.ndarray]:
    """Entries ``(lang, key, value)`` as sorted arrays; logarithms as whole ``UNIT``-ths."""
    table = in_tasks(entries.select("lang", "key", _whole("value")), _keyed(length), "key long, value int").toArrow()
    keys, order = np.unique(table.column("key").to_numpy().view(np.uint64), return_index=True)
    return SortedHashTable(keys), table.column("value").to_numpy()[order]


def _levels(counted: DataFrame, order: int) -> Iterator[tuple[int, DataFrame]]:
    """The probabilities of each order, from the counts of the highest."""
    levels: list[DataFrame] = [cut(counted.withColumn("seen", F.col("n")))]
    for lower_order in range(order - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << (8 * lower_order)) - 1))
        levels.insert(0, cut(levels[0].groupBy("lang", suffix.alias("gram"))
                             .agg(F.count("*").alias("n"), F.sum("seen").alias("seen"))))
    lower = None
    for at, level in enumerate(levels, start=1):
        lower = cut(_probabilities(level, lower, at))
        yield at, lower


def fit(texts: DataFrame) -> Model:
    """The model of all rows of ``(lang, text)``."""
    model = Model([], [])
    for order, probabilities in _levels(count_grams(texts), ORDER):
        model.grams.append(_table(probabilities.where("own").select(
            "lang", F.col("gram").alias("key"), F.log("p").alias("value")), order))
        model.contexts.append(_table(probabilities.groupBy("lang", F.col("context").alias("key")).agg(
            F.log(F.greatest(F.max("rest"), F.lit(1e-12))).alias("value")), order - 1))
    return model


@dataclass
class Scores:
    """The log probabilities of all n-grams of the counted texts.  ``held`` is for the
    workers; the entries beyond it are ``(lang, gram, value)`` in ``beyond``, if there are any."""

    order: int
    held: tuple[SortedHashTable, np.ndarray]
    beyond: DataFrame | None


def scores(texts: DataFrame, order: int = ORDER, view: Callable[[Texts], Texts] | None = None,
           held: int = HELD) -> Scores:
    """The scores of all rows of ``(lang, text)``, seen through ``view`` if there is one."""
    for _, last in _levels(count_grams(texts, order, view), order):
        pass
    entries = last.select("lang", "gram", "n", F.log("p").alias("value"))
    # whole doublings of the count, at most 64 rows: the least count of which all n-grams fit
    sizes = {r["doublings"]: r["size"] for r in entries.groupBy(F.expr("int(floor(log2(n)))").alias("doublings"))
             .agg(F.count("*").alias("size")).collect()}
    least, room = 64, held
    while least and sizes.get(least - 1, 0) <= room:
        least -= 1
        room -= sizes.get(least, 0)
    often = F.expr("int(floor(log2(n)))") >= least
    table = _table(entries.where(often).withColumnRenamed("gram", "key"), order)
    return Scores(order, table, entries.where(~often).select("lang", "gram", _whole("value")) if least else None)


def _held_sums(order: int, held: tuple[SortedHashTable, np.ndarray], texts: Texts,
               seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per row the sum over the n-grams that are held and the number of all; then the others, row and
    n-gram in one number, and how often each is there."""
    packed, counts = grams(texts, order)
    table, values = held
    row = table.find(hash_keys(packed, order, np.repeat(seeds, counts)))
    missing = np.flatnonzero(row < 0)
    each = values[np.maximum(row, 0)] if len(values) else np.zeros(len(packed), dtype=np.int32)
    each[missing] = 0
    total = np.concatenate(([0], np.cumsum(each, dtype=np.int64)))
    last = np.cumsum(counts)
    owner = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)[missing]
    open_, times = np.unique(owner << np.uint64(32) | packed[missing].astype(np.uint64), return_counts=True)
    return total[last] - total[last - counts], counts, open_, times


def held_sums(order: int, held: tuple[SortedHashTable, np.ndarray], texts: Texts,
              seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
    """Per row: the sum over its n-grams that are held, in ``UNIT``-ths, the number of all its n-grams,
    and the others, each once: ``(gram, times)``.  A long text is the sum of its parts."""
    parts = [_held_sums(order, held, part, seeds) for part in overlapping(texts, order - 1)]
    total, counts = (sum(part[i] for part in parts) for i in (0, 1))
    if len(parts) == 1:
        _, _, open_, times = parts[0]
    else:
        open_, at = np.unique(np.concatenate([part[2] for part in parts]), return_inverse=True)
        times = np.zeros(len(open_), dtype=np.int64)
        np.add.at(times, at, np.concatenate([part[3] for part in parts]))
    offsets = np.searchsorted(open_ >> np.uint64(32), np.arange(len(counts) + 1, dtype=np.uint64)).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array((open_ & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                                        pa.array(times.astype(np.int64))], names=["gram", "times"])
    return total, counts, pa.ListArray.from_arrays(offsets, pairs)


OPEN = ArrayType(StructType([StructField("gram", LongType()), StructField("times", LongType())]))


def open_sums(rows: DataFrame, model: Scores) -> DataFrame:
    """``(row, found)``: the sums over the n-grams that are not held, of rows
    ``(row, lang, open)``.  No n-gram among them is frequent, so no key is hot."""
    return (rows.select("row", "lang", F.inline("open")).join(model.beyond, ["lang", "gram"])
            .groupBy("row").agg(F.sum(F.col("times") * F.col("value")).alias("found")))


def log_probabilities(model: Model, packed: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The log probability of each n-gram's last byte after the bytes before it."""
    result = np.zeros(len(packed), dtype=np.float32)
    open_ = None
    for order in range(ORDER, 0, -1):
        part = packed if open_ is None else packed[open_]
        seed = seeds if open_ is None else seeds[open_]
        table, values = model.grams[order - 1]
        row = table.find(hash_keys(part & np.uint32((1 << (8 * order)) - 1), order, seed))
        hit = row >= 0
        if open_ is None:
            result[hit] += values[row[hit]] / UNIT
            open_ = np.flatnonzero(~hit)
        else:
            result[open_[hit]] += values[row[hit]] / UNIT
            open_ = open_[~hit]
        if not len(open_):
            return result
        context, rest = model.contexts[order - 1]
        before = (packed[open_] >> np.uint32(8)) & np.uint32((1 << (8 * (order - 1))) - 1)
        row = context.find(hash_keys(before, order - 1, seeds[open_]))
        result[open_] += np.where(row >= 0, rest[np.maximum(row, 0)] / UNIT if len(rest) else 0, 0)
    result[open_] -= np.float32(np.log(BYTES))
    return result
