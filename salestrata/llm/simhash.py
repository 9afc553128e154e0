"""Operator 5, SimHash near-duplicates by deletion-variant signatures.

A text's fingerprint has a bit set where over half of the hashes of its
``SHINGLE``-word shingles have it.  Two texts are linked if their fingerprints differ in at
most ``MAX_DISTANCE`` bits; a component is what links connect.

Search: a fingerprint is cut into three segments.  Four differing bits leave one
segment with one at most, so two linked fingerprints have a segment whose
variants, each with one bit left out, share a value.  Every distinct fingerprint
is indexed under its 64 variants; equal variants meet in one group and are
verified on all 64 bits.  A group of at most ``GROUP`` fingerprints is compared at once; a
larger one is dealt out as pairs of chunks of that size, so no task holds more
than two chunks.  A group yields the links that connect it, not all its pairs,
and equal texts meet as one fingerprint before any of this.  Components come from
alternating star contractions over the links, in tables, with no collected groups.

Null and empty texts have fingerprint zero, linked like any other.  A null
doc_id is a document like others, but never names a component that has an id.
Repeated rows share fingerprint and component and are returned once per row.
Other columns are not looked at.  An empty table gives an empty result.  A text of any length
is printed whole in one task, ``_HASHES`` shingles at a time; it takes some twelve times its size there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from salestrata.llm.shared import columns, cut, in_tasks
from salestrata.llm.textkit import NON_SPACE, Texts, Words, row_blocks, texts_of, words_of

SHINGLE = 4
SEED = 42
MAX_DISTANCE = 4
# (lowest bit, bits): half as many segments as differing bits, rounded up, plus one
SEGMENTS = ((0, 22), (22, 21), (43, 21))
GROUP = 2048
# Shingles of a text whose hashes are held at a time.
_HASHES = 1 << 16
# Links within groups up to this size are all compared by shifting the rows.
_SHIFTS = 16


def fingerprint(words: bytes, starts: np.ndarray, ends: np.ndarray) -> int:
    """The fingerprint of a text given as its words joined by single spaces.  The bits of ``_HASHES``
    shingles are added up at a time."""
    if not len(starts):
        return 0
    count = max(len(starts) - SHINGLE, 0) + 1
    ends = ends[min(SHINGLE, len(ends)) - 1:]
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, dtype=np.int64)
    for low in range(0, count, _HASHES):
        high = min(low + _HASHES, count)
        hashes = np.array([digest(words[a:b], SEED)
                           for a, b in zip(starts[low:high].tolist(), ends[low:high].tolist())], dtype="<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > count, bitorder="little").view("<u8")[0])


def _joined(texts: Texts, words: Words, row: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """A text's words joined by single spaces, and where each begins and ends there."""
    first, last = words.first[row], words.first[row + 1]
    starts, lengths = words.starts[first:last], words.ends[first:last] - words.starts[first:last]
    ends = np.cumsum(lengths + 1) - 1
    if not len(starts):
        return b"", starts, ends
    begin, end = int(starts[0]), int(words.ends[last - 1])
    part = texts.data[begin:end].copy()
    kept = NON_SPACE[part]
    gaps = words.ends[first:last - 1] - begin  # the first space after each word stays, as 0x20
    part[gaps] = 0x20
    kept[gaps] = True
    return part[kept].tobytes(), ends - lengths, ends


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches' other columns with the fingerprint of ``text``."""
    for block in row_blocks(batches):
        texts = texts_of(block.column("text"), lower=True)
        words = words_of(texts, NON_SPACE)
        values = np.array([fingerprint(*_joined(texts, words, row)) for row in range(len(texts))], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([block.column(0), pa.array(values.view(np.int64))],
                                         names=[block.schema.names[0], "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint)`` as a signed 64-bit value, one row per document."""
    return in_tasks(docs.select(F.col("doc_id").cast("long"), "text"), _fingerprints,
                    "doc_id long, fingerprint long")


def variants(distinct: DataFrame) -> DataFrame:
    """``(key, side, fingerprint)``: the 64 one-wildcard variants of each.  ``side``
    is the bit left out; the variant of a segment's first bit also stands for the
    whole segment, so its side is null: there all pairs count, elsewhere only
    those that differ in the bit."""
    positions = [(low, bits, bit) for low, bits in SEGMENTS for bit in range(bits)]
    table = F.array(*[F.struct(F.lit(low).alias("low"), F.lit((1 << bits) - 1).cast("long").alias("mask"),
                               F.lit(bit).alias("bit"), F.lit(index).alias("index"))
                      for index, (low, bits, bit) in enumerate(positions)])
    rows = distinct.select("fingerprint", F.explode(table).alias("at"))
    segment = F.expr("shiftrightunsigned(fingerprint, at.low) & at.mask")
    return rows.select("fingerprint", "at", segment.alias("segment")).selectExpr(
        "cast(at.index as long) << 22 | (segment & ~shiftleft(1L, at.bit)) as key",
        "if(at.bit = 0, null, cast(shiftright(segment, at.bit) & 1 as int)) as side", "fingerprint")


def hot_groups(distinct: DataFrame, group: int) -> DataFrame:
    """``(hot, chunks)`` for the variants that may gather more than ``group``
    fingerprints: segment values are counted first, three rows per fingerprint, and
    a variant gathers the fingerprints of two values."""
    parts = F.explode(F.array(*[
        F.struct(F.lit(number).alias("number"),
                 F.expr(f"shiftrightunsigned(fingerprint, {low}) & {(1 << bits) - 1}L").alias("segment"))
        for number, (low, bits) in enumerate(SEGMENTS)]))
    values = (distinct.select(parts.alias("part")).groupBy("part.number", "part.segment")
              .agg(F.count("*").alias("n")).where(F.col("n") > group // 2))
    first = [sum(bits for _, bits in SEGMENTS[:i]) for i in range(len(SEGMENTS))]
    index = " ".join(f"when {i} then {at}" for i, at in enumerate(first))
    bits = " ".join(f"when {i} then {n - 1}" for i, (_, n) in enumerate(SEGMENTS))
    return (values.selectExpr("number", "segment", "n",
                              f"explode(sequence(0, case number {bits} end)) as bit")
            .selectExpr(f"cast(bit + case number {index} end as long) << 22"
                        " | (segment & ~shiftleft(1L, bit)) as hot", "n")
            .groupBy("hot").agg(F.sum("n").alias("n"))
            .selectExpr("hot", f"cast(1 + (n + {group // 2}) div {group} as int) as chunks"))


def dealt(indexed: DataFrame, hot: DataFrame) -> DataFrame:
    """The index with the groups of ``hot`` dealt out as pairs of chunks: each
    fingerprint goes to the pairs that its chunk is part of."""
    joined = indexed.join(hot, F.col("key") == F.col("hot"), "left")
    chunk = "cast(pmod(xxhash64(fingerprint), chunks) as int)"
    pairs = f"transform(sequence(0, chunks - 1), c -> least(c, {chunk}) * 65536L * 32768L + greatest(c, {chunk}))"
    return joined.selectExpr("key", f"explode(if(chunks is null, array(0L), {pairs})) as part",
                             "side", "fingerprint")


def _linked(keys: np.ndarray, sides: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal keys: all of those in small runs, and enough to
    connect what is connected in large ones."""
    size = len(keys)
    begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    lengths = np.diff(np.append(begins, size))
    found_a, found_b = [], []
    left = np.repeat(lengths, lengths) - (np.arange(size) - np.repeat(begins, lengths))  # rows to the run's end
    small = np.repeat(lengths <= _SHIFTS, lengths)
    for shift in range(1, min(_SHIFTS, int(lengths.max(initial=1)))):
        a = np.flatnonzero(small & (left > shift))
        b = a + shift
        ok = _is_link(sides[a], sides[b], prints[a], prints[b], distance)
        found_a.append(prints[a[ok]])
        found_b.append(prints[b[ok]])
    for begin, length in zip(begins[lengths > _SHIFTS], lengths[lengths > _SHIFTS]):
        a, b = _connecting(prints[begin:begin + length], sides[begin:begin + length], distance)
        found_a.append(a)
        found_b.append(b)
    none = np.zeros(0, dtype=np.uint64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def _is_link(side_a, side_b, a, b, distance: int) -> np.ndarray:
    return (((side_a != side_b) | (side_a < 0)) & (a != b)
            & (np.bitwise_count(a ^ b) <= distance))


def _connecting(prints: np.ndarray, sides: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of one group: rows are reached one by one from
    the reached ones, and a reached row is compared with the unreached only."""
    waiting = np.arange(len(prints))
    a, b = [], []
    while len(waiting):
        reached, waiting = [waiting[0]], waiting[1:]
        while reached and len(waiting):
            row = reached.pop()
            near = _is_link(sides[row], sides[waiting], prints[row], prints[waiting], distance)
            new = waiting[near]
            if len(new):
                a.append(np.full(len(new), prints[row]))
                b.append(prints[new])
                reached.extend(new.tolist())
                waiting = waiting[~near]
    none = np.zeros(0, dtype=np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _links_of_sorted(distance: int):
    """Tasks over rows sorted by group; a group may run over several batches."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(keys, sides, prints):
            a, b = _linked(keys, sides, prints, distance)
            low, high = np.minimum(a, b).view(np.int64), np.maximum(a, b).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], names=["a", "b"])

        held = None
        for part in parts:
            if not part.num_rows:
                continue
            # the two halves of a group name as one value: equal neighbours are all that matters
            key = np.rec.fromarrays([part.column("key").to_numpy(), part.column("part").to_numpy()])
            new = [key, part.column("side").fill_null(-1).to_numpy(),
                   part.column("fingerprint").to_numpy().view(np.uint64)]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            last = len(held[0]) - int(np.argmax(held[0][::-1] != held[0][-1])) if (held[0] != held[0][-1]).any() else 0
            if last:
                yield answer(*[x[:last] for x in held])
                held = [x[last:] for x in held]
        if held is not None:
            yield answer(*held)
    return batches


def links(distinct: DataFrame, distance: int = MAX_DISTANCE, group: int = GROUP) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints that connect all that are linked."""
    if not 0 <= distance <= MAX_DISTANCE:
        raise ValueError(f"the segments are cut for up to {MAX_DISTANCE} differing bits")
    indexed = variants(distinct)
    hot = cut(hot_groups(distinct, group))
    indexed = (indexed.selectExpr("key", "0L as part", "side", "fingerprint") if hot.isEmpty()
               else dealt(indexed, hot))
    grouped = indexed.repartition("key", "part").sortWithinPartitions("key", "part")
    return in_tasks(grouped, _links_of_sorted(distance), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for the nodes of ``(a, b)``: each root is its component's least
    node.  Alternating large-star and small-star steps until nothing changes."""
    def both(e: DataFrame) -> DataFrame:
        return e.select("a", "b").union(e.select("b", "a"))

    def star(e: DataFrame, larger: bool) -> DataFrame:
        near = both(e) if larger else e.selectExpr("greatest(a, b) as a", "least(a, b) as b")
        # kept, so that the join deals both sides out and splits the root of a large component
        least = cut(near.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a as of", "least(a, m) as m"))
        joined = near.join(least, F.col("a") == F.col("of"))
        if larger:
            moved = joined.where("b > a").selectExpr("b as a", "m as b")
        else:
            moved = joined.where("b > m").selectExpr("b as a", "m as b").union(
                least.selectExpr("of as a", "m as b"))
        return moved.where("a <> b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")),
                           F.sum(F.shiftright(F.xxhash64("b", "a"), 32))).first())

    current = cut(edges.selectExpr("greatest(a, b) as a", "least(a, b) as b").where("a <> b").distinct())
    seen = state(current)
    while seen[0]:
        current = cut(star(star(current, larger=True), larger=False))
        now = state(current)
        if now == seen:
            break
        seen = now
    return current.selectExpr("a as node", "b as root")


def near_duplicates(docs: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """``(doc_id, fingerprint, component_id, component)``, one row per document; the
    last is the least fingerprint of the component as a signed number."""
    prints = cut(fingerprints(docs))
    distinct = cut(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    found = components(links(distinct.select("fingerprint"), distance))
    rooted = (distinct.join(found, F.col("fingerprint") == F.col("node"), "left")
              .select("fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")))
    # Kept, so that the join below deals its own sides out and a large component can be split.
    named = cut(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    of_print = rooted.join(named, "root").select(F.col("fingerprint").alias("of_print"),
                                                 "component_id", F.col("root").alias("component"))
    return (prints.join(of_print, F.col("fingerprint") == F.col("of_print"))
            .select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                    "component_id", "component"))


def keep_one(docs: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """One document of each component with all its columns: the one with the
    smallest id, and of rows with that same id, or of rows in a component without
    ids, the least by their columns."""
    found = cut(near_duplicates(docs, distance))
    heads = found.where("doc_id <=> component_id")
    repeated = cut(found.where("doc_id is not null").groupBy(F.col("doc_id").alias("of_id")).agg(F.count("*").alias("n"))
                   .where("n > 1").select("of_id"))
    whole = docs.select(F.struct(*columns(docs.columns)).alias("row"))
    own_id = F.col("row.doc_id").cast("long")
    once = heads.where("doc_id is not null").join(repeated, F.col("doc_id") == F.col("of_id"), "left_anti")
    result = whole.join(once.select("doc_id"), own_id == F.col("doc_id"), "left_semi")
    # Rows that their id does not tell apart are told apart by their fingerprint.
    unclear = heads.where("doc_id is null").union(heads.join(repeated, F.col("doc_id") == F.col("of_id"), "left_semi"))
    if unclear.isEmpty():
        return result.select("row.*")
    some = whole.where("row.doc_id is null").union(whole.join(repeated, own_id == F.col("of_id"), "left_semi"))
    printed = in_tasks(some.select("row", "row.text"), _fingerprints,
                       StructType([StructField("row", docs.schema), StructField("fingerprint", LongType())]))
    least = F.min("row").alias("row")
    printed = printed.groupBy("fingerprint", F.col("row.doc_id").cast("long").alias("own_id")).agg(least)
    of_print = unclear.select(F.conv("fingerprint", 16, -10).cast("long").alias("of_print"), "doc_id", "component").distinct()
    chosen = printed.join(of_print, (F.col("fingerprint") == F.col("of_print"))
                          & F.col("own_id").eqNullSafe(F.col("doc_id"))).groupBy("component").agg(least)
    return result.union(chosen.select("row")).select("row.*")
