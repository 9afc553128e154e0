"""Operator 12, the prefix trie of conversations from vertical bitmaps.

A node stands for a distinct sequence of first turns (role, text); the root for none.
Its members are the conversations that begin with it.

Turns are hashed to 128 bits and numbered.  A conversation is cut into pieces of ``BLOCK``
positions, and the pieces of one block of positions into shards of whole conversations, in
ranges of conv_id.  A shard is indexed vertically: (position, turn) to the bitset of its
conversations, the end of a conversation being a turn of its own.  From the root (in later
blocks from the nodes that the pieces go on from) the bitset of a node is intersected depth first with
the postings of the next position: what is left is a child, its popcount the members, and
the intersection with the posting of the end the list of conversations that end there.

Shards share nodes, so Spark sums them up by the node's key, the exclusive or of the
hashes of its (position, turn) pairs.  The conversation that gives a node its name has it in one
shard only.  There its weight is added to the nodes above it; those partial sums are
summed up again.  What later blocks hold is added to the last node of a piece.  A shard has at
most ``SHARD`` turns, or one piece, whatever the length of a conversation
and however many begin alike.

Turns are in order of turn (null first), then role, then the hash of role and text.  Null roles and
texts are empty.  Rows without a conv_id belong to no conversation.  Repeated rows are
turns each, other columns are not looked at, long texts are only hashed and counted in the
JVM, and an empty table gives an empty result, without a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salestrata.llm.shared import cut, in_tasks, stored

BLOCK = 256
SHARD = 1 << 15
SHARD_CONVERSATIONS = 1 << 11
END = -1  # in place of the number of words, for the row behind a conversation's last turn

_TURNS = "conv_id long, part int, local long, t1 long, t2 long, words long"
_NODES = ("shard long, node int, parent int, k1 long, k2 long, depth long, conv_id long, n long, "
          "words long, branches boolean, first_end long, ends string")
_SUMS = ("k1 long, k2 long, depth long, conv_id long, n_convs long, parent_conv_id long, "
         "n_children long, n_leaves long, saved_tokens long")


def _numbering(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The place of each row among those of its conversation in this task."""
    part, conv, seen = TaskContext.get().partitionId(), None, 0
    for rows in parts:
        if not rows.num_rows:
            continue
        ids = rows.column("conv_id").to_numpy()
        begins = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        local = np.arange(len(ids)) - np.repeat(begins, np.diff(np.append(begins, len(ids))))
        if ids[0] == conv:
            local[:(begins[1] if len(begins) > 1 else len(ids))] += seen
        conv, seen = ids[-1], int(local[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [rows.column("conv_id"), pa.array(np.full(len(ids), part, np.int32)), pa.array(local),
             rows.column("t1"), rows.column("t2"), rows.column("words")],
            names=["conv_id", "part", "local", "t1", "t2", "words"])


def turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, position, t1, t2, words)``: the turns numbered from 1, hashed, and how many words each has."""
    spark = conversations.sparkSession
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).where("conv_id is not null").select(
        "conv_id", "turn", "role", F.xxhash64("role", "text").alias("t1"),
        F.xxhash64(F.lit(1), "text", "role").alias("t2"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    order = ["conv_id", "turn", "role", "t1", "t2"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    found = stored(in_tasks(sorted_rows.select("conv_id", "t1", "t2", "words"), _numbering, _TURNS), "turns")
    # A conversation lies in several tasks only as the last or first of them: two rows a task at most.
    edges = found.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high"))
    spread = (edges.select(F.explode(F.array_distinct(F.array("low", "high"))).alias("conv_id"), "part")
              .groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select("conv_id"))
    sizes = found.join(F.broadcast(spread), "conv_id").groupBy("conv_id", "part").agg(F.count("*").alias("n")).collect()
    offsets, before = [], {}
    for row in sorted(sizes, key=lambda r: (r["conv_id"], r["part"])):
        offsets.append((row["conv_id"], row["part"], before.get(row["conv_id"], 0)))
        before[row["conv_id"]] = before.get(row["conv_id"], 0) + row["n"]
    position = "local + 1"
    if offsets:
        shifts = spark.createDataFrame(offsets, "conv_id long, part int, shift long")
        found, position = found.join(F.broadcast(shifts), ["conv_id", "part"], "left"), "local + 1 + coalesce(shift, 0)"
    return found.selectExpr("conv_id", f"{position} as position", "t1", "t2", "words")


def _end_rows(sizes: DataFrame, size: str) -> DataFrame:
    return sizes.selectExpr("conv_id", f"{size} + 1 as position", "0L as t1", "0L as t2", f"cast({END} as long) as words")


def with_ends(turns: DataFrame) -> DataFrame:
    """The turns, and a row behind the last one of each conversation: what ``prefix_trie`` takes."""
    return turns.union(_end_rows(turns.groupBy("conv_id").agg(F.max("position").alias("n")), "n"))


def regrafted(turns: DataFrame, every: int, most: int) -> DataFrame:
    """The same for rebuilt conversations: c's first h turns are replaced by those of
    ``c - c % every``, as far as it has them; h is ``crc32(c) % most``."""
    heads = (turns.where(f"position < {most} and conv_id % {every} = 0").groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("position", "t1", "t2", "words"))).alias("head"))
             .withColumnRenamed("conv_id", "of"))  # at most ``most - 1`` turns each
    own = (turns.groupBy("conv_id").agg(F.max("position").alias("n_own"))
           .selectExpr("conv_id", "n_own", f"conv_id - conv_id % {every} as base",
                       f"cast(crc32(cast(cast(conv_id as string) as binary)) % {most} as int) as h"))
    grafts = cut(own.join(heads, F.col("base") == F.col("of"), "left").selectExpr(
        "conv_id", "n_own", "h", "if(of is null, slice(array(struct(0L as position, 0L as t1, 0L as t2, 0L as words)), 1, 0),"
        " slice(head, 1, h)) as head"))
    taken = grafts.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*")
    kept = (turns.join(grafts.selectExpr("conv_id", "h", "size(head) as n_head"), "conv_id").where("position > h")
            .selectExpr("conv_id", "position - h + n_head as position", "t1", "t2", "words"))
    return taken.union(kept).union(_end_rows(grafts, "size(head) + greatest(n_own - h, 0)"))


def _codes(*keys: np.ndarray) -> np.ndarray:
    """Equal numbers for rows that are equal in all keys."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), dtype=bool)
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    codes = np.empty(len(order), dtype=np.int64)
    codes[order] = np.cumsum(new)
    return codes


def _bitsets(codes: np.ndarray, members: np.ndarray) -> list[int]:
    sets = [0] * (int(codes.max(initial=-1)) + 1)
    for code, member in zip(codes.tolist(), members.tolist()):
        sets[code] |= 1 << member
    return sets


def _members(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def _walk(first: list[int], codes: list[int], postings: list[int], is_end: list[bool], starts: list[int], block: int):
    """The nodes below the starts in depth-first order: parent, least member, turns from the
    start, popcount, and the ids of ended members as bitsets."""
    parents, lows, offsets, counts, ended = [], [], [], [], []
    stack = [(bits, 0, -1) for bits in reversed(starts)]
    while stack:
        bits, offset, above = stack.pop()
        here = len(parents)
        parents.append(above)
        lows.append((bits & -bits).bit_length() - 1)
        offsets.append(offset)
        counts.append(bits.bit_count())
        ended.append(0)
        rest = bits if offset < block else 0  # what goes on behind a full piece is another block's
        children = []
        while rest:
            row = first[(rest & -rest).bit_length() - 1] + offset
            met = rest & postings[codes[row]]
            rest ^= met
            if is_end[row]:
                ended[here] = met
            else:
                children.append((met, offset + 1, here))
        stack.extend(reversed(children))
    return parents, lows, offsets, counts, ended


def _shard_nodes(shard: int, rows: dict[str, np.ndarray], block: int) -> pa.RecordBatch:
    conv, k1, k2 = rows["conv_id"], rows["k1"], rows["k2"]
    first = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
    member = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(conv))))
    is_end = rows["words"] == END
    codes = _codes(k2, k1, rows["position"], is_end)
    starts = _bitsets(_codes(rows["s2"][first], rows["s1"][first]), np.arange(len(first)))
    parents, lows, offsets, counts, ended = _walk(
        first.tolist(), codes.tolist(), _bitsets(codes, member), is_end.tolist(), starts, block)
    parent, low, offset, count = (np.array(x, dtype=np.int64) for x in (parents, lows, offsets, counts))
    begin = first[low]
    at = begin + offset - 1
    below = offset > 0
    keys = []
    for key, start in ((k1, "s1"), (k2, "s2")):
        total = np.concatenate(([0], np.bitwise_xor.accumulate(key)))
        keys.append(total[at + 1] ^ total[begin] ^ rows[start][begin])
    number = int(rows["block"][0])
    counted = below | (number == 0)  # a later block's start has been counted where it ended a piece
    branches = np.zeros(len(parent), dtype=bool)
    branches[parent[parent >= 0]] = True
    ids = conv[first]
    lists = [[int(ids[m]) for m in _members(bits)] for bits in ended]
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(parent), shard, np.int64)), pa.array(np.arange(len(parent), dtype=np.int32)),
        pa.array(parent.astype(np.int32)), pa.array(keys[0]), pa.array(keys[1]), pa.array(number * block + offset),
        pa.array(ids[low], mask=~counted), pa.array(np.where(counted, count, 0)),
        pa.array(np.where(below, rows["words"][np.maximum(at, 0)], 0)), pa.array(branches),
        pa.array([x[0] if x else None for x in lists], pa.int64()),
        pa.array([",".join(map(str, x)) if x else None for x in lists], pa.string()),
    ], names=["shard", "node", "parent", "k1", "k2", "depth", "conv_id", "n", "words", "branches", "first_end", "ends"])


def _whole_groups(parts: Iterator[pa.RecordBatch], key: str) -> Iterator[dict[str, np.ndarray]]:
    """Runs of rows that end where the key changes; one key's rows are never split."""
    held = None
    for part in parts:
        if not part.num_rows:
            continue
        new = {name: part.column(name).to_numpy(zero_copy_only=False) for name in part.schema.names}
        held = new if held is None else {name: np.concatenate((held[name], new[name])) for name in new}
        keys = held[key]
        last = int(np.searchsorted(keys, keys[-1])) if keys[0] <= keys[-1] else 0
        if last:
            yield {name: column[:last] for name, column in held.items()}
            held = {name: column[last:] for name, column in held.items()}
    if held is not None:
        yield held


def _sharding(block: int, shard: int, conversations: int):
    """Tasks over rows in order of (block, conv_id, position)."""
    def pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        """Whole pieces: rows held back until the conversation or the block changes."""
        held = None
        for part in parts:
            if not part.num_rows:
                continue
            new = {name: part.column(name).to_numpy(zero_copy_only=False) for name in part.schema.names}
            held = new if held is None else {name: np.concatenate((held[name], new[name])) for name in new}
            own = (held["conv_id"] == held["conv_id"][-1]) & (held["block"] == held["block"][-1])
            last = len(own) - int(own.sum())
            if last:
                yield {name: column[:last] for name, column in held.items()}
                held = {name: column[last:] for name, column in held.items()}
        if held is not None:
            yield held

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for rows in pieces(parts):
            conv, of = rows["conv_id"], rows["block"]
            begins = np.flatnonzero(np.concatenate(([True], (conv[1:] != conv[:-1]) | (of[1:] != of[:-1]))))
            ends = np.append(begins[1:], len(conv))
            low = 0
            while low < len(begins):
                high = int(np.searchsorted(ends, begins[low] + shard, side="right"))
                high = min(high, low + conversations, int(np.searchsorted(of[begins], of[begins[low]], side="right")))
                high = max(high, low + 1)
                some = slice(begins[low], ends[high - 1])
                yield _shard_nodes(number, {name: column[some] for name, column in rows.items()}, block)
                number, low = number + 1, high
    return batches


def _starts(rows: DataFrame) -> DataFrame:
    """``(conv_id, block, s1, s2)``: the key that a piece goes on from, of conversations longer than a block."""
    long = rows.where("block > 0").select("conv_id").distinct()
    pieces = (rows.join(long, "conv_id", "left_semi").groupBy("conv_id", "block")
              .agg(F.bit_xor("k1").alias("x1"), F.bit_xor("k2").alias("x2")))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.select("conv_id", "block", F.bit_xor("x1").over(before).alias("s1"),
                         F.bit_xor("x2").over(before).alias("s2")).where("block > 0")


def _summing(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each shard adds to its nodes."""
    for rows in _whole_groups(parts, "shard"):
        # Several shards at once: parents counted from the first node of each.
        base = np.flatnonzero(rows["node"] == 0)
        parent = rows["parent"] + np.repeat(base, np.diff(np.append(base, len(rows["node"]))))
        has = rows["parent"] >= 0
        mine, depth = rows["mine"], rows["depth"]
        leaves = np.where(mine, rows["leaves"], 0)
        saved = np.where(mine, rows["saved"], 0)
        order = np.argsort(-depth, kind="stable")
        edges = np.flatnonzero(np.diff(depth[order], prepend=np.iinfo(np.int64).max))
        for low, high in zip(edges, np.append(edges[1:], len(order))):
            level = order[low:high]
            level = level[has[level]]
            np.add.at(leaves, parent[level], leaves[level])
            np.add.at(saved, parent[level], saved[level])
        again = ~has & (depth > 0)  # a later block's start: its block is in the sums of the node already
        leaves[again] = saved[again] = 0
        named = mine & has
        children = np.bincount(parent[named], minlength=len(parent))
        told = np.flatnonzero(mine | (children > 0) | (leaves > 0) | (saved > 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[c][told]) for c in ("k1", "k2", "depth", "conv_id", "n_convs")]
            + [pa.array(rows["conv_id"][np.where(has, parent, 0)][told], mask=~named[told]),
               pa.array(children[told]), pa.array(leaves[told]), pa.array(saved[told])],
            names=["k1", "k2", "depth", "conv_id", "n_convs", "parent_conv_id", "n_children", "n_leaves", "saved_tokens"])


def _end_digests(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for the lists of a node, which follow each other in order."""
    key, digest = None, None
    for part in parts:
        done = []
        for k1, k2, ends in zip(*(part.column(c).to_pylist() for c in ("k1", "k2", "ends"))):
            if (k1, k2) == key:
                digest.update(b",")
            else:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = (k1, k2), hashlib.sha256()
            digest.update(ends.encode())
        yield _digest_rows(done)
    if key is not None:
        yield _digest_rows([(*key, digest.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))],
                                      names=["e1", "e2", "ends_sha256"])


def shard_nodes(rows: DataFrame, block: int = BLOCK, shard: int = SHARD,
                conversations: int = SHARD_CONVERSATIONS) -> tuple[DataFrame, DataFrame | None]:
    """The nodes of each shard with their end lists, and the starts of later blocks, if there are any."""
    rows = rows.selectExpr("conv_id", "position", "words", f"(position - 1) div {block} as block",
                           f"if(words = {END}, 0L, xxhash64(t1, t2, position)) as k1",
                           f"if(words = {END}, 0L, xxhash64(position, t2, 1, t1)) as k2")
    starts = None
    begun = rows.where("block = 0").selectExpr("*", "0L as s1", "0L as s2")
    if not rows.where("block > 0").isEmpty():
        starts = cut(_starts(rows))
        begun = begun.union(rows.where("block > 0").join(starts, ["conv_id", "block"]).select(begun.columns))
    dealt = begun.repartitionByRange("block", "conv_id").sortWithinPartitions("block", "conv_id", "position")
    return stored(in_tasks(dealt, _sharding(block, shard, conversations), _NODES), "trie-shards"), starts


def _beyond(nodes: DataFrame, starts: DataFrame, block: int) -> DataFrame:
    """``(b1, b2, more_leaves, more_saved)``: what the blocks behind a piece's last node hold."""
    totals = (nodes.where(f"depth > {block}").groupBy("conv_id", F.expr(f"(depth - 1) div {block}").alias("block"))
              .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    after = Window.partitionBy("conv_id").orderBy("block").rowsBetween(0, Window.unboundedFollowing)
    return (starts.join(totals, ["conv_id", "block"], "left")
            .select("s1", "s2", F.sum(F.coalesce("leaves", F.lit(0))).over(after).alias("leaves"),
                    F.sum(F.coalesce("saved", F.lit(0))).over(after).alias("saved"))
            .groupBy(F.col("s1").alias("b1"), F.col("s2").alias("b2"))
            .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))


def prefix_trie(rows: DataFrame, block: int = BLOCK, shard: int = SHARD,
                conversations: int = SHARD_CONVERSATIONS) -> DataFrame:
    """One row per node: its key, depth, least member, its parent's least member, members,
    children, childless nodes and saved words of its subtree, and the digest of the sorted ids of the
    conversations that end there.  A node saves the words of its last turn for each member but one."""
    parts, starts = shard_nodes(rows, block, shard, conversations)
    merged = parts.groupBy("k1", "k2").agg(
        F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"),
        F.max("words").alias("words"), F.max("branches").alias("branches"))
    nodes = merged.selectExpr("k1 as m1", "k2 as m2", "depth", "conv_id", "n_convs",
                              "if(branches, 0L, 1L) as leaves", "(n_convs - 1) * words as saved")
    if starts is not None:
        nodes = cut(nodes)
        more = _beyond(nodes, starts, block)
        nodes = nodes.join(more, (F.col("m1") == F.col("b1")) & (F.col("m2") == F.col("b2")), "left").selectExpr(
            "m1", "m2", "depth", "conv_id", "n_convs", "leaves + coalesce(more_leaves, 0) as leaves",
            "saved + coalesce(more_saved, 0) as saved")
    placed = parts.select("shard", "node", "parent", "k1", "k2", F.col("conv_id").alias("local_conv"))
    known = placed.join(nodes, (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2"))).selectExpr(
        "shard", "node", "parent", "k1", "k2", "depth", "conv_id", "n_convs", "leaves", "saved",
        "coalesce(local_conv = conv_id, false) as mine")
    sums = in_tasks(known.repartition("shard").sortWithinPartitions("shard", "node"), _summing, _SUMS)
    whole = sums.groupBy("k1", "k2").agg(
        *(F.max(c).alias(c) for c in ("depth", "conv_id", "n_convs", "parent_conv_id")),
        *(F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")))
    lists = parts.where("ends is not null").select("k1", "k2", "first_end", "ends")
    digests = in_tasks(lists.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first_end")
                       .select("k1", "k2", "ends"), _end_digests, "e1 long, e2 long, ends_sha256 string")
    nothing = hashlib.sha256().hexdigest()
    return whole.join(digests, (F.col("k1") == F.col("e1")) & (F.col("k2") == F.col("e2")), "left").select(
        "k1", "k2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
