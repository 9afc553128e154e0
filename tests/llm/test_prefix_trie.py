from __future__ import annotations

import hashlib
import random
import zlib

import pytest
import xxhash

from cases import spaced_words
from salestrata.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, k1 string, position string"


def signed_hash(role: str, text: str) -> int:
    """Spark's hash of two strings: the first one's hash seeds the second's."""
    value = xxhash.xxh64_intdigest(text.encode(), xxhash.xxh64_intdigest(role.encode(), 42))
    return value - (value >> 63 << 64)


def in_order(rows):
    found: dict[int, list] = {}
    clean = [(c, t, r or "", x or "") for c, t, r, x in rows if c is not None]
    for c, t, r, x in sorted(clean, key=lambda q: (q[0], q[1] is not None, q[1] or 0, q[2], signed_hash(q[2], q[3]))):
        found.setdefault(c, []).append((r, x))
    return found


def rebuilt(convs, every=20, most=4):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % most
        base = abs(c) // every * every * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def brute_trie(convs):
    members: dict[tuple, list[int]] = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for key, own in members.items():
        below = [k for k in members if k[:len(key)] == key]
        ends = sorted(c for c in own if len(convs[c]) == len(key))
        out.append((min(own), len(key), min(members[key[:-1]]) if key else None, len(own),
                    sum(len(k) == len(key) + 1 for k in below),
                    sum(not any(m[:len(k)] == k and len(m) == len(k) + 1 for m in below) for k in below),
                    sum((len(members[k]) - 1) * len(spaced_words(k[-1][1])) for k in below if k),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def told(found):
    return sorted((tuple(r) for r in found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256").collect()), key=str)


def some_rows(seed: int, ids, longest: int):
    rng = random.Random(seed)
    texts = ["", "a", "b c", "d  e\tf", None, "é \x1c g"]
    rows = []
    for c in ids:
        length = rng.choice([1, 2, 3, longest])
        same = rng.random() < 0.5
        for t in range(length):
            rows.append((c, t, "user" if same else rng.choice(["user", None, "assistant"]),
                         texts[1] if same else rng.choice(texts)))
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


@pytest.mark.parametrize("block,shard,conversations", [(256, 1 << 15, 1 << 11), (2, 7, 3), (3, 1, 1), (1, 50, 40)])
def test_nodes_are_those_of_brute_force(spark, block, shard, conversations):
    rows = some_rows(block, [*range(-25, 60), 400], 9)
    convs = in_order(rows)
    turns = prefix_trie.turns(frame(spark, rows).repartition(5))
    plain = prefix_trie.prefix_trie(prefix_trie.with_ends(turns), block, shard, conversations)
    assert told(plain) == brute_trie(convs)
    grafted = prefix_trie.prefix_trie(prefix_trie.regrafted(turns, 20, 4), block, shard, conversations)
    assert told(grafted) == brute_trie(rebuilt(convs))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, None, "user", "x"), (1, None, "user", "x"), (1, 0, None, None), (1, 0, "", "a"), (1, 0, "", "b"),
            (None, 0, "user", "lost"), (2, None, "user", "x"), (3, 5, "user", "x"), (4, None, "", "b"), (4, 1, "", "")]
    trie = prefix_trie.prefix_trie(prefix_trie.with_ends(prefix_trie.turns(frame(spark, rows))))
    assert told(trie) == brute_trie(in_order(rows))


def test_one_long_conversation_is_spread_and_many_alike_are_one_path(spark):
    rows = [(7, t, "user", f"turn {t % 3}") for t in range(600)] + [
        (c, t, "user", f"turn {t % 3}") for c in range(100, 400) for t in range(4)]
    convs = in_order(rows)
    turns = prefix_trie.turns(frame(spark, rows))
    parts, starts = prefix_trie.shard_nodes(prefix_trie.with_ends(turns), block=50, shard=200)
    assert parts.groupBy("shard").count().agg({"count": "max"}).first()[0] <= 200
    assert starts.count() == 12
    trie = told(prefix_trie.prefix_trie(prefix_trie.with_ends(turns), block=50, shard=200))
    assert len(trie) == 601
    by_depth = {r[1]: r for r in trie}
    assert by_depth[0][:7] == (7, 0, None, 301, 1, 1, sum(2 * 300 for _ in range(4)))
    assert by_depth[4][3:6] == (301, 1, 1) and by_depth[600][4:6] == (0, 1)
    assert by_depth[4][7] == hashlib.sha256(",".join(map(str, range(100, 400))).encode()).hexdigest()
    assert convs.keys() == {7, *range(100, 400)}


def test_an_empty_table_has_no_root(spark):
    turns = prefix_trie.turns(frame(spark, []))
    assert told(prefix_trie.prefix_trie(prefix_trie.regrafted(turns, 20, 4))) == []


def test_a_long_text_is_one_turn(spark):
    text = "word " * 2_000_000
    trie = prefix_trie.prefix_trie(prefix_trie.with_ends(prefix_trie.turns(
        frame(spark, [(1, 0, "user", text), (2, 0, "user", text)]))))
    assert [(r.n_convs, r.saved_tokens) for r in trie.orderBy("depth").collect()] == [(2, 2_000_000)] * 2
