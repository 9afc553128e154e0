from __future__ import annotations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cases import EDGE_TEXTS, frame, lowered, some_texts, spaced_words, with_clashes
from salestrata.llm import simhash


def fingerprint(text) -> int:
    words = spaced_words(lowered(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: list[int], distance=4) -> list[int]:
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.fixture(scope="module")
def texts(spark):
    base = some_texts(spark)
    near = [base[1] + f" tail{i}" for i in range(30)] + [base[2].replace(" the ", f" the{i} ", 1) for i in range(10)]
    return EDGE_TEXTS + base + near


def test_fingerprints_and_components_equal_brute_force(spark, texts):
    prints = [fingerprint(t) for t in texts]
    wanted = brute_components(prints)
    found = simhash.near_duplicates(with_clashes(frame(spark, texts), ["fingerprint", "component", "key"])).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (int(r.fingerprint, 16), len(r.fingerprint)) == (prints[r.doc_id], 16)
        assert r.component_id == wanted[r.doc_id]


def _prints_near(center: int, n: int, rng) -> list[int]:
    out = []
    for _ in range(n):
        flips = rng.choice(64, size=rng.integers(0, 7), replace=False)
        out.append(center ^ sum(1 << int(b) for b in flips))
    return out


@pytest.mark.parametrize("group", [2048, 6])
def test_links_connect_what_brute_force_links(spark, group):
    rng = np.random.default_rng(5)
    prints = _prints_near(0x0123456789ABCDEF, 150, rng) + _prints_near(0xFFFF0000FFFF0000, 60, rng) + [0, (1 << 64) - 1]
    prints = list(dict.fromkeys(prints))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.links(spark.createDataFrame(signed, "fingerprint long"), group=group)
    pairs = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in links.collect()]
    assert all((a ^ b).bit_count() <= 4 and a != b for a, b in pairs)
    found = {r.node: r.root for r in simhash.components(links).collect()}
    got = {}
    for (s,) in signed:
        got.setdefault(found.get(s, s), set()).add(s)
    want = {}
    for (s,), c in zip(signed, brute_components(prints)):
        want.setdefault(c, set()).add(s)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(1, 41))
    assert all(found[i] == 100 for i in range(101, 160))


def test_keep_one_of_each_component(spark, texts):
    docs = frame(spark, texts + [texts[30]], ids=[*range(len(texts)), 30])  # one row twice
    docs = docs.withColumn("source", F.lit("s"))
    kept = simhash.keep_one(with_clashes(docs, ["row", "kept_id", "component_id", "fingerprint"]))
    wanted = sorted(set(brute_components([fingerprint(t) for t in texts])))
    assert sorted(r.doc_id for r in kept.collect()) == wanted


def test_documents_without_an_id(spark):
    one, other = "alpha beta gamma delta epsilon", "quite another text with other words in it"
    docs = frame(spark, [one, one, other, other, other, "third unrelated sentence stands here alone"],
                 ids=[None, 5, None, None, None, 9])
    found = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.near_duplicates(docs).collect())
    assert found == [(-1, -1)] * 3 + [(-1, 5), (5, 5), (9, 9)]
    assert sorted((r.doc_id or -1, r.text[:5]) for r in simhash.keep_one(docs).collect()) == [
        (-1, "quite"), (5, "alpha"), (9, "third")]


def test_repeated_ids_lose_no_component(spark):
    one, same, other, third = ("alpha beta gamma delta epsilon", "alpha beta  gamma delta epsilon",
                               "quite another text with other words in it", "a third unrelated sentence stands here alone")
    for rows, want in (
            ([(3, one), (3, other), (9, third)], [(3, one), (3, other), (9, third)]),  # across two components
            ([(3, one), (3, other), (3, third)], [(3, one), (3, other), (3, third)]),  # across three
            ([(3, one), (3, same), (4, one)], [(3, same)]),  # within one: the least row
            ([(1, one), (3, same), (3, other)], [(1, one), (3, other)]),  # named by another id in one of them
            ([(None, one), (None, other), (3, other), (3, third)], [(None, one), (3, other), (3, third)]),
            ([(None, one), (5, one), (5, other), (None, third), (None, third)], [(5, one), (5, other), (None, third)])):
        docs = frame(spark, [t for _, t in rows], ids=[i for i, _ in rows], langs=["en"] * len(rows))
        kept = sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()), key=str)
        assert kept == sorted(want, key=str), rows


def test_a_tenth_of_the_ids_repeated(spark, texts):
    ids = [i if i % 10 else i // 20 * 20 for i in range(len(texts))]
    kept = simhash.keep_one(frame(spark, texts, ids=ids)).collect()
    components = brute_components([fingerprint(t) for t in texts])
    of = dict(zip(texts, components))
    assert len(kept) == len(set(components)) == len({of[r.text] for r in kept})
    least = {}
    for i, c in zip(ids, components):
        least[c] = min(i, least.get(c, i))
    assert all(r.doc_id == least[of[r.text]] for r in kept)


def test_empty_table(spark):
    docs = frame(spark, ["a"]).limit(0)
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.keep_one(docs).collect() == []
