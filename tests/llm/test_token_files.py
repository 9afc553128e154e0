from __future__ import annotations

import heapq
import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cases import EDGE_TEXTS, frame, some_texts, with_clashes
from salestrata.llm import huffman, token_files
from salestrata.llm.shared import new_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
MORE = ["é\xa0 b", "a   b", "x　 y", "a\x85 b", "  \n a", "tab\t\tx", "end \n", "ß é ü  ", "中 文", "\x1f a",
        "end <|endoftext|> x", "<|endoftext|>", "a<|endoftext|><|endoftext|>b", " \n<|endoftext|>\n ", "<|endoftext|", "<<|endoftext|>>"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def cost(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a + b
        heapq.heappush(heap, a + b)
    return total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=60))
def test_lengths_are_optimal_and_limited(counts):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts, 40).astype(int)
    used = counts > 0
    assert ((lengths > 0) == used).all()
    if used.sum() > 1:
        assert sum(2.0 ** -lengths[used]) == 1
        assert (lengths * counts).sum() == cost(counts)
        least = int(used.sum() - 1).bit_length()
        short = huffman.code_lengths(counts, least).astype(int)
        assert short.max() <= max(least, 1) and sum(2.0 ** -short[used]) <= 1


def test_a_limited_code_is_the_best_of_its_kind():
    counts = np.array([1, 1, 2, 3, 5, 8])
    for limit in (3, 4, 5):
        lengths = huffman.code_lengths(counts, limit).astype(int)
        best = min((sum(a * b for a, b in zip(c, counts)) for c in itertools.product(range(1, limit + 1), repeat=6)
                    if sum(2.0 ** -x for x in c) <= 1))
        assert (lengths * counts).sum() == best and lengths.max() <= limit


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3000), max_size=700), st.integers(1, 200))
def test_round_trip_and_every_checkpoint(ids, every):
    ids = np.array(ids, dtype=np.uint32)
    book = huffman.Codebook(huffman.code_lengths(np.bincount(ids, minlength=1)))
    stream, checkpoints = huffman.encode(book, ids, every)
    table = book.table()
    assert (huffman.decode(book, table, stream, checkpoints, len(ids), every) == ids).all()
    for i, at in enumerate(checkpoints):  # a block alone
        part = ids[i * every:(i + 1) * every]
        assert (huffman.decode(book, table, stream, np.array([at]), len(part), every) == part).all()


def test_files_hold_the_ids_of_the_library(spark, tokenizer, monkeypatch):
    texts = EDGE_TEXTS + MORE + some_texts(spark)
    docs = with_clashes(frame(spark, texts), ["ids", "part", "start", "seq"]).repartition(3)
    monkeypatch.setattr(token_files, "CHUNK", 5000)
    folder = new_folder(spark, "tokens")
    token_files.write(docs, PATH, folder)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(w) for w in want])))
    found = token_files.read(spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        assert r.ids == want[r.doc_id], repr(texts[r.doc_id])
        assert r.start == starts[r.doc_id]
    for r in token_files.digests(spark, folder).collect():
        assert (r.start, r.n_tokens) == (starts[r.doc_id], len(want[r.doc_id]))
        assert r.ids_crc32 == zlib.crc32(np.array(want[r.doc_id], dtype="<u4").tobytes())
    rows = sorted((r.part, r.seq, r.doc_ids) for r in spark.read.parquet(f"{folder}/chunks").collect())
    assert list(itertools.chain(*[d for _, _, d in rows])) == list(range(len(texts)))


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    docs = frame(spark, ["b", "b", None, "a"], ids=[1, 1, None, 1])
    folder = new_folder(spark, "tokens")
    token_files.write(docs, PATH, folder)
    found = sorted((r.doc_id or 0, r.start, r.n_tokens) for r in token_files.digests(spark, folder).collect())
    assert found == [(0, 0, 1), (1, 1, 2), (1, 3, 2), (1, 5, 2)]
    folder = new_folder(spark, "tokens")
    token_files.write(docs.limit(0), PATH, folder)
    assert token_files.digests(spark, folder).collect() == []
    assert token_files.read(spark, folder).collect() == []


def test_the_string_of_an_added_token_is_that_token(spark, tokenizer):
    assert tokenizer.encode("end <|endoftext|> x", add_special_tokens=False).ids == [437, 220, 50256, 2124]
    folder = new_folder(spark, "tokens")
    token_files.write(frame(spark, ["end <|endoftext|> x"]), PATH, folder)
    assert token_files.read(spark, folder).first().ids == [437, 220, 50256, 2124, 0]
