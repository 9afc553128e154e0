from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import sentencepiece

from cases import EDGE_TEXTS, frame, some_texts, with_clashes
from salestrata.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = EDGE_TEXTS + ["▁ a", "x▁ y", "x ▁ y", "  ", "a  b   c    d", "a 　 b", "\n a\n  b ", " a b", "▁", "▁▁  "]


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_ids_and_texts_are_those_of_the_library(spark, processor):
    texts = TEXTS + some_texts(spark)
    found = pieces.encode_and_decode(with_clashes(frame(spark, texts), ["ids", "decoded"]), MODEL).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = processor.encode(texts[r.doc_id] or "", add_eos=True)
        assert r.ids == ids, repr(texts[r.doc_id])
        assert r.decoded == processor.decode(ids)
    assert {r.doc_id: r.ids for r in pieces.encode(frame(spark, texts), MODEL).collect()} == {
        r.doc_id: r.ids for r in found}


def test_digests(spark, processor):
    texts = TEXTS
    for r in pieces.token_digests(frame(spark, texts), MODEL).collect():
        ids = processor.encode(texts[r.doc_id] or "", add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(processor.decode(ids).encode()).hexdigest()


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    docs = frame(spark, ["a", "a", None], ids=[None, 1, 1])
    assert sorted((r.doc_id or 0, r.n_tokens) for r in pieces.token_digests(docs, MODEL).collect()) == [(0, 2), (1, 1), (1, 2)]
    assert pieces.token_digests(docs.limit(0), MODEL).collect() == []
