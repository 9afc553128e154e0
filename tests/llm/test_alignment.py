from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cases import EDGE_TEXTS, frame, some_texts, with_clashes
from salestrata.llm import alignment

BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
MORE = ["a▁b", "▁", "end <|endoftext|> x", " two", "  three", "x  y", "中文 é\xa0ß", "  a", "'ll  'm\n\n b ",
        "<0x41> <unk>", "a﻿b", "ﬁ ½"]


class Brute:
    """The definition, a byte at a time, with the libraries on whole texts."""

    def __init__(self, texts):
        a = Tokenizer.from_file(BPE)
        a.encode_special_tokens = True
        b = sentencepiece.SentencePieceProcessor(model_file=MODEL)
        byte_of = alignment.byte_of_character()
        self.rows = []
        for text in texts:
            ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
            ids_b = b.encode(text or "")
            spelled_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
            spelled_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                         else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            whole = (" " + (text or "")).encode()
            if not text or b"".join(spelled_a) != whole or b"".join(spelled_b) != whole:
                ids_a, ids_b, spelled_a, spelled_b = [], [], [], []
            self.rows.append(self.one(ids_a, ids_b, spelled_a, spelled_b))
        self.counts = Counter(p for *_, links in self.rows for p in links)
        self.most: dict[int, int] = {}
        for (x, _), n in self.counts.items():
            self.most[x] = max(n, self.most.get(x, 0))

    @staticmethod
    def one(ids_a, ids_b, spelled_a, spelled_b):
        of_a = [i for i, t in enumerate(spelled_a) for _ in t]
        of_b = [i for i, t in enumerate(spelled_b) for _ in t]
        links = sorted(set(zip(of_a, of_b)))
        groups, open_a, open_b = [], [], []
        for k, (i, j) in enumerate(zip(of_a, of_b)):
            open_a += [] if i in open_a else [i]
            open_b += [] if j in open_b else [j]
            last = k + 1 == len(of_a)
            if last or (of_a[k + 1] != i and of_b[k + 1] != j):
                groups.append((open_a, open_b))
                open_a, open_b = [], []
        said = ";".join(",".join(str(ids_a[i]) for i in x) + "|" + ",".join(str(ids_b[j]) for j in y) for x, y in groups)
        return (len(ids_a), len(ids_b), len(groups), len(links), hashlib.sha256(said.encode()).hexdigest() if ids_a else "",
                Counter((ids_a[i], ids_b[j]) for i, j in links))

    def result(self):
        return [(*row[:4], sum(n for p, n in row[5].items() if self.counts[p] == self.most[p[0]]),
                 sum(n * self.counts[p] for p, n in row[5].items()), row[4]) for row in self.rows]


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("part,held", [(1 << 20, 1 << 20), (300, 50)])
def test_all_counts_are_those_of_brute_force(spark, part, held):
    texts = EDGE_TEXTS + MORE + some_texts(spark)[:120] + some_texts(spark)[:20]
    docs = with_clashes(frame(spark, texts), ["pair", "row", "pairs", "n", "links", "best"]).repartition(4)
    aligned = alignment.align(docs, BPE, MODEL, part)
    found = alignment.scored(aligned, alignment.pair_counts(aligned, MODEL), held)
    have = {r.doc_id: tuple(r[n] for n in NAMES) for r in found.collect()}
    want = Brute(texts).result()
    assert len(have) == len(texts) == found.count()
    for i, row in enumerate(want):
        assert have[i] == row, repr(texts[i])


def test_partial_counts_of_many_batches(spark, monkeypatch):
    monkeypatch.setattr(alignment, "_PENDING", 100)
    import pyarrow as pa
    parts = [pa.RecordBatch.from_pydict({"pairs": pa.array([list(range(i % 60)), None, [5]], pa.list_(pa.int64()))})
             for i in range(50)]
    total = Counter()
    for batch in alignment._counting(iter(parts)):
        for p, n in zip(batch.column("pair").to_pylist(), batch.column("n").to_pylist()):
            total[p] += n
    assert total == Counter([p for i in range(50) for p in [*range(i % 60), 5]])


def test_parts_put_together_are_the_text():
    text = b"one two  three. four 'five' \xc3\xa9 six seven \xe2\x96\x81 x end  "
    for part in range(1, 20):
        assert b" ".join(alignment._parts(text, part)) == text
    assert list(alignment._parts(b"x" * 50, 5)) == [b"x" * 50]


def test_null_ids_repeated_rows_and_an_empty_table(spark):
    docs = frame(spark, ["a b", "a b", None, "a b"], ids=[None, 1, 1, 1])
    found = alignment.alignment(docs, BPE, MODEL).collect()
    assert sorted((r.doc_id or 0, r.n_a, r.count_sum) for r in found) == [(0, 2, 6), (1, 0, 0), (1, 2, 6), (1, 2, 6)]
    assert alignment.alignment(docs.limit(0), BPE, MODEL).collect() == []
