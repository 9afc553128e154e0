from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from cases import DATA, EDGE_TEXTS, frame, some_texts, spaced_words, with_clashes
from salestrata.llm import kneser_ney, quality_rules


def base(text):
    words = spaced_words(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if spaced_words(x)]
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(repeated), failed)


@pytest.fixture(scope="module")
def texts(spark):
    return EDGE_TEXTS + some_texts(spark) + ["x y z " * 40 + "\n" + "x y z " * 3, "é " * 30]


def test_base_counts_equal_brute_force(spark, texts):
    found = quality_rules.quality_rules(frame(spark, texts)).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == base(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_probabilities_after_a_context_sum_to_one(spark):
    docs = frame(spark, ["abracadabra abrac", "banana bandana banana", "abab"], langs=["x", "x", None])
    model = kneser_ney.fit(docs.select("lang", "text"))
    for name, contexts in (("x", [b"abr", b"ban", b"zzz", b"an ", b"rac"]), (kneser_ney.NO_LANGUAGE, [b"aba", b"zab"])):
        seed = np.repeat(kneser_ney.language_seeds([name]), 256)
        for context in contexts:
            before = int.from_bytes(context, "big") << 8
            packed = np.arange(before, before + 256, dtype=np.uint32)
            assert np.exp(kneser_ney.log_probabilities(model, packed, seed)).sum() == pytest.approx(1, abs=1e-4)


def test_discounts_and_probabilities_of_a_small_corpus(spark):
    # one context "abc" seen five times: d three times, e twice; every count below follows by hand
    docs = frame(spark, ["abcd", "abcd", "abcd", "abce", "abce"], langs=["x"] * 5)
    counts = {(r.lang, r.gram): r.n for r in kneser_ney.count_grams(docs).collect()}
    assert counts == {("x", int.from_bytes(b"abcd", "big")): 3, ("x", int.from_bytes(b"abce", "big")): 2}
    model = kneser_ney.fit(docs.select("lang", "text"))
    seed = kneser_ney.language_seeds(["x"])
    d, e = (np.exp(kneser_ney.log_probabilities(model, np.array([int.from_bytes(g, "big")], dtype=np.uint32), seed))[0]
            for g in (b"abcd", b"abce"))
    # too few counts of counts at every order: the discounts are half the count
    lower = 1 / 256
    for _ in range(3):  # one, two, three bytes: d and e follow one distinct context each
        lower = (1 - 0.5) / 2 + (0.5 + 0.5) / 2 * lower
    assert d == pytest.approx((3 - 1.5) / 5 + (1.5 + 1) / 5 * lower, rel=1e-4)
    assert e == pytest.approx((2 - 1) / 5 + (1.5 + 1) / 5 * lower, rel=1e-4)


def test_noise_is_rejected_and_prose_kept(spark):
    rng = np.random.default_rng(3)
    noise = " ".join("".join(chr(rng.integers(0x21, 0x7F)) for _ in range(8)) for _ in range(60))
    good = {r.doc_id for r in spark.read.parquet(f"{DATA}/sf0.01/labels.parquet").where("quality = 1").collect()}
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").orderBy("doc_id").collect()
    prose = [r.text for r in docs if r.doc_id in good and not base(r.text)[-1]]
    assert len(prose) > 300
    verdict = {r.doc_id: r.kept for r in quality_rules.quality_rules(
        frame(spark, [noise] + prose, langs=["en"] * (len(prose) + 1))).collect()}
    assert not verdict[0]
    assert sum(verdict.values()) >= len(prose) - 2


def test_keep_good_returns_the_rows_as_they_are(spark, texts):
    docs = with_clashes(frame(spark, texts), ["kept", "perplexity", "document", "measured", "n_words", "language"])
    kept = quality_rules.keep_good(docs)
    assert kept.schema.names == docs.schema.names
    wanted = {r.doc_id for r in quality_rules.quality_rules(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == wanted
    assert all(r.text == texts[r.doc_id] for r in kept.collect())


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    docs = frame(spark, ["a b"] * 3, ids=[None, 1, 1], langs=["en", None, None])
    assert quality_rules.quality_rules(docs).count() == 3
    assert quality_rules.quality_rules(docs.limit(0)).collect() == []
    assert quality_rules.keep_good(docs.limit(0)).columns == docs.columns


def test_no_ngram_stands_for_another_and_perplexities_are_exact(spark, texts):
    docs = frame(spark, texts)
    model = kneser_ney.fit(docs)
    grams = kneser_ney.count_grams(docs)
    assert len(model.grams[-1][0].keys) == grams.where("n > 1").count()
    seeds = dict(zip(("en", "und"), kneser_ney.language_seeds(["en", "und"])))
    want = {}
    for r in docs.collect():
        data = (r.text or "").encode()
        packed = np.array([int.from_bytes(data[i:i + 4], "big") for i in range(len(data) - 3)], dtype=np.uint32)
        if len(packed):
            each = kneser_ney.log_probabilities(model, packed, np.full(len(packed), seeds[r.lang or "und"]))
            want[r.doc_id] = np.exp(-each.astype(float).mean())
    for held in (1 << 22, 300, 0):  # all held by the workers, the frequent ones, none
        assert (kneser_ney.scores(docs, held=held).beyond is None) == (held > 300)
        rows = quality_rules.judge(docs, ["doc_id"], held=held).select("document.doc_id", "perplexity").collect()
        assert len(rows) == len(texts)
        for r in rows:
            assert (r.perplexity is None) == (r.doc_id not in want)
            assert r.perplexity is None or r.perplexity == pytest.approx(want[r.doc_id], rel=1e-4)


def test_keys_of_a_large_table_are_all_found():
    keys = np.unique(kneser_ney.hash_keys(np.arange(5_000_000, dtype=np.uint32), 4, kneser_ney.language_seeds(["x"])))
    assert len(keys) == 5_000_000
    table = kneser_ney.SortedHashTable(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    others = kneser_ney.hash_keys(np.arange(100_000, dtype=np.uint32), 4, kneser_ney.language_seeds(["y"]))
    assert (table.find(others) == -1).all()


def test_shapes_equal_their_definition(texts):
    import pyarrow as pa
    found = quality_rules.shapes(quality_rules.texts_of(pa.array(texts)))
    for i, text in enumerate(texts):
        letters = re.sub(rb"[A-Za-z\x80-\xff]+", b"a", (text or "").encode())
        assert found.text(i) == re.sub(rb"[0-9]+", b"0", letters)


def test_labelled_junk_is_rejected_and_clean_text_kept(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/sf0.01/labels.parquet")
    verdicts = quality_rules.quality_rules(docs).where("not base_failed").join(labels, "doc_id").collect()
    junk, clean = ([r.kept for r in verdicts if r.quality == q] for q in (0, 1))
    assert len(junk) > 20 and len(clean) > 300
    assert sum(junk) <= 0.1 * len(junk)
    assert sum(clean) >= 0.99 * len(clean)
