from __future__ import annotations

import numpy as np
import pytest

from cases import DATA, EDGE_TEXTS, frame, some_texts, with_clashes
from salestrata.llm import toxicity


def test_the_fit_finds_shared_weights_and_ordered_thresholds():
    rng = np.random.default_rng(1)
    size, features = 4000, 6
    present = rng.random((size, features)) < 0.4
    true = np.array([2.0, 1.0, -1.5, 0, 0, 0])
    latent = present @ true + rng.logistic(size=size)
    grade = (latent[:, None] > np.array([0.5, 1.5, 2.5])).sum(axis=1)
    row, column = np.nonzero(present)
    weights, thresholds = toxicity.fit_ordinal(row, column, grade, features, 3, penalty=1e-4, steps=800)
    assert np.allclose(weights, true, atol=0.25)
    assert np.allclose(thresholds, [0.5, 1.5, 2.5], atol=0.25)


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/sf0.1/labels.parquet")
    held = labels.where("doc_id % 4 = 1")
    found = toxicity.toxicity(docs, labels.where("doc_id % 4 <> 1")).join(held.selectExpr("doc_id", "toxic as label"), "doc_id").toPandas()
    clean = found[found.label == 0]
    assert clean.toxic.mean() <= 0.005
    assert found[found.label == 1].toxic.mean() >= 0.85
    assert found.severity.between(0, 3).all()


def test_stems_and_words_are_told_apart():
    import pyarrow as pa
    rows, hashes = toxicity.distinct_features(pa.array(["trash trashy", None, "tras", "x é", "TRASH"]))
    of = [set(hashes[rows == i].tolist()) for i in range(5)]
    # words trash and trashy, stems tras and trash; the word tras and the stem tras
    assert [len(x) for x in of] == [4, 0, 2, 2, 3]
    assert of[4] < of[0] and len(of[2] & of[0]) == 1


def test_severity_rises_with_the_words(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/sf0.1/labels.parquet")
    plain = some_texts(spark)[0]
    texts = [plain, plain + " idiot moron", plain + " idiot moron scum trash clown", "You IDIOT, moron!"] + EDGE_TEXTS
    new = with_clashes(frame(spark, texts), ["severity", "document", "p_toxic"])
    found = {r.doc_id: r for r in toxicity.toxicity(new, labels, learn_from=docs).collect()}
    assert len(found) == len(texts)
    assert found[0].severity < found[1].severity < found[2].severity
    assert not found[0].toxic and found[1].toxic and found[2].toxic and found[3].toxic
    assert not any(found[i].toxic for i in range(4, len(texts)))
    kept = toxicity.keep_civil(new, labels, docs)
    assert kept.columns == new.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if not r.toxic}


@pytest.mark.parametrize("labelled", [[], [(0, 0, 1)], [(None, 1, None), (0, None, None)]])
def test_without_both_classes_nothing_is_toxic(spark, labelled):
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    docs = frame(spark, ["a b", None, "c"], ids=[0, None, 0])
    found = toxicity.toxicity(docs, labels).collect()
    assert len(found) == 3
    assert all(r.severity == 0 and not r.toxic for r in found)
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


def test_a_repeated_id_does_not_fill_the_sample(spark):
    docs = frame(spark, ["same text"] * 500 + [f"text {i}" for i in range(500)] + [f"bad {i}" for i in range(300)],
                 ids=[0] * 1000 + list(range(1, 301)))
    labels = spark.createDataFrame([(i, 1, int(i > 0)) for i in range(301)], "doc_id long, quality int, toxic int")
    rows = toxicity.training_rows(docs, labels, bound=200).collect()
    assert sorted(r.toxic for r in rows) == [0] * 100 + [1] * 100
    assert len({tuple(r.words) for r in rows}) > 150
