from __future__ import annotations

import numpy as np
import pytest

from cases import DATA, EDGE_TEXTS, frame, with_clashes
from salestrata.llm import weak_quality


def test_estimation_recovers_accuracies():
    rng = np.random.default_rng(2)
    n = len(weak_quality.LABELLERS)
    good = rng.random(40_000) < 0.8
    accuracy = np.linspace(0.7, 0.95, n)
    abstains = rng.random((len(good), n)) < 0.3
    right = rng.random((len(good), n)) < accuracy
    votes = np.where(abstains, weak_quality.NONE, np.where(right == good[:, None], weak_quality.GOOD, weak_quality.BAD))
    patterns, counts = np.unique(weak_quality.pattern(votes), return_counts=True)
    distinct = weak_quality._pattern_votes(patterns)
    assert (weak_quality.pattern(distinct) == patterns).all()
    model = weak_quality.estimate(distinct, counts.astype(float))
    assert model.prior[1] == pytest.approx(0.8, abs=0.05)
    assert np.allclose(list(model.accuracies().values()), accuracy, atol=0.03)
    assert ((model.posterior(votes) > 0.5) == good).mean() > 0.93


def test_linear_fit_follows_soft_targets():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(3000, 5)).astype(np.float32)
    true = np.array([1.0, -2.0, 0.5, 0, 0])
    target = 1 / (1 + np.exp(-(rows @ true + 0.3)))
    weights = weak_quality.fit_linear(rows, target, steps=400, penalty=0)
    assert np.allclose(weights, [*true, 0.3], atol=0.05)


def test_labelled_documents(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/sf0.1/labels.parquet")
    found = weak_quality.weak_quality(docs).join(labels, "doc_id").toPandas()
    assert found.posterior.between(0, 1).all() and found.score.between(0, 1).all()
    good, bad = found[found.quality == 1], found[found.quality == 0]
    assert good.good.mean() >= 0.98
    assert (~bad.good).mean() >= 0.9


def test_edges_repeated_rows_and_an_empty_table(spark):
    texts = EDGE_TEXTS + [EDGE_TEXTS[5]] * 3
    docs = with_clashes(frame(spark, texts, ids=[None] * len(texts)), ["votes", "score", "good", "pick"])
    found = weak_quality.weak_quality(docs).collect()
    assert len(found) == len(texts)
    assert all(len(r.votes) == len(weak_quality.LABELLERS) for r in found)
    assert weak_quality.weak_quality(docs.limit(0)).collect() == []


def test_sample_is_bounded_and_copies_are_one_weighted_row(spark):
    ordinary = [t for t in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").toPandas().text if t]
    many = ordinary[0]
    docs = frame(spark, ordinary + [None] * 4000 + [many] * 3000)
    texts = weak_quality.distinct_texts(docs)
    assert texts.count() == len(set(ordinary)) + 1
    assert texts.agg({"n": "sum"}).first()[0] == len(ordinary) + 7000
    chosen = weak_quality.training_texts(texts, weak_quality.label_model(texts), sample=200)
    weights = {key: weight for key, _, weight in chosen}
    assert len(weights) == len(chosen) <= 200
    sizes = {r.key: r.n for r in texts.collect()}
    for key, n in sizes.items():
        if n >= 3000:
            assert weights[key] == n
    assert sum(weights.values()) == pytest.approx(sum(sizes.values()), rel=0.1)
