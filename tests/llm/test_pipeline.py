from __future__ import annotations

import hashlib

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from cases import DATA, EDGE_TEXTS, frame, with_clashes
from salestrata.llm import quality_rules, queries, toxicity
from test_decontaminate import brute as benchmark_hits
from test_simhash import brute_components, fingerprint

SF = f"{DATA}/sf0.001"


def test_the_whole_equals_its_definition(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    # what the two models say, each on what it gets; the rest by brute force
    good = {r.doc_id for r in quality_rules.quality_rules(docs).where("kept").collect()}
    left = docs.where(F.col("doc_id").isin(list(good)))
    civil = sorted(r.doc_id for r in toxicity.toxicity(left, labels, docs).where("not toxic").collect())
    components = brute_components([fingerprint(texts[i]) for i in civil])
    single = [i for n, i in enumerate(civil) if components[n] == n]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [i for i, (_, hit, _) in zip(single, benchmark_hits([texts[i] for i in single], items)) if not hit]
    assert len(texts) > len(good) > len(civil) >= len(single) > len(clean) > 100
    processor = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert sorted(found) == clean
    for i, r in found.items():
        ids = processor.encode(texts[i], add_eos=True)
        assert (r.ids, r.n_tokens) == (ids, len(ids))
        assert r.decoded_sha256 == hashlib.sha256(processor.decode(ids).encode()).hexdigest()


def test_stages_are_the_dealt_ones_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "toxicity", "SimHash near-dedup", "benchmark decontamination",
        "SentencePiece encoding and decoding"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("stage", range(5))
def test_edges_of_every_stage(spark, stage):
    texts = EDGE_TEXTS + [EDGE_TEXTS[4]]
    ids = [None, *range(1, len(texts) - 2), 3, 3]  # a null, and one id three times
    docs = with_clashes(frame(spark, texts, ids=ids), [
        "document", "measured", "kept", "row", "component", "fingerprint", "spans", "items", "n_words", "ids",
        "n_tokens", "p_toxic", "severity", "kept_id", "rows", "language", "with.dot", "with space"])
    function = corpus_pipeline.STAGES[stage][1]
    found = function(spark, docs, SF)
    if stage < 4:
        assert found.schema.names == docs.schema.names
        given = {tuple(r) for r in docs.collect()}
        assert {tuple(r) for r in found.collect()} <= given
    else:
        assert found.count() == len(texts)
    empty = function(spark, docs.limit(0), SF)
    assert empty.collect() == [] and empty.schema.names == found.schema.names


def test_filtering_stages_keep_documents_without_text(spark):
    docs = frame(spark, [None, ""], ids=[1, 2])
    for stage in (1, 3):
        assert corpus_pipeline.STAGES[stage][1](spark, docs, SF).count() == 2
    assert corpus_pipeline.STAGES[2][1](spark, docs, SF).collect()[0].doc_id == 1
