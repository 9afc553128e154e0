"""A corpus made fit for training: documents filtered, thinned out and tokenised.

``STAGES`` are the steps in order.  Each takes ``(spark, docs, sf_dir)``; its rows
are written as Parquet and read again as the next one's ``docs``.  All but the last
return whole documents, with whatever columns they came with.  Nulls, empty texts,
repeated rows, empty tables and clashing column names are treated as the operators
say in their modules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salestrata.llm import decontaminate, pieces, quality_rules, simhash, toxicity
from salestrata.llm.queries import PIECES
from salestrata.llm.shared import documents, new_folder


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; learnt from the labelled ones of the whole table."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_civil(docs, labels, documents(spark, sf_dir))


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, their number, and digests of ids and decoded text."""
    return pieces.token_digests(docs, PIECES, keep_ids=True)


STAGES = [
    ("quality rules", good),
    ("toxicity", civil),
    ("SimHash near-dedup", single),
    ("benchmark decontamination", clean),
    ("SentencePiece encoding and decoding", tokens),
]

# The models, the hash of the shingles and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole documents table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        folder = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
