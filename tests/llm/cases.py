"""Texts at the edges, and brute-force versions of what the operators count."""

from __future__ import annotations

import re

from pyspark.sql.types import LongType, StringType, StructField, StructType

DATA = "/root/testdata"

EDGE_TEXTS = [
    None, "", " ", "\n\n", "  two  words ", "one", "ONE", "one", "tab\tand\x0bline\nbreaks\r\n",
    "no\x1cbreak here   wide", "▁ mark ▁▁ s", "emoji \U0001f600\U0001f600 é ß中文",
    "<s> </s> <unk> <|endoftext|>", "a" * 3000, "word " * 500, " lead", "trail ", "   ", "1 2 3 4 5 6 7 8 9 0",
    "\u0000 nul", "same line\nsame line\n \nother\nsame line", "100% | <b> $5 #x & *", "'s don't 're I'll",
]

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                     StructField("lang", StringType()), StructField("source", StringType()),
                     StructField("n_chars", LongType())])


def frame(spark, texts, ids=None, langs=None):
    ids = range(len(texts)) if ids is None else ids
    langs = [None if i % 5 == 4 else "en" for i in range(len(texts))] if langs is None else langs
    return spark.createDataFrame([(i, t, l, None, None) for i, t, l in zip(ids, texts, langs)], SCHEMA)


def with_clashes(docs, names):
    """The documents with more columns, of the names an operator uses itself."""
    from pyspark.sql import functions as F
    return docs.withColumns({name: F.lit("x") for name in names if name not in docs.columns})


def some_texts(spark, sf="sf0.001"):
    return [r[0] for r in spark.read.parquet(f"{DATA}/{sf}/documents.parquet").orderBy("doc_id").select("text").collect()]


def lowered(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def spaced_words(text) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum_words(text) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text or ""))


def rows(frame_, *names):
    return [tuple(r[n] for n in names) for r in frame_.select(*names).collect()]
