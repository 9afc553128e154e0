"""Operator 4, quality rules: counts per text, and perplexity bands per language.

Words are runs of bytes other than space and the five control spaces.  A text
fails the base rules if it has fewer than ``MIN_WORDS`` words, or if more than
``MAX_REPEAT_PERCENT`` of them lie in eight-word windows that the text holds
twice or more.  Of the rest, a text is rejected if its perplexity under the
modified Kneser-Ney model of its language, counted over all rows, is below or
above its language's band: the median of the logarithm, plus and minus
``BAND_WIDTH`` times the spread (half the distance of the quartiles, at least
``LEAST_SPREAD``: a document in another language than its label says stays).

A second model of the same kind sees the texts as shapes: runs of letters as one
letter, of digits as one digit, all else as it stands, in n-grams of ``SHAPE_ORDER``.
These reach across word borders, and prose has one shape in any language, so it
tells junk from mixed languages, which the first model cannot.  They are so short
that none holds the marks of two words: one mark does not foretell the next.
Its bands follow the same rule with ``LEAST_SHAPE_SPREAD``; both come from all rows
that pass the base rules.

A null or empty text has no words and fails the base rules; its perplexity is
null.  A text too short for a model is not judged by it.  A null language counts as
``und``.  Repeated rows are judged alike, each on its own row.  Other columns of the
input are not looked at, whatever their names.  An empty table gives an empty result.
A text of any length is judged whole in one task, its n-grams
in parts of ``PIECE_BYTES``; it takes some eleven times its size there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from salestrata.llm import kneser_ney
from salestrata.llm.shared import columns, cut, in_tasks, small_side, stored
from salestrata.llm.textkit import (
    NON_SPACE,
    Texts,
    covered,
    mix,
    plain_array,
    row_blocks,
    set_counts,
    span_hashes,
    texts_of,
    window_hashes,
    window_rows,
    words_of,
)

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
BAND_WIDTH = 6.0
LEAST_SPREAD = 0.2
SHAPE_ORDER = 3
LEAST_SHAPE_SPREAD = 0.05
BANDS = ("band", "shape")
ROUNDED = 0.001

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MEASURED = StructType([*(StructField(name, LongType()) for name in MEASURES),
                        StructField("language", StringType())])
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_LETTER, _DIGIT = 0x61, 0x30
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x41:0x5B] = _SHAPE[0x61:0x7B] = _SHAPE[0x80:] = _LETTER
_SHAPE[0x30:0x3A] = _DIGIT
_WORD_CHARACTER = NON_SPACE.copy()  # the first byte of each character of a word
_WORD_CHARACTER[0x80:0xC0] = False


def duplicate_lines(column) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same text, per row."""
    lines = pc.split_pattern(pc.fill_null(plain_array(column), ""), "\n")
    per_row = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lines.flatten().dictionary_encode()
    worded = pc.match_substring_regex(coded.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    code = coded.indices.to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(per_row)), per_row)
    keep = worded[code] if len(code) else np.zeros(0, dtype=bool)
    rows, code = rows[keep], code[keep]
    distinct = np.unique(rows * np.int64(len(worded) + 1) + code) // np.int64(len(worded) + 1)
    size = len(per_row)
    return np.bincount(rows, minlength=size) - np.bincount(distinct, minlength=size)


def repeated_words(first: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Words in windows that their text holds twice or more, per row; row i has the word hashes
    ``first[i]:first[i + 1]``."""
    starts, rows = window_rows(first, WINDOW)
    keys = window_hashes(hashes, WINDOW)[starts]
    if len(first) > 2:
        keys ^= mix(rows.astype(np.uint64))
    del rows
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    del ordered
    if not len(twice):
        return np.zeros(len(first) - 1, dtype=np.int64)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    starts = starts[twice[at] == keys]
    del at, keys
    return set_counts(covered(starts, WINDOW, len(hashes)), first)


def measure(column) -> dict[str, np.ndarray]:
    """The five counts of every text of a block."""
    texts: Texts = texts_of(column)
    data = texts.data[:texts.offsets[-1]]
    word_chars = set_counts(_WORD_CHARACTER[data], texts.offsets)
    n_symbols = set_counts(_SYMBOL[data], texts.offsets)
    words = words_of(texts, NON_SPACE)
    first, hashes = words.first, span_hashes(texts.data, words.starts, words.ends)
    del words, data, texts  # large where a text is
    return {
        "n_words": np.diff(first),
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": duplicate_lines(column),
        "n_repeat_words": repeated_words(first, hashes),
    }


def shapes(texts: Texts) -> Texts:
    """The texts with every run of letters as one letter and of digits as one digit."""
    size = int(texts.offsets[-1])
    data = _SHAPE[texts.data[:size]]
    kept = np.ones(size, dtype=bool)
    kept[1:] = (data[1:] != data[:-1]) | ((data[1:] != _LETTER) & (data[1:] != _DIGIT))
    first = texts.offsets[:-1]
    kept[first[first < size]] = True  # a run ends with its text
    ends = np.cumsum(set_counts(kept, texts.offsets))
    return Texts(np.concatenate((data[kept], np.zeros(8, dtype=np.uint8))), np.concatenate(([0], ends)))


# The models: what a text is seen as, n-gram length, least spread of the logarithm.
MODELS = {"perplexity": (None, kneser_ney.ORDER, LEAST_SPREAD), "shape_perplexity": (shapes, SHAPE_ORDER, LEAST_SHAPE_SPREAD)}
_SUMS = StructType([StructField(f"{name}_{part}", kind) for name in MODELS for part, kind in (
    ("total", LongType()), ("n", LongType()), ("open", kneser_ney.OPEN))])


def _measuring(shared):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = (pa.RecordBatch.from_struct_array(part.column("document")) for part in parts)
        for block in row_blocks(documents):
            column = block.column("text")
            counts, texts = measure(column), texts_of(column)
            names = block.column("lang").cast(pa.string()).fill_null(kneser_ney.NO_LANGUAGE)
            coded = names.dictionary_encode()
            seeds = kneser_ney.language_seeds(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            fields = [pa.array(counts[name].astype(np.int64)) for name in MEASURES]
            measured = pa.StructArray.from_arrays([*fields, names], names=_MEASURED.names)
            sums = []
            for name, (view, order, _) in MODELS.items():
                seen = view(texts) if view else texts
                total, n_grams, open_ = kneser_ney.held_sums(order, shared[name].value, seen, seeds)
                sums += [pa.array(total), pa.array(n_grams.astype(np.int64)), open_]
            yield pa.RecordBatch.from_arrays([block.to_struct_array(), measured, *sums],
                                             names=["document", "measured", *_SUMS.names])
    return batches


def _quartiles(rows: DataFrame) -> DataFrame:
    """``(of_language, ...)``: per model the exact quartiles of the logarithms, rounded to ``ROUNDED``,
    from their counts; there are some ten thousand different ones at most."""
    values = F.explode(F.array(*[F.struct(F.lit(name).alias("model"), F.round(F.log(name) / ROUNDED).alias("step"))
                                 for name in MODELS])).alias("at")
    counted = (rows.select(F.col("measured.language").alias("of_language"), values)
               .groupBy("of_language", "at.model", "at.step").agg(F.count("*").alias("n")))
    return counted.groupBy("of_language").agg(*[
        F.expr(f"percentile(step * {ROUNDED}, array(0.25, 0.5, 0.75), n) filter (where model = '{name}')").alias(name)
        for name in MODELS])


def judge(docs: DataFrame, carry: list[str], held: int = kneser_ney.HELD) -> DataFrame:
    """``(document struct of the carried columns, measured struct, each model's perplexity and
    band, base_failed, kept)`` for every row; workers hold ``held`` n-grams of a model."""
    spark = docs.sparkSession
    corpus = docs.select("lang", "text")
    models = {name: kneser_ney.scores(corpus, order, view, held) for name, (view, order, _) in MODELS.items()}
    shared = {name: spark.sparkContext.broadcast(model.held) for name, model in models.items()}
    wanted = docs.select(F.struct(*columns(dict.fromkeys([*carry, "lang", "text"]))).alias("document"))
    schema = StructType([*wanted.schema.fields, StructField("measured", _MEASURED), *_SUMS.fields])
    scored = in_tasks(wanted, _measuring(shared), schema)
    kept_columns = F.struct(*[F.col("document")[name].alias(name) for name in carry]).alias("document")
    scored = stored(scored.select(kept_columns, "measured", *_SUMS.names, F.expr(
        f"measured.n_words < {MIN_WORDS} or 100 * measured.n_repeat_words"
        f" > {MAX_REPEAT_PERCENT} * measured.n_words").alias("base_failed"),
        F.monotonically_increasing_id().alias("row")), "measured")
    whole = scored
    for name, model in models.items():
        if model.beyond is not None:
            found = cut(kneser_ney.open_sums(scored.select(
                "row", F.col("measured.language").alias("lang"), F.col(f"{name}_open").alias("open")), model))
            whole = whole.join(found, "row", "left").withColumn(
                f"{name}_total", F.expr(f"{name}_total + coalesce(found, 0)")).drop("found")
    whole = whole.select("document", "measured", "base_failed", *[
        F.expr(f"exp(-{name}_total / {kneser_ney.UNIT}D / nullif({name}_n, 0))").alias(name) for name in MODELS])
    quartiles = _quartiles(whole.where("not base_failed"))
    edges = []
    for (name, (_, _, least)), band in zip(MODELS.items(), BANDS):
        spread = f"greatest(({name}[2] - {name}[0]) / 2, {least})"
        edges += [f"exp({name}[1] {sign} {BAND_WIDTH} * {spread}) as {band}_{edge}"
                  for edge, sign in (("low", "-"), ("high", "+"))]
    bands = small_side(quartiles.selectExpr("of_language", *edges))
    inside = " and ".join(f"coalesce({name} between {band}_low and {band}_high, true)"
                          for name, band in zip(MODELS, BANDS))
    return whole.join(bands, F.col("measured.language") == F.col("of_language"), "left").select(
        "document", "measured", "base_failed", *[c for name, band in zip(MODELS, BANDS)
                                                 for c in (name, f"{band}_low", f"{band}_high")],
        F.expr(f"not base_failed and {inside}").alias("kept"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: the counts, the perplexity with its band, the verdicts."""
    return judge(docs, ["doc_id"]).select(
        "document.doc_id", *[f"measured.{name}" for name in MEASURES], "base_failed", "kept",
        "perplexity", "band_low", "band_high", "measured.language",
        "shape_perplexity", "shape_low", "shape_high")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    return judge(docs, docs.columns).where("kept").select("document.*")
