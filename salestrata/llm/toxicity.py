"""Operator 3, toxicity: a cumulative-link ordinal regression on words and stems.

A text's features are its words, runs of ASCII letters and digits and of
non-ASCII characters with A-Z lowered, and the first ``STEMS`` bytes of them, as
an inflected word is seen too seldom to be known by itself.

Grades run from 0 (not toxic) to 3.  The labels say toxic or not; of the toxic
training texts, the grade is by how many distinct markers they hold.  Markers are
learnt: stems of ``STEMS[0]`` bytes in at least ``MARKER_SHARE`` of the toxic training texts, and
``MARKER_ODDS`` times as frequent there as in the others.  One weight vector over
the presence of features serves all thresholds: P(grade > k) = s(w.x - t_k) with
t_0 <= t_1 <= t_2, fitted by accelerated proximal steps on the likelihood with an
L1 penalty, so most weights are zero.  A text's score is the expected grade; it is
toxic if P(grade > 0) is at least ``CUTOFF``.

Training uses a bounded sample: about ``LABELLED`` labelled documents, half of
either class, chosen by a hash of their id, and ``FEATURES`` features.  Scoring reads
all documents whole.

A null or empty text has no words and is scored by the thresholds alone.  Labels
that are null are left out, a document labelled twice is toxic if either says so.
Without both classes nothing is learnt, and every score is zero.  Repeated rows
are scored each.  Other columns are not looked at.  A text of any length is scored whole
in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from salestrata.llm.shared import columns, cut, in_tasks, one_text_each
from salestrata.llm.textkit import (
    ALNUM,
    mix,
    row_blocks,
    span_hashes,
    texts_of,
    words_of,
)

LABELLED = 20_000
SALT = 3
FEATURES = 512
LEAST_DOCUMENTS = 5
STEMS = (4, 5)
MARKER_SHARE = 0.05
MARKER_ODDS = 20.0
GRADE_FROM = (1, 2, 4)  # distinct markers from which a toxic text has grade 1, 2, 3
PENALTY = 2e-4
STEPS = 1000
CUTOFF = 0.6


_KINDS = 3  # the bits that tell words (0) and the stems


@dataclass
class Ordinal:
    words: np.ndarray  # sorted hashes of the features with a weight
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) by row and k."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])


NOTHING = Ordinal(np.zeros(0, dtype=np.uint64), np.zeros(0), np.full(len(GRADE_FROM), np.inf))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def features(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row, hash)`` of the words of a block, then of their stems by length."""
    texts = texts_of(column, lower=True)
    words = words_of(texts, ALNUM)
    rows = words.rows()
    yield rows, span_hashes(texts.data, words.starts, words.ends)
    for n in STEMS:
        long = words.ends - words.starts >= n
        starts = words.starts[long]
        hashes = mix(span_hashes(texts.data, starts, starts + n) + np.uint64(n))
        # the last bits tell stems by length
        yield rows[long], hashes & ~np.uint64(_KINDS) | np.uint64(STEMS.index(n) + 1)


def distinct_features(column) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)``, each once, by row."""
    found = [(rows, hashes if i else hashes & ~np.uint64(_KINDS)) for i, (rows, hashes) in enumerate(features(column))]
    rows, hashes = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return rows[new], hashes[new]


def _word_lists(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in row_blocks(parts):
        rows, hashes = distinct_features(block.column("text"))
        offsets = np.searchsorted(rows, np.arange(block.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [block.column("toxic"), pa.ListArray.from_arrays(offsets, hashes.view(np.int64))],
            names=["toxic", "words"])


def training_rows(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """``(toxic, words)`` of at most ``bound`` labelled texts, half of either class; rows of one
    id and text are one.  Those with the smallest salted hash of id and text are taken."""
    labelled = (labels.where("doc_id is not null and toxic is not null")
                .groupBy(F.col("doc_id").alias("labelled_id")).agg(F.max("toxic").alias("toxic")))
    keyed = docs.where("doc_id is not null").select(
        F.col("doc_id").alias("text_id"), F.xxhash64(F.lit(SALT), "doc_id", "text").alias("key"), "text")
    # two hashes a row are joined, no text; a repeated id is one row per text of its own
    pairs = cut(keyed.select("text_id", "key").distinct().join(labelled, F.col("text_id") == F.col("labelled_id"))
                .select("key", F.expr("int(toxic > 0)").alias("toxic")))
    most = bound // 2
    chosen = cut(pairs.where("toxic > 0").orderBy("key").limit(most)
                 .union(pairs.where("toxic <= 0").orderBy("key").limit(most)))
    # ``bound`` rows of two numbers, sent to the texts rather than the texts to them
    texts = one_text_each(keyed.select("key", "text").join(F.broadcast(chosen.select("key")), "key"))
    return cut(in_tasks(texts.join(F.broadcast(chosen), "key").select("toxic", "text"), _word_lists,
                        "toxic int, words array<long>"))


def fit(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> Ordinal:
    rows = training_rows(docs, labels, bound)
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_other = size.get(1, 0), size.get(0, 0)
    if not n_toxic or not n_other:
        return NOTHING
    counted = (rows.select("toxic", F.explode("words").alias("word")).groupBy("word")
               .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"))
               .where(f"t + o >= {LEAST_DOCUMENTS}"))
    expected = f"((t + o) * {n_toxic / (n_toxic + n_other)}D)"
    chosen = (counted.withColumn("strength", F.expr(f"abs(t - {expected}) / sqrt({expected} + 1)"))
              .orderBy(F.desc("strength"), "word").limit(FEATURES).collect())
    if not chosen:
        return NOTHING
    chosen.sort(key=lambda r: r["word"] & 0xFFFFFFFFFFFFFFFF)
    hashes = np.array([r["word"] for r in chosen], dtype=np.int64)
    share = np.array([r["t"] for r in chosen]) / n_toxic
    odds = (share + 1e-9) / ((np.array([r["o"] for r in chosen]) + 0.5) / n_other)
    marker = (share >= MARKER_SHARE) & (odds >= MARKER_ODDS) & (hashes & _KINDS == 1)
    # At most FEATURES ids a row, and about as many rows as the bound says.
    wanted = F.array(*[F.lit(int(h)) for h in hashes])
    table = rows.select("toxic", F.array_intersect("words", wanted).alias("words")).toArrow()
    lists = table.column("words").combine_chunks()
    flat = lists.flatten().to_numpy().astype(np.int64)
    by_value = np.argsort(hashes)
    column = by_value[np.searchsorted(hashes[by_value], flat)]
    row = np.repeat(np.arange(table.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
    toxic = table.column("toxic").to_numpy()
    markers = np.bincount(row, weights=marker[column], minlength=len(toxic))
    grade = np.where(toxic > 0, 1 + sum((markers >= n).astype(int) for n in GRADE_FROM[1:]), 0)
    weights, thresholds = fit_ordinal(row, column, grade, len(hashes), len(GRADE_FROM))
    used = weights != 0
    return Ordinal(hashes.view(np.uint64)[used], weights[used], thresholds)


def fit_ordinal(row: np.ndarray, column: np.ndarray, grade: np.ndarray, features: int, top: int,
                penalty: float = PENALTY, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ``top`` thresholds of the cumulative-link likelihood with an L1
    penalty on the weights.  ``(row, column)`` are the ones of a 0/1 matrix."""
    size = len(grade)
    weights, gaps = np.zeros(features), np.concatenate(([0.0], np.ones(top - 1)))

    def cuts(g: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate((g[:1], np.log1p(np.exp(g[1:])))))

    def gradient(w: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        score = np.bincount(row, weights=w[column], minlength=size)
        edge = np.concatenate(([-np.inf], cuts(g), [np.inf]))
        low, high = _sigmoid(edge[grade] - score), _sigmoid(edge[grade + 1] - score)
        mass = np.maximum(high - low, 1e-12)
        d_low, d_high = low * (1 - low) / mass, high * (1 - high) / mass
        by_cut = np.bincount(grade, weights=d_low, minlength=top + 1)[1:] \
            - np.bincount(grade, weights=d_high, minlength=top + 1)[:-1]
        by_gap = np.cumsum(by_cut[::-1])[::-1] / size
        by_gap[1:] *= _sigmoid(g[1:])
        return np.bincount(column, weights=(d_high - d_low)[row], minlength=features) / size, by_gap

    # The likelihood bends at most half as much as the largest eigenvalue of the
    # matrix with its constant column, which stands for all thresholds.
    along, constant = np.ones(features), 1.0
    for _ in range(30):
        norm = np.sqrt(along @ along + constant * constant)
        along, constant = along / norm, constant / norm
        image = np.bincount(row, weights=along[column], minlength=size) + top * constant
        along, constant = np.bincount(column, weights=image[row], minlength=features) / size, top * image.mean()
    step = 1.0 / (0.5 * np.sqrt(along @ along + constant * constant))
    at_w, at_g, pace = weights, gaps, 1.0
    for _ in range(steps):
        d_w, d_g = gradient(at_w, at_g)
        new_w = at_w - step * d_w
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * penalty, 0)
        new_g = at_g - step * d_g
        next_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        drive = (pace - 1) / next_pace
        at_w, at_g = new_w + drive * (new_w - weights), new_g + drive * (new_g - gaps)
        weights, gaps, pace = new_w, new_g, next_pace
    return weights, cuts(gaps)


def _scoring(broadcast):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        bits = np.zeros(1 << 16, dtype=bool)
        bits[model.words >> np.uint64(48)] = True
        for block in row_blocks(parts):
            score = np.zeros(block.num_rows)
            if len(model.words):
                pairs = []
                for i, (rows, hashes) in enumerate(features(block.column("text"))):
                    hashes = hashes if i else hashes & ~np.uint64(_KINDS)
                    at = np.flatnonzero(bits[hashes >> np.uint64(48)])
                    feature = np.minimum(np.searchsorted(model.words, hashes[at]), len(model.words) - 1)
                    hit = model.words[feature] == hashes[at]
                    pairs.append(rows[at[hit]] * np.int64(len(model.words)) + feature[hit])
                pair = np.unique(np.concatenate(pairs))
                score = np.bincount(pair // len(model.words), weights=model.weights[pair % len(model.words)],
                                    minlength=block.num_rows)
            above = model.above(score)
            yield pa.RecordBatch.from_arrays(
                [block.column("document"), pa.array(above.sum(axis=1)), pa.array(above[:, 0].copy())],
                names=["document", "severity", "p_toxic"])
    return batches


def judge(docs: DataFrame, model: Ordinal, carry: list[str]) -> DataFrame:
    """``(document struct of the carried columns, severity, p_toxic)`` per row."""
    schema = StructType([StructField("document", docs.select(*columns(carry)).schema),
                         StructField("severity", DoubleType()), StructField("p_toxic", DoubleType())])
    rows = docs.select(F.struct(*columns(carry)).alias("document"), "text")
    return in_tasks(rows, _scoring(docs.sparkSession.sparkContext.broadcast(model)), schema)


def toxicity(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """One row per document: expected severity (0 to 3), its nearest grade, the
    probability of any, and the verdict.  ``learn_from`` has the labelled texts if not ``docs``."""
    model = fit(docs if learn_from is None else learn_from, labels)
    return judge(docs, model, ["doc_id"]).select(
        "document.doc_id", "severity", F.round("severity").cast("int").alias("grade"), "p_toxic",
        (F.col("p_toxic") >= CUTOFF).alias("toxic"))


def keep_civil(docs: DataFrame, labels: DataFrame, learn_from: DataFrame) -> DataFrame:
    """The documents that are not toxic, with all their columns."""
    return judge(docs, fit(learn_from, labels), docs.columns).where(f"p_toxic < {CUTOFF}").select("document.*")
