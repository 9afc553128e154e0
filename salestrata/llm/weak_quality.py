"""Operator 6, quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every text.
Expectation-maximisation over the counts of all vote patterns estimates the share
of good texts and how often each labeller votes what on good and on bad ones;
nobody's votes are trusted beforehand beyond the start from the majority.  The posterior of
a text's pattern is its label, and a linear scorer on its hashed byte n-grams is
fitted to these labels.  The scorer's verdict holds for all texts, so it also
judges what the labellers leave open.

Votes and their patterns are counted over all documents; there are at most
3 ** len(LABELLERS) patterns.  The scorer is fitted on a bounded sample: at most ``SAMPLE``
distinct texts, half of them of posterior below one half.  Copies of a text are one
row with a count.  Its priority is the count over a number in (0, 1) hashed from the text;
the highest are taken, and each weighs as much as the first that is not taken, or
its count if that is more.  So a text of many copies is in for certain, with its own count.

A null or empty text gets the votes of a text without words; its n-gram vector is zero.
If all votes agree, the labels are the posteriors of that one pattern.  Repeated rows are
judged each, other columns are not looked at, and an empty table gives an empty result.
A text of any length is judged whole in one task, its n-grams counted in parts of
``PIECE_BYTES``; it takes some twelve times its size there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestrata.llm import ngram_vectors, quality_rules
from salestrata.llm.ngram_vectors import BUCKETS
from salestrata.llm.shared import cut, in_tasks, one_text_each
from salestrata.llm.textkit import (
    NON_SPACE,
    mix,
    row_blocks,
    set_counts,
    span_hashes,
    texts_of,
    words_of,
)

# Labellers of one fault: the measure from which they vote bad.  They never vote good.
FAULTS = {
    "symbols": 0.10,
    "repeats": 0.35,
    "same words": 0.60,
    "capitals": 0.30,
    "marks": 0.30,
    "lines": 0.40,
    "other characters": 0.20,
}
# Labellers of plain text: they vote good if every measure is at most this.
PLAIN = {
    "ordinary": {"symbols": 0.02, "repeats": 0.30, "same words": 0.50, "capitals": 0.12, "marks": 0.05, "lines": 0.35},
    "even": {"stretch": 0.30, "other characters": 0.10, "symbols": 0.02, "marks": 0.05},
}
LABELLERS = (*FAULTS, *PLAIN)
BAD, NONE, GOOD = 0, 1, 2
SIGNS = "-0+"
SAMPLE = 4000
SALT = 6
ROUNDS = 200
STEPS = 400
PENALTY = 2e-5
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b"!?")] = True


def measures(column) -> dict[str, np.ndarray]:
    """What the labellers look at, as shares of a text's words, letters or lines."""
    base = quality_rules.measure(column)
    texts = texts_of(column)
    data = texts.data[:texts.offsets[-1]]
    words = words_of(texts, NON_SPACE)
    hashes = span_hashes(texts.data, words.starts, words.ends)
    rows = words.rows()
    distinct = np.unique(hashes ^ mix(rows.astype(np.uint64) + np.uint64(1)), return_index=True)[1]
    distinct = np.bincount(rows[distinct], minlength=len(texts))
    n, letters = np.maximum(base["n_words"], 1), set_counts(_LETTER[data], texts.offsets)
    ink = np.maximum(set_counts(NON_SPACE[data], texts.offsets), 1)
    lines = set_counts(data == 0x0A, texts.offsets) + 1
    length = base["word_chars"] / n
    return {
        "symbols": base["n_symbols"] / n,
        "repeats": base["n_repeat_words"] / n,
        "same words": 1 - distinct / n,
        "capitals": set_counts(_UPPER[data], texts.offsets) / np.maximum(letters, 1),
        "marks": set_counts(_MARK[data], texts.offsets) / n,
        "lines": base["n_dup_lines"] / lines,
        "other characters": 1 - letters / ink,
        "stretch": np.abs(length - 6) / 6,
    }


def votes(column) -> np.ndarray:
    """A row per text, a column per labeller."""
    found = measures(column)
    bad = [np.where(found[name] >= least, BAD, NONE) for name, least in FAULTS.items()]
    good = [np.where(np.all([found[m] <= most for m, most in limits.items()], axis=0), GOOD, NONE)
            for limits in PLAIN.values()]
    return np.stack(bad + good, axis=1)


def pattern(votes_: np.ndarray) -> np.ndarray:
    return votes_ @ (3 ** np.arange(votes_.shape[1]))


@dataclass
class LabelModel:
    """``vote[c, j, v]``: the probability that labeller j votes v on a text of class c (0 bad, 1 good)."""

    prior: np.ndarray
    vote: np.ndarray

    def posterior(self, votes_: np.ndarray) -> np.ndarray:
        """The probability that a text with these votes is good."""
        log = np.log(self.prior)[None, :] + sum(np.log(self.vote[:, j, votes_[:, j]]).T for j in range(votes_.shape[1]))
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -700, 700)))

    def accuracies(self) -> dict[str, float]:
        """How often a labeller is right when it votes."""
        right = self.prior[0] * self.vote[0, :, BAD] + self.prior[1] * self.vote[1, :, GOOD]
        says = (self.prior[:, None] * (self.vote[:, :, BAD] + self.vote[:, :, GOOD])).sum(axis=0)
        return dict(zip(LABELLERS, (right / says).tolist()))


def estimate(votes_: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over distinct vote patterns and their counts."""
    # the start: a bad vote weighs more than a good one, as a labeller of faults sees one kind only
    good = np.where((votes_ == BAD).any(axis=1), 0.2, 0.9)
    for _ in range(rounds):
        weight = np.stack(((1 - good) * counts, good * counts))
        prior = (weight.sum(axis=1) + 1) / (counts.sum() + 2)
        vote = np.stack([[np.bincount(votes_[:, j], weights=w, minlength=3) for j in range(votes_.shape[1])] for w in weight]) + 0.1
        model = LabelModel(prior, vote / vote.sum(axis=2, keepdims=True))
        new = model.posterior(votes_)
        if np.abs(new - good).max(initial=0) < 1e-9:
            break
        good = new
    return model


def fit_linear(rows: np.ndarray, target: np.ndarray, weight: np.ndarray | float = 1.0,
               steps: int = STEPS, penalty: float = PENALTY) -> np.ndarray:
    """Weights, a constant last, of a logistic fit to soft targets by accelerated
    steps; ``weight`` says how many rows each stands for."""
    # all in the rows' own type: a wider number would copy the matrix at every step
    weight = (np.broadcast_to(weight, len(rows)) / np.mean(weight)).astype(rows.dtype)
    target = np.asarray(target, dtype=rows.dtype)
    rows = np.hstack([rows, np.ones((len(rows), 1), dtype=rows.dtype)])
    step = 1 / (0.25 * float((weight * (rows * rows).sum(axis=1)).mean()) + penalty)
    weights = ahead = np.zeros(rows.shape[1], dtype=rows.dtype)
    pace = 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(rows @ ahead))) - target
        new = ahead - step * (rows.T @ (weight * error) / len(rows) + penalty * ahead)
        next_pace = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead = new + (pace - 1) / next_pace * (new - weights)
        weights, pace = new, next_pace
    return weights


def _vectors(column) -> Iterator[tuple[int, np.ndarray]]:
    """Logarithmic counts of the raw bytes' n-grams, scaled to length one."""
    for first, counts in ngram_vectors.counts(column):
        rows = np.log1p(counts.astype(np.float32))
        norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
        yield first, rows / np.where(norm > 0, norm, 1)


def _patterns(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in row_blocks(parts):
        keys, first, counts = np.unique(block.column("key").to_numpy(), return_index=True, return_counts=True)
        said = pattern(votes(block.column("text").take(pa.array(first))))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(said.astype(np.int64)), pa.array(counts.astype(np.int64))],
                                         names=["key", "pattern", "n"])


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.xxhash64(text).alias("key"), text.alias("text"))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """``(key, pattern, n)``: the distinct texts by a hash, their votes, how many rows have them."""
    return cut(in_tasks(_keyed(docs), _patterns, "key long, pattern long, n long")
               .groupBy("key").agg(F.min("pattern").alias("pattern"), F.sum("n").alias("n")))


def _pattern_votes(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // (3 ** np.arange(len(LABELLERS)))[None, :] % 3


def label_model(texts: DataFrame) -> LabelModel | None:
    """The model of all rows, from their distinct texts."""
    counted = texts.groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").toArrow()  # 3 ** 9 rows at most
    if not counted.num_rows:
        return None
    return estimate(_pattern_votes(counted.column("pattern").to_numpy()), counted.column("n").to_numpy().astype(float))


def _grading(model: LabelModel):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            good = model.posterior(_pattern_votes(part.column("pattern").to_numpy()))
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("n"), pa.array(good)], names=["key", "n", "good"])
    return batches


def training_texts(texts: DataFrame, model: LabelModel, sample: int = SAMPLE) -> list[tuple[int, float, float]]:
    """``(key, good, weight)`` of at most ``sample`` distinct texts, half of either class."""
    even = F.expr(f"(pmod(xxhash64(key, {SALT}), {1 << 52}) + 0.5D) / {1 << 52}D")
    graded = in_tasks(texts, _grading(model), "key long, n long, good double").withColumn("priority", F.col("n") / even)
    most, chosen = sample // 2, []
    for of_class in ("good < 0.5", "good >= 0.5"):
        ranked = graded.where(of_class).orderBy(F.desc("priority"), "key").limit(most + 1).collect()
        edge = ranked[most]["priority"] if len(ranked) > most else 0.0
        chosen += [(r["key"], r["good"], max(float(r["n"]), edge)) for r in ranked[:most]]
    return chosen


def _training(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in row_blocks(parts):
        for first, rows in _vectors(block.column("text")):
            yield pa.RecordBatch.from_arrays(
                [block.column("key").slice(first, len(rows)), pa.array([r.astype("<f2").tobytes() for r in rows], pa.binary())],
                names=["key", "vector"])


def scorer(docs: DataFrame, texts: DataFrame, model: LabelModel, sample: int = SAMPLE) -> np.ndarray:
    """The weights of the linear scorer, fitted to the posteriors of a sample."""
    chosen = sorted(training_texts(texts, model, sample))
    wanted = docs.sparkSession.createDataFrame([(key,) for key, _, _ in chosen], "key long")
    found = in_tasks(one_text_each(_keyed(docs).join(F.broadcast(wanted), "key")), _training,
                     "key long, vector binary").toArrow()  # ``sample`` rows at most
    vectors = dict(zip(found.column("key").to_pylist(), found.column("vector").to_pylist()))
    rows = np.frombuffer(b"".join(vectors[key] for key, _, _ in chosen), dtype="<f2").reshape(-1, BUCKETS).astype(np.float32)
    return fit_linear(rows, np.array([good for _, good, _ in chosen], dtype=np.float32), np.array([weight for *_, weight in chosen]))


def _scoring(broadcast):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, weights = broadcast.value
        signs = np.array(list(SIGNS))
        for block in row_blocks(parts):
            said = votes(block.column("text"))
            score = np.zeros(block.num_rows)
            for first, rows in _vectors(block.column("text")):
                score[first:first + len(rows)] = 1 / (1 + np.exp(-(rows @ weights[:-1] + weights[-1])))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(["".join(v) for v in signs[said]]), pa.array(model.posterior(said)),
                 pa.array(score), pa.array(score >= 0.5)], names=["doc_id", "votes", "posterior", "score", "good"])
    return batches


def weak_quality(docs: DataFrame) -> DataFrame:
    """One row per document: its votes in the order of ``LABELLERS``, the posterior of
    their pattern, the scorer's probability that it is good, and the verdict."""
    texts = distinct_texts(docs)
    model = label_model(texts)
    weights = scorer(docs, texts, model) if model else None
    shared = docs.sparkSession.sparkContext.broadcast((model, weights))
    return in_tasks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _scoring(shared),
                    "doc_id long, votes string, posterior double, score double, good boolean")
