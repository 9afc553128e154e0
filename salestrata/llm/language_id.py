"""Operator 2, language identification by nearest centroids.

A text is the vector of its hashed letter n-grams: logarithmic counts, weighted
by inverse document frequency and scaled to length one.  Each language has up to
``CENTROIDS`` centroids, found by spherical clustering of its sample.  A text has
the language of the centroid with the largest cosine; the cosine is the score.
It is rejected (``rejected``; the nearest language is still given) if it is further from that
centroid than the centroid's own sample: 1 - cosine over ``SLACK`` times the
``RADIUS`` quantile.

Learning reads documents with a text and a language whose crc32 of doc_id, modulo
4, is not 2.  Document frequencies come from all of them.  The clustering uses a bounded
sample: rows of one id, language and text are one, and at most ``SAMPLE`` per language are taken,
those with the smallest salted hash of all three.  The centroids of all languages go to the
tasks; more than ``MOST`` of them are refused, none is left out.

A null text, or one without a letter, is ``und`` with score 0.  A text whose
letters share no n-gram with any language gets the first language by name, with
score 0, and is rejected; of equally near centroids the one of the first language by name, then of the least
radius, counts.  If nothing can be learnt, every text is ``und``.  A null doc_id is held out
by no remainder: it is in the training part.  Repeated rows are judged each, other
columns are not looked at, and an empty table gives an empty result.  A text of any length is judged whole in one
task, its n-grams counted in parts of ``PIECE_BYTES``; it takes some four times its size there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salestrata.llm import ngram_vectors
from salestrata.llm.ngram_vectors import BUCKETS
from salestrata.llm.shared import cut, in_tasks, one_text_each, small_side
from salestrata.llm.textkit import plain_array, row_blocks

UNKNOWN = "und"
CENTROIDS = 4
SAMPLE = 400
SALT = 2
MOST = 1 << 15  # centroids, half a gigabyte
_KEYS = 1 << 20  # of sampled texts, sent to all tasks
ROUNDS = 8
RADIUS = 0.99
SLACK = 1.5
HELD_OUT = "coalesce(crc32(cast(doc_id as string)) % 4 = 2, false)"


@dataclass
class Centroids:
    languages: list[str]  # of each centroid
    vectors: np.ndarray
    radii: np.ndarray
    weights: np.ndarray  # inverse document frequency by bucket


def counts_of(column) -> Iterator[tuple[int, np.ndarray]]:
    return ngram_vectors.counts(column, letters=True)


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.where(norm > 0, norm, 1)


def vectors(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(counts.astype(np.float32)) * weights.astype(np.float32))


def _frequencies(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket the documents that have it; -1 counts all."""
    total, rows = np.zeros(BUCKETS, dtype=np.int64), 0
    for block in row_blocks(parts):
        for _, counts in counts_of(block.column("text")):
            total += (counts > 0).sum(axis=0)
        rows += block.num_rows
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, BUCKETS, dtype=np.int32)),
                                      pa.array(np.concatenate(([rows], total)))], names=["bucket", "n"])


def _sampled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in row_blocks(parts):
        for first, counts in counts_of(block.column("text")):
            yield pa.RecordBatch.from_arrays(
                [block.column("lang").slice(first, len(counts)),
                 pa.array([c.astype("<f4").tobytes() for c in counts], pa.binary())], names=["lang", "counts"])


def cluster(points: np.ndarray, k: int = CENTROIDS) -> np.ndarray:
    """Which cluster each unit vector is in: spherical k-means from points far apart."""
    chosen = [int(np.argmax(points @ points.mean(axis=0)))]
    nearest = points @ points[chosen[0]]
    while len(chosen) < min(k, len(points)) and nearest.min() < 1 - 1e-6:
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, points @ points[chosen[-1]])
    centers = points[chosen]
    for _ in range(ROUNDS):
        owner = np.argmax(points @ centers.T, axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, owner, points)
        filled = np.bincount(owner, minlength=len(centers)) > 0
        centers = _unit(sums[filled])
    return np.argmax(points @ centers.T, axis=1)


def _clustering(weights: np.ndarray):
    def of_language(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # in an order of their own, as the rows come in any
        counts = np.frombuffer(b"".join(sorted(rows["counts"])), dtype="<f4").reshape(-1, BUCKETS)
        points = vectors(counts, weights)
        points = points[points.any(axis=1)]
        found = []
        owner = cluster(points) if len(points) else np.zeros(0, dtype=int)
        for k in np.unique(owner):
            members = points[owner == k]
            center = _unit(members.sum(axis=0, keepdims=True))[0]
            radius = float(np.quantile(1 - members @ center, RADIUS))
            found.append((key[0], center.astype("<f4").tobytes(), radius))
        return pd.DataFrame(found, columns=["lang", "vector", "radius"])
    return of_language


def training_sample(train: DataFrame, sample: int) -> DataFrame:
    """``(lang, text)``, at most ``sample`` of a language, of rows ``(of_id, lang, text)``."""
    keyed = train.select(F.xxhash64(F.lit(SALT), "of_id", "lang", "text").alias("key"), "lang", "text")
    distinct = cut(keyed.select("lang", "key").distinct())
    # rows of two hashes; a little more than the sample passes, so that it is full and no language is sorted whole
    share = (distinct.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("n"))
             .select("of", F.least(F.lit(1.0), F.lit(float(2 * sample + 100)) / F.col("n")).alias("share")))
    near = (distinct.join(small_side(share), F.col("lang") == F.col("of"))
            .where(f"pmod(key, {1 << 52}) <= share * {1 << 52}"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.expr(f"pmod(key, {1 << 52})"), "key"))
    # ``sample`` rows a language at most, sent to the texts rather than the texts to them if they are few
    chosen = cut(near.withColumn("place", place).where(F.col("place") <= sample).select("key", "lang"))
    texts = one_text_each(keyed.select("key", "text").join(small_side(chosen.select("key"), _KEYS), "key"))
    return texts.join(chosen, "key").select("lang", "text")


def fit(docs: DataFrame, sample: int = SAMPLE) -> Centroids | None:
    """The centroids of the documents that are not held out."""
    train = docs.where(f"text is not null and lang is not null and not {HELD_OUT}").select(
        F.col("doc_id").alias("of_id"), F.col("lang").cast("string").alias("lang"), "text")
    counted = (in_tasks(train.select("text"), _frequencies, "bucket int, n long")
               .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())  # BUCKETS rows and one
    n = np.zeros(BUCKETS + 1)
    n[counted.column("bucket").to_numpy() + 1] = counted.column("n").to_numpy()
    if not n[0]:
        return None
    weights = np.log((1 + n[0]) / (1 + n[1:])) + 1
    centroids = cut(in_tasks(training_sample(train, sample), _sampled, "lang string, counts binary").groupBy("lang")
                    .applyInPandas(_clustering(weights), "lang string, vector binary, radius double"))
    if (many := centroids.count()) > MOST:
        raise ValueError(f"{many} centroids are more than a worker should hold")
    found = centroids.toPandas()
    found = found.sort_values(["lang", "radius", "vector"])  # CENTROIDS rows per language
    if not len(found):
        return None
    return Centroids(found["lang"].tolist(),
                     np.frombuffer(b"".join(found["vector"]), dtype="<f4").reshape(-1, BUCKETS),
                     found["radius"].to_numpy(), weights)


def _judging(broadcast):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Centroids | None = broadcast.value
        for block in row_blocks(parts):
            size = block.num_rows
            lettered = pc.match_substring_regex(pc.fill_null(plain_array(block.column("text")), ""),
                                                r"\p{L}").to_numpy(zero_copy_only=False)
            near, score = np.zeros(size, dtype=int), np.zeros(size)
            if model:
                for first, counts in counts_of(block.column("text")):
                    cosine = vectors(counts, model.weights) @ model.vectors.T
                    best = np.argmax(cosine, axis=1)
                    near[first:first + len(counts)] = best
                    score[first:first + len(counts)] = cosine[np.arange(len(counts)), best]
            known = lettered if model else np.zeros(size, dtype=bool)
            names = np.array([*(model.languages if model else ()), UNKNOWN], dtype=object)
            score = np.where(known, np.clip(score, 0, 1), 0)
            limit = SLACK * model.radii[near] if model else np.zeros(size)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("held_out"),
                 pa.array(names[np.where(known, near, len(names) - 1)], pa.string()), pa.array(score.astype(np.float64)),
                 pa.array(~known | (1 - score > np.maximum(limit, 1e-6)) | (score <= 0))],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"])
    return batches


def identify(docs: DataFrame, model: Centroids | None) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, rejected)`` per row of ``(doc_id, text)``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.expr(HELD_OUT).alias("held_out"), "text")
    return in_tasks(rows, _judging(docs.sparkSession.sparkContext.broadcast(model)),
                    "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def language_id(docs: DataFrame) -> DataFrame:
    return identify(docs, fit(docs))
