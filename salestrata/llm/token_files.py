"""Operator 1, token-id files: canonical length-limited Huffman coding.

A folder holds two Parquet tables.

``codebook``: ``(id, length)``, the code length of each id that occurs; the codes are
canonical, so nothing else is needed to read or write them.

``chunks``: one row per run of whole documents, of about ``CHUNK`` ids: ``part``
and ``seq`` give its place, ``ids_before`` the ids of its part in front of it, ``doc_ids`` and
``n_ids`` its documents, ``stream`` the codes of all their ids without gaps, and
``checkpoints`` the bit offset of every ``huffman.CHECKPOINT``-th id as
little-endian 64-bit numbers.  A reader may start at any checkpoint.

Parts, chunks in a part and documents in a chunk are in ascending order of doc_id
(null first; rows of one id by a hash of their text, then by its ids).  Each document's ids end with ``END``.

Writing: texts are encoded where they lie and their ids written, with the counts of all ids of a
task, in one pass.  The summed counts give the code; then the ids, not the texts, are sorted into ranges of
doc_id and coded.  The range bounds use the text's hash as well, so one id with many rows is spread over
parts.  Only the counts (at most one row per id of the vocabulary) and the sizes
of the parts reach the driver.

A null or empty text is the end id alone.  Repeated rows are written each, other
columns are not looked at, and an empty table gives an empty codebook and no chunks.  A long text
is one row and one chunk; it is encoded and coded in parts, and takes some six times its size in a task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestrata.llm import huffman
from salestrata.llm.bpe_chunks import BLOCK_BYTES, chunk_tokenizer
from salestrata.llm.shared import in_tasks, new_folder, remove
from salestrata.llm.textkit import row_blocks

END = 0
CHUNK = 1 << 20
_IDS = "doc_id long, hash long, ids binary, seen array<int>, times array<long>"
_CODED = ("part int, seq int, ids_before long, doc_ids array<long>, n_ids array<long>, "
          "stream binary, checkpoints binary")


def _tokenizing(path: str):
    """The ids of each text as one binary value; last, in a row of its own, the counts of all ids of the task."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = chunk_tokenizer(path)
        total = np.zeros(max(tokenizer.size, END + 1), dtype=np.int64)
        for block in row_blocks(parts, limit=BLOCK_BYTES):
            ids, counts = tokenizer.encode(block.column("text"))
            for low in range(0, len(ids), CHUNK):
                total += np.bincount(ids[low:low + CHUNK], minlength=len(total))
            total[END] += len(counts)
            none = pa.nulls(len(counts), pa.list_(pa.int32())), pa.nulls(len(counts), pa.list_(pa.int64()))
            bounds = np.concatenate(([0], np.cumsum(counts))) * ids.dtype.itemsize
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("hash"),
                 pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(ids)]),
                 *none], names=["doc_id", "hash", "ids", "seen", "times"])
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
             pa.array([seen], pa.list_(pa.int32())), pa.array([total[seen]], pa.list_(pa.int64()))],
            names=["doc_id", "hash", "ids", "seen", "times"])
    return batches


def _rows(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Row by row: a chunk is as much as a task holds at a time."""
    for part in parts:
        for i in range(part.num_rows):
            yield part.slice(i, 1).to_pylist()[0]


def _coding(broadcast, dtype: str):
    """Chunks of whole documents from rows in order."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = broadcast.value
        width = np.dtype(dtype).itemsize
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        for block in row_blocks(parts, "ids", CHUNK * width):
            column = block.column("ids")
            bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
            raw = column.buffers()[2]
            plain = np.frombuffer(raw[int(bounds[0]):int(bounds[-1])] if raw else b"", dtype)
            ends = (bounds[1:] - bounds[0]) // width
            counts = np.diff(ends, prepend=0).astype(np.int64) + 1
            stream, checkpoints = huffman.encode(book, np.insert(plain, ends, END))
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "ids_before": pa.array([before], pa.int64()),
                "doc_ids": pa.array([block.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                "n_ids": pa.array([counts], pa.list_(pa.int64())),
                "stream": pa.array([stream], pa.binary()),
                "checkpoints": pa.array([checkpoints.astype("<u8").tobytes()], pa.binary()),
            })
            seq, before = seq + 1, before + int(counts.sum())
    return batches


def write(docs: DataFrame, tokenizer: str, folder: str) -> None:
    """Writes the documents' ids to ``folder``."""
    spark = docs.sparkSession
    plain = new_folder(spark, "plain-ids")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text")
    in_tasks(texts, _tokenizing(tokenizer), _IDS).write.option("compression", "zstd").parquet(plain)
    rows = spark.read.schema(_IDS).parquet(plain)
    counted = (rows.where("seen is not null").select(F.explode(F.arrays_zip("seen", "times")).alias("x"))
               .groupBy("x.seen").agg(F.sum("x.times").alias("n")).toArrow())  # a row per id of the vocabulary
    ids = counted.column("seen").to_numpy()
    counts = np.zeros(int(ids.max(initial=-1)) + 1, dtype=np.int64)
    counts[ids] = counted.column("n").to_numpy()
    lengths = huffman.code_lengths(counts)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)],
                          "id int, length int").coalesce(1).write.parquet(f"{folder}/codebook")
    book = spark.sparkContext.broadcast(huffman.Codebook(lengths))
    order = ["doc_id", "hash", "ids"]
    ranged = rows.where("seen is null").select(*order).repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    _compact(in_tasks(ranged.select("doc_id", "ids"), _coding(book, chunk_tokenizer(tokenizer).dtype.str), _CODED),
             f"{folder}/chunks")
    remove(spark, plain)


def _compact(rows: DataFrame, folder: str) -> None:
    """Writes the rows, and lets go of the shuffle they came through when they are written."""
    spark = rows.sparkSession
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        rows.write.option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.set(key, before)


def _decoded(broadcast):
    """``(doc_id, start, ids)`` per document, chunk by chunk."""
    def documents(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        lengths, before = broadcast.value
        book = huffman.Codebook(lengths)
        table = book.table()
        for row in _rows(parts):
            counts = np.array(row["n_ids"], dtype=np.int64)
            ids = huffman.decode(book, table, row["stream"], np.frombuffer(row["checkpoints"], dtype="<u8"),
                                 int(counts.sum()))
            yield row["doc_ids"], before[row["part"]] + row["ids_before"], ids, counts
    return documents


def _opened(spark: SparkSession, folder: str):
    """The chunks, and what reading them takes: the code lengths, and how many ids the parts before have."""
    book = spark.read.schema("id int, length int").parquet(f"{folder}/codebook").toArrow()
    ids = book.column("id").to_numpy()
    lengths = np.zeros(int(ids.max(initial=-1)) + 1, dtype=np.uint8)
    lengths[ids] = book.column("length").to_numpy()
    chunks = spark.read.schema(_CODED).parquet(f"{folder}/chunks")
    sizes = (chunks.selectExpr("part", "aggregate(n_ids, 0L, (a, b) -> a + b) as n")
             .groupBy("part").agg(F.sum("n").alias("n")).collect())  # a row per part
    before, total = {}, 0
    for row in sorted(sizes, key=lambda r: r["part"]):
        before[row["part"]] = total
        total += row["n"]
    return chunks, spark.sparkContext.broadcast((lengths, before))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, ids)`` of the documents in ``folder``; start is how many ids the documents before have."""
    chunks, shared = _opened(spark, folder)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, start, ids, counts in _decoded(shared)(parts):
            offsets = np.concatenate(([0], np.cumsum(counts)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(start + offsets[:-1]),
                 pa.ListArray.from_arrays(offsets.astype(np.int32), ids.astype(np.int32))], names=["doc_id", "start", "ids"])
    return in_tasks(chunks, batches, "doc_id long, start long, ids array<int>")


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of the documents in ``folder``."""
    chunks, shared = _opened(spark, folder)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, start, ids, counts in _decoded(shared)(parts):
            offsets = np.concatenate(([0], np.cumsum(counts)))
            raw = memoryview(ids.astype("<u4")).cast("B")
            sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(start + offsets[:-1]), pa.array(counts),
                 pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return in_tasks(chunks, batches, "doc_id long, start long, n_tokens long, ids_crc32 long")
