"""Operator 11, cross-tokenizer alignment: which tokens of A and B cover the same bytes.

A is the byte-level tokenizer on a space and the text, B the pieces of the text, whose
first piece has that space.  Byte offsets where tokens of both end cut them into groups.  An A
and a B token are linked if their bytes overlap.

The work in a task is Arrow's: the id lists of a block are flattened beside their parent indices;
the cumulative sum of token lengths gives the ends of tokens, and as only documents with the
same bytes on both sides are there, one number is a document and an end in it.  A full
outer hash join of A's and B's ends, in order, has a row per link: a side that has
no end there goes on with its next token.  Rows with both ends close a group.

``align`` writes a table with one row per document and the distinct linked id pairs of
each.  ``pair_counts`` counts the documents of each pair: ``Table.group_by`` in a task, the
partial counts merged by Spark.  ``scored`` looks the counts up: the ``HELD`` most frequent
pairs go to the tasks, and the others, each rare, are joined in Spark.

A text longer than ``PART`` bytes is worked on in parts, cut at spaces that both tokenizers
begin a token with, so it takes the memory of a part and of its distinct pairs; a run
of that length without such a space is one part.  A null or empty text, and one whose tokens
spell other bytes (it holds U+2581), has no tokens: zeros and no groups.  Repeated rows are
documents each, ties of a count are all best, other columns are not looked at, and an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestrata.llm.bpe_chunks import chunk_tokenizer
from salestrata.llm.pieces import MARK, ids_of, piece_encoder
from salestrata.llm.shared import cut, in_tasks, stored
from salestrata.llm.textkit import row_blocks

PART = 1 << 20
HELD = 1 << 20
_PENDING = 1 << 21  # pairs of a task that wait for their counts
_SAFE = re.compile(rb"[!-~] (?=[^ ])")  # a space that begins a token of A and of B
_TABLE = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "pairs array<long>, links array<long>")
_KEPT = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1
    characters for themselves, the other bytes in order for the characters from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class _Side:
    """The bytes of each id, and its number in decimals."""

    def __init__(self, spelled: list[bytes]):
        self.bytes = pa.array(spelled, pa.large_binary())
        self.lengths = pc.binary_length(self.bytes)
        self.decimal = pa.array([str(i) for i in range(len(spelled))], pa.large_string())


@lru_cache(1)
def _sides(tokenizer: str, model: str):
    """Both encoders with their tables, one pair for all tasks of a worker."""
    a = chunk_tokenizer(tokenizer, plain=True)
    processor, table = piece_encoder(model)
    byte_of = byte_of_character()
    spelled_a = [b""] * a.size
    for piece, number in a.tokenizer.get_vocab().items():
        spelled_a[number] = bytes(byte_of.get(c, 0x3F) for c in piece)
    spelled_b = [bytes([int(piece[1:-1], 16)]) if processor.is_byte(i) else piece.replace(MARK, " ").encode()
                 for i, piece in ((i, processor.id_to_piece(i)) for i in range(processor.vocab_size()))]
    return a, table, _Side(spelled_a), _Side(spelled_b)


def _parts(text: bytes, part: int) -> Iterator[bytes]:
    """The text without the spaces it is cut at; each part follows a space, as the first one does."""
    low = 0
    while len(text) - low > part:
        found = _SAFE.search(text, low + part)
        if not found:
            break
        yield text[low:found.start() + 1]
        low = found.start() + 2
    yield text[low:]


def _spelled(side: _Side, ids: pa.Array, offsets: np.ndarray) -> pa.Array:
    """The bytes of each row's tokens."""
    tokens = side.bytes.take(ids)
    ends = np.frombuffer(tokens.buffers()[1], np.int64)[:len(tokens) + 1]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(ends[offsets].copy()), tokens.buffers()[2]])


def _scalar(text: str) -> pa.Scalar:
    return pa.scalar(text, pa.large_string())


def _rows_of(ids: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(offsets, ids).take(pa.array(rows))


def _joined(items: pa.Array, offsets: np.ndarray, by: str) -> pa.Array:
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, items), _scalar(by))


class Aligned:
    """A block of texts, all with the same bytes on both sides, as Arrow arrays."""

    def __init__(self, a: pa.LargeListArray, b: pa.LargeListArray, side_a: _Side, side_b: _Side):
        self.n = len(a)
        self.n_a, self.n_b = (pc.list_value_length(x).to_numpy() for x in (a, b))
        ids_a, ids_b = pc.list_flatten(a), pc.list_flatten(b)
        of_a = pc.list_parent_indices(a)
        self.ends_a = pc.cumulative_sum(side_a.lengths.take(ids_a))
        self.ends_b = pc.cumulative_sum(side_b.lengths.take(ids_b))
        left = pa.table({"end": self.ends_a, "a": pa.array(np.arange(len(ids_a)))})
        right = pa.table({"end": self.ends_b, "b": pa.array(np.arange(len(ids_b)))})
        both = left.join(right, "end", join_type="full outer", use_threads=False).sort_by("end")
        at_a, at_b = (both.column(c).combine_chunks() for c in ("a", "b"))
        closes = pc.and_(at_a.is_valid(), at_b.is_valid())
        self.last_a, self.last_b = (x.filter(closes).to_numpy() for x in (at_a, at_b))
        link_a, link_b = pc.fill_null_backward(at_a), pc.fill_null_backward(at_b)
        self.doc = of_a.take(link_a)  # of each link
        self.group_doc = of_a.to_numpy()[self.last_a]
        self.pair = pc.add(pc.multiply(ids_a.take(link_a).cast(pa.int64()), len(side_b.bytes)),
                           ids_b.take(link_b).cast(pa.int64()))
        self.ids_a, self.ids_b, self.side_a, self.side_b = ids_a, ids_b, side_a, side_b

    def counted(self, values) -> np.ndarray:
        return np.bincount(np.asarray(values), minlength=self.n)

    def pairs(self) -> pa.Table:
        """``(doc, pair, links)``, documents in order."""
        found = pa.table({"doc": self.doc, "pair": self.pair}).group_by(["doc", "pair"], use_threads=False).aggregate(
            [([], "count_all")]).rename_columns(["doc", "pair", "links"])
        return found.sort_by("doc")

    def groups(self) -> pa.Array:
        """The groups of each document: the ids of A and of B, in order."""
        sides = [_joined(side.decimal.take(ids), np.concatenate(([0], last + 1)), ",")
                 for side, ids, last in ((self.side_a, self.ids_a, self.last_a), (self.side_b, self.ids_b, self.last_b))]
        offsets = np.concatenate(([0], np.cumsum(self.counted(self.group_doc))))
        return _joined(pc.binary_join_element_wise(*sides, _scalar("|")), offsets, ";")


def _aligned(encoders, texts: pa.Array) -> tuple[np.ndarray, Aligned]:
    """The rows that have tokens, and their alignment."""
    a, table, side_a, side_b = encoders
    with_space = pc.binary_join_element_wise(_scalar(" "), texts, _scalar(""))
    ids_a, counts = a.encode(with_space)
    offsets_a = np.concatenate(([0], np.cumsum(counts)))
    ids_b, offsets_b = ids_of(table, texts)
    ids_a, ids_b = ids_a.astype(np.int32), ids_b.astype(np.int32)
    wanted = with_space.cast(pa.large_binary())
    same = pc.and_(pc.equal(_spelled(side_a, pa.array(ids_a), offsets_a), wanted),
                   pc.equal(_spelled(side_b, pa.array(ids_b), offsets_b), wanted))
    rows = np.flatnonzero(same.to_numpy(zero_copy_only=False))
    return rows, Aligned(_rows_of(ids_a, offsets_a, rows), _rows_of(ids_b, offsets_b, rows), side_a, side_b)


def _block_table(row: int, doc_ids: pa.Array, rows: np.ndarray, found: Aligned) -> pa.RecordBatch:
    """The result of whole documents; those not in ``rows`` have no tokens."""
    size = len(doc_ids)

    def spread(values) -> np.ndarray:
        out = np.zeros(size, dtype=np.int64)
        out[rows] = values
        return out

    pairs = found.pairs()
    offsets = np.concatenate(([0], np.cumsum(spread(found.counted(pairs.column("doc")))))).astype(np.int32)
    digests = [""] * size
    for i, text in zip(rows.tolist(), found.groups()):
        digests[i] = hashlib.sha256(text.as_buffer()).hexdigest()
    columns = [pa.array(row + np.arange(size)), doc_ids, pa.array(spread(found.n_a)), pa.array(spread(found.n_b)),
               pa.array(spread(found.counted(found.group_doc))), pa.array(spread(found.counted(found.doc))),
               pa.array(digests, pa.string())]
    lists = [pa.ListArray.from_arrays(offsets, pairs.column(c).combine_chunks()) for c in ("pair", "links")]
    return pa.RecordBatch.from_arrays(columns + lists, names=[*_KEPT, "pairs", "links"])


def _long_table(row: int, doc_ids: pa.Array, text: bytes, encoders, part: int) -> pa.RecordBatch:
    """The result of one document that is aligned in parts."""
    sums, digest, pairs = np.zeros(4, dtype=np.int64), hashlib.sha256(), None
    for number, piece in enumerate(_parts(text, part)):
        rows, found = _aligned(encoders, pa.array([piece.decode()], pa.large_string()))
        if not len(rows):
            sums, pairs, digest = np.zeros(4, dtype=np.int64), None, None
            break
        sums += [found.n_a[0], found.n_b[0], len(found.group_doc), len(found.doc)]
        digest.update((b";" if number else b"") + memoryview(found.groups()[0].as_buffer()).tobytes())
        own = found.pairs().select(["pair", "links"])
        pairs = own if pairs is None else pa.concat_tables([pairs, own]).group_by("pair", use_threads=False).aggregate(
            [("links", "sum")]).rename_columns(["pair", "links"])
    columns = [pa.array([row]), doc_ids, *(pa.array([int(x)]) for x in sums),
               pa.array([digest.hexdigest() if digest else ""])]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(pairs) if pairs else 0], pa.int32()),
                                      pairs.column(c).combine_chunks() if pairs else pa.array([], pa.int64()))
             for c in ("pair", "links")]
    return pa.RecordBatch.from_arrays(columns + lists, names=[*_KEPT, "pairs", "links"])


def _aligning(tokenizer: str, model: str, part: int):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _sides(tokenizer, model)
        row = TaskContext.get().partitionId() << 33
        for block in row_blocks(parts, limit=part):
            doc_ids = block.column("doc_id")
            texts = pc.fill_null(block.column("text").cast(pa.large_string()), "")
            if len(texts) == 1 and texts[0].as_buffer().size > part:
                yield _long_table(row, doc_ids, texts[0].as_buffer().to_pybytes(), encoders, part)
            else:
                full = np.flatnonzero(pc.binary_length(texts).to_numpy() > 0)
                rows, found = _aligned(encoders, texts.take(pa.array(full)))
                yield _block_table(row, doc_ids, full[rows], found)
            row += len(texts)
    return batches


def align(docs: DataFrame, tokenizer: str, model: str, part: int = PART) -> DataFrame:
    """One row per document, written in the shared folder: numbers of tokens, groups and links, the digest
    of the groups, and the distinct linked pairs (a times B's vocabulary, plus b) with their links."""
    rows = in_tasks(docs.selectExpr("cast(doc_id as long) as doc_id", "text"), _aligning(tokenizer, model, part), _TABLE)
    return stored(rows, "alignment")


def _counted(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])


def _counting(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: list[pa.Table] = []
    for part in parts:
        pairs = pc.list_flatten(part.column("pairs"))
        waiting.append(pa.table({"pair": pairs, "n": pa.array(np.ones(len(pairs), np.int64))}))
        if sum(map(len, waiting)) > _PENDING:
            waiting = [_counted(waiting)]
            if len(waiting[0]) > _PENDING // 2:  # mostly distinct: Spark merges them
                yield from waiting[0].to_batches()
                waiting = []
    if waiting:
        yield from _counted(waiting).to_batches()


def pair_counts(aligned: DataFrame, model: str) -> DataFrame:
    """``(pair, n, best)``: how many documents have the pair linked, and whether that is most for its A id."""
    size = len_of(model)
    counts = cut(in_tasks(aligned.select("pairs"), _counting, "pair long, n long")
                 .groupBy("pair").agg(F.sum("n").alias("n")))
    most = counts.groupBy(F.expr(f"pair div {size}").alias("a")).agg(F.max("n").alias("most"))
    return cut(counts.withColumn("of", F.expr(f"pair div {size}")).join(most, F.col("of") == F.col("a"))
               .selectExpr("pair", "n", "n = most as best"))


def len_of(model: str) -> int:
    """The size of B's vocabulary."""
    return piece_encoder(model)[0].vocab_size()


def _scoring(broadcast):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = broadcast.value
        held = pa.table({"pair": pair, "n": n, "best": best})
        for part in parts:
            if not part.num_rows:
                continue
            links = pa.table({"doc": pc.list_parent_indices(part.column("pairs")),
                              "pair": pc.list_flatten(part.column("pairs")), "links": pc.list_flatten(part.column("links"))})
            known = links.join(held, "pair", join_type="left outer", use_threads=False)
            links_of = known.column("links")
            weighed = known.select(["doc"]).append_column("count_sum", pc.multiply(links_of, pc.fill_null(known.column("n"), 0)))
            weighed = weighed.append_column("n_best", pc.multiply(links_of, pc.fill_null(known.column("best"), False).cast(pa.int64())))
            sums = weighed.group_by("doc", use_threads=False).aggregate([("count_sum", "sum"), ("n_best", "sum")])
            out = {name: np.zeros(part.num_rows, np.int64) for name in ("n_best", "count_sum")}
            for name, column in out.items():
                column[sums.column("doc").to_numpy()] = sums.column(f"{name}_sum").to_numpy()
            rare = known.filter(pc.is_null(known.column("n"))).select(["doc", "pair", "links"]).sort_by("doc")
            offsets = np.searchsorted(rare.column("doc").to_numpy(), np.arange(part.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(offsets, rare.column(c).combine_chunks()) for c in ("pair", "links")]
            yield pa.RecordBatch.from_arrays([part.column(c) for c in _KEPT] + [pa.array(x) for x in out.values()] + lists,
                                             names=[*_KEPT, *out, "pairs", "links"])
    return batches


def scored(aligned: DataFrame, counts: DataFrame, held: int = HELD) -> DataFrame:
    """The documents with ``n_best`` and ``count_sum`` over their links."""
    spark = aligned.sparkSession
    top = counts.orderBy(F.desc("n"), "pair").limit(held).toArrow()  # ``held`` rows of 17 bytes at most
    shared = spark.sparkContext.broadcast(tuple(top.column(c).combine_chunks() for c in ("pair", "n", "best")))
    schema = _TABLE.replace("pairs array", "n_best long, count_sum long, pairs array")
    found = in_tasks(aligned, _scoring(shared), schema)
    if counts.count() <= held:
        return found.drop("pairs", "links")
    found = stored(found, "alignment-scores")
    rare = counts.join(spark.createDataFrame(top.select(["pair"]).to_pandas(), "pair long"), "pair", "left_anti")
    more = (found.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x"))
            .selectExpr("row as of_row", "x.pairs as pair", "x.links as links").join(rare, "pair")
            .groupBy("of_row").agg(F.sum(F.expr("if(best, links, 0L)")).alias("more_best"),
                                   F.sum(F.expr("links * n")).alias("more_sum")))
    return found.join(more, F.col("row") == F.col("of_row"), "left").select(
        *_KEPT, F.expr("n_best + coalesce(more_best, 0)").alias("n_best"),
        F.expr("count_sum + coalesce(more_sum, 0)").alias("count_sum"))


def alignment(docs: DataFrame, tokenizer: str, model: str) -> DataFrame:
    """One row per document: ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    aligned = align(docs, tokenizer, model)
    return scored(aligned, pair_counts(aligned, model)).drop("row")
