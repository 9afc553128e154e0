"""Operator 7, SentencePiece encoding and decoding with a table of distinct chunks.

No piece has a space marker after another character.  So a text falls apart, in front of each run
of spaces, into marked words that are segmented independently.  Each block of
documents is cut into such chunks, every distinct chunk is encoded once with the
library, and a document's ids are those of its chunks, joined by their position.
The table of distinct chunks is a Python worker's own, of bounded size, so nothing is shuffled.

The result is that of the library's ``encode`` of the whole text with an end id,
and of its ``decode`` of all ids.  The model must not change, trim or join what it
reads beyond marking spaces (checked when it is loaded).  A null text counts as
empty: the end id alone.  Repeated rows are encoded each, other columns are not
looked at, and an empty table gives an empty result.  A text of any length is encoded whole in
one task, in parts of some ``BLOCK_BYTES`` between chunks; it takes some thirteen times its size there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from salestrata.llm.chunk_table import ChunkTable
from salestrata.llm.shared import in_tasks
from salestrata.llm.textkit import Texts, row_blocks, texts_of

MARK = "▁"
_MARK_BYTES = MARK.encode()
# Ids pass through the library as lists of Python numbers, some fifty bytes for a byte of text.
BLOCK_BYTES = 1 << 20
CHUNKS = 200_000


def load(model: str) -> sentencepiece.SentencePieceProcessor:
    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = (processor.id_to_piece(i) for i in range(processor.vocab_size()))
    if any(MARK in piece.lstrip(MARK) for piece in pieces):
        raise ValueError("a piece of this model crosses a space marker")
    probe = "  A   b ﬁ\n\n C\t "
    if processor.normalize(probe) != MARK + probe.replace(" ", MARK):
        raise ValueError("this model changes text before it is segmented")
    return processor


def chunk_starts(texts: Texts) -> np.ndarray:
    """Where chunks begin: at each text's start, and at a space after another
    character, unless that character is a marker itself."""
    data = texts.data[:texts.offsets[-1]]
    space = data == 0x20
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[1:-1] = space[1:] & ~space[:-1]
    at = np.flatnonzero(cut[3:-1] & (data[2:-1] == _MARK_BYTES[2])) + 3
    marked = at[(data[at - 2] == _MARK_BYTES[1]) & (data[at - 3] == _MARK_BYTES[0])]
    cut[marked] = False
    cut[texts.offsets] = True
    cut[-1] = False
    return np.flatnonzero(cut)


def chunk_table(processor: sentencepiece.SentencePieceProcessor) -> ChunkTable:
    """The ids of chunks without the space that their mark stands for."""
    mark = processor.piece_to_id(MARK)

    def encode(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # an empty chunk is the mark alone, which the library does not set in an empty text
        found = [ids or [mark] for ids in processor.encode([c.decode() for c in chunks], num_threads=1)]
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(lengths.sum())), lengths
    return ChunkTable(encode, CHUNKS)


@lru_cache(1)
def piece_encoder(model: str) -> tuple[sentencepiece.SentencePieceProcessor, ChunkTable]:
    """One for all tasks of a worker."""
    processor = load(model)
    return processor, chunk_table(processor)


def ids_of(table: ChunkTable, column, continued: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The ids of every text one after the other, and where each text's begin; the last place is their number.
    ``continued`` texts are later parts of a text, which begin with a chunk of it."""
    texts = texts_of(column)
    starts = chunk_starts(texts)
    # The chunks as Arrow binaries over the block's own bytes.
    bounds = np.append(starts, texts.offsets[-1]).astype(np.int64)
    chunks = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                   [None, pa.py_buffer(bounds), pa.py_buffer(texts.data)]).dictionary_encode()
    codes = chunks.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # The library marks a text's start as if a space stood there: a chunk's own first space is that mark.
    distinct = [raw[1:] if raw[:1] == b" " else raw for raw in chunks.dictionary.to_pylist()]
    first_of = np.searchsorted(starts, texts.offsets)
    # a text that begins with a space has it besides the mark
    for row in np.flatnonzero(np.diff(first_of)) if not continued else ():
        if texts.data[texts.offsets[row]] == 0x20:
            chunk = first_of[row]
            codes[chunk] = len(distinct)
            distinct.append(texts.data[bounds[chunk]:bounds[chunk + 1]].tobytes())
    joined, lengths = table.joined(table.rows(distinct)[codes])
    return joined, np.concatenate(([0], np.cumsum(lengths)))[first_of]


def encode_block(table: ChunkTable, end: int, column) -> pa.ListArray:
    """The ids of every text, the end id last."""
    joined, total = ids_of(table, column)
    with_end = np.insert(joined.astype(np.int32), total[1:], end)
    return pa.ListArray.from_arrays((total + np.arange(len(total))).astype(np.int32), with_end)


def _parts(column) -> Iterator[pa.Array]:
    """One text in parts of some ``BLOCK_BYTES``, each of whole chunks."""
    texts = texts_of(column)
    starts, size = chunk_starts(texts), int(texts.offsets[-1])
    at = np.searchsorted(starts, np.arange(BLOCK_BYTES, size, BLOCK_BYTES))
    bounds = [0, *np.unique(starts[at[at < len(starts)]]).tolist(), size]
    for low, high in zip(bounds[:-1], bounds[1:]):
        edges = pa.py_buffer(np.array([low, high], dtype=np.int64))
        yield pa.Array.from_buffers(pa.large_string(), 1, [None, edges, pa.py_buffer(texts.data)])


def _long_text(processor: sentencepiece.SentencePieceProcessor, table: ChunkTable,
               column, decode: bool) -> tuple[pa.ListArray, list[str]]:
    """The ids of one long text, and the text of them, made part by part.  The library takes the first space
    of what it decodes for a mark: each later part begins with one that is a space of the text."""
    found, decoded = [], []
    for number, part in enumerate(_parts(column)):
        ids, _ = ids_of(table, part, continued=number > 0)
        found.append(ids.astype(np.int32))
        if decode:
            decoded.append(" " * (number > 0) + processor.decode(ids.tolist()))
    flat = np.concatenate([*found, np.array([processor.eos_id()], dtype=np.int32)])
    return pa.ListArray.from_arrays(np.array([0, len(flat)], dtype=np.int32), flat), ["".join(decoded)]


def _encoded(model: str, decode: bool):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor, table = piece_encoder(model)
        for block in row_blocks(parts, limit=BLOCK_BYTES):
            text = block.column("text")
            if len(text) == 1 and (pc.binary_length(text)[0].as_py() or 0) > BLOCK_BYTES:
                ids, decoded = _long_text(processor, table, text, decode)
            else:
                ids = encode_block(table, processor.eos_id(), text)
                if decode:
                    flat, offsets = ids.values.to_numpy().tolist(), ids.offsets.to_numpy().tolist()
                    decoded = processor.decode([flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])], num_threads=1)
            columns = {"doc_id": block.column("doc_id"), "ids": ids}
            if decode:
                columns["decoded"] = pa.array(decoded, pa.string())
            yield pa.RecordBatch.from_pydict(columns)
    return batches


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, ids)``: the ids of each whole text with the end id."""
    return in_tasks(docs.selectExpr("cast(doc_id as long) as doc_id", "text"), _encoded(model, False),
                    "doc_id long, ids array<int>")


def encode_and_decode(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, ids, decoded)``."""
    return in_tasks(docs.selectExpr("cast(doc_id as long) as doc_id", "text"), _encoded(model, True),
                    "doc_id long, ids array<int>, decoded string")


def _digested(model: str, keep_ids: bool):
    """The same rows, with digests in place of the decoded texts."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _encoded(model, True)(parts):
            ids = block.column("ids")
            said = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, ids.values.cast(pa.string())), " ")
            columns = [block.column("doc_id"), pc.list_value_length(ids).cast(pa.int64()),
                       _sha256(said), _sha256(block.column("decoded"))]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays(columns + [ids] * keep_ids, names=names + ["ids"] * keep_ids)
    return batches


def _sha256(texts: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in texts], pa.string())


def token_digests(docs: DataFrame, model: str, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, and the ids if asked for."""
    return in_tasks(docs.selectExpr("cast(doc_id as long) as doc_id", "text"), _digested(model, keep_ids),
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
                    + ", ids array<int>" * keep_ids)
