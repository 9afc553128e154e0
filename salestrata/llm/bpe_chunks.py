"""Byte-level BPE over the distinct chunks of texts.

The pattern in front of the merges never has white space after another character
in one piece, nor a letter and a mark other than an apostrophe.  So a text falls
apart in front of each ASCII white space that follows a character that is no
white space, and in front of ASCII marks after a letter.  Each distinct chunk
that a worker meets is encoded once with the library; the ids of a text are
those of its chunks in order.  The string of an added token in a text is that token, as
for the library: texts are cut in front of and behind it first.  With ``plain`` it is
text like any other (the library's ``encode_special_tokens``).

A single text of more than ``PART_BYTES`` is encoded in parts of that size, cut where chunks are.
Text without any such place, as in scripts without spaces, is one chunk of any length.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from salestrata.llm.chunk_table import ChunkTable
from salestrata.llm.textkit import Texts, texts_of

# Kinds of bytes, and the pairs of kinds with a cut between them.
_OTHER, _WHITE, _LETTER, _MARK, _PRINTED, _HIGH = range(6)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[0x21:0x7F] = _PRINTED
_KIND[[0x20, *range(0x09, 0x0E)]] = _WHITE
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[list(b"!\"#$%&()*+,-./:;<=>?@[]{}|~")] = _MARK
_KIND[0x80:] = _HIGH
_CUT = np.zeros(64, dtype=bool)
_CUT[[8 * _LETTER + _WHITE, 8 * _MARK + _WHITE, 8 * _PRINTED + _WHITE]] = True
_CUT[8 * _LETTER + _MARK] = True  # an apostrophe is no mark: it may begin a piece with letters of its own
_LATIN = 0xC3  # first byte of U+00C0 to U+00FF, none of which is white space
BLOCK_BYTES = 8 << 20
PART_BYTES = 4 << 20
_LOOK = 1 << 16  # bytes searched for a cut at a time
_TOGETHER = 256  # chunks in one text for the library
_TEXTS = 32  # texts in one call
MOST = 600_000


def _cuts(data: np.ndarray, low: int, high: int) -> np.ndarray:
    """The places from ``low``, at least 1, to before ``high`` where a chunk begins."""
    kind = _KIND[data[low - 1:high]]
    before, here = kind[:-1], kind[1:]
    cut = _CUT[(before << 3) | here]
    wide = np.flatnonzero((here == _WHITE) & (before == _HIGH))
    cut[wide[data[wide + low - 2] == _LATIN]] = True
    return np.flatnonzero(cut) + low


@lru_cache(1)
def chunk_tokenizer(path: str, plain: bool = False) -> ChunkTokenizer:
    """One for all tasks of a worker, so that its table serves all of them."""
    return ChunkTokenizer(path, plain)


def _added(tokenizer: Tokenizer) -> re.Pattern | None:
    """The strings of the added tokens, the longest of those that begin at one place."""
    tokens = json.loads(tokenizer.to_str())["added_tokens"]
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or (t["normalized"] and tokenizer.normalizer) for t in tokens):
        raise ValueError("this tokenizer's added tokens reach beyond their strings")
    strings = sorted((t["content"].encode() for t in tokens if t["content"]), key=len, reverse=True)
    return re.compile(b"|".join(map(re.escape, strings))) if strings else None


class ChunkTokenizer:
    def __init__(self, path: str, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks run side by side already
        self.tokenizer = Tokenizer.from_file(path)
        self.added = None if plain else _added(self.tokenizer)
        self.tokenizer.encode_special_tokens = plain
        self.size = self.tokenizer.get_vocab_size()
        # A byte is one character of a piece of a byte-level vocabulary.
        self.bytes_of = np.zeros(self.size, dtype=np.int64)
        for piece, number in self.tokenizer.get_vocab().items():
            self.bytes_of[number] = len(piece)
        # Sixteen bits are enough for most vocabularies.
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.table = ChunkTable(self._encode_distinct, MOST, self.dtype)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_distinct(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunks, and how many each has."""
        lengths = np.zeros(len(chunks), dtype=np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        # Chunks that begin with ASCII white space and end otherwise may follow each other.
        joint = [i for i, c in enumerate(chunks) if _KIND[c[0]] == _WHITE and 0x21 <= c[-1] < 0x7F]
        groups = [joint[low:low + _TOGETHER] for low in range(0, len(joint), _TOGETHER)]
        for low in range(0, len(groups), _TEXTS):
            some = groups[low:low + _TEXTS]
            for group, found in zip(some, self._ids([b"".join([chunks[i] for i in g]).decode() for g in some])):
                ids = np.array(found, dtype=self.dtype)
                ends = np.cumsum(self.bytes_of[ids])
                wanted = np.cumsum([len(chunks[i]) for i in group])
                at = np.searchsorted(ends, wanted) + 1
                if ends[-1] != wanted[-1] or (ends[at - 1] != wanted).any():
                    raise ValueError("this tokenizer's pieces cross chunks")
                lengths[group] = np.diff(at, prepend=0)
                parts.append((np.array(group), ids))
        is_alone = np.ones(len(chunks), dtype=bool)
        is_alone[joint] = False
        alone = np.flatnonzero(is_alone)
        each = self._ids([chunks[i].decode() for i in alone.tolist()])
        lengths[alone] = [len(x) for x in each]
        parts.append((alone, np.array([i for x in each for i in x], dtype=self.dtype)))
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        out = np.zeros(int(offsets[-1]), dtype=self.dtype)
        for members, ids in parts:
            n = lengths[members]
            out[np.repeat(offsets[members] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return out, lengths

    def _added_in(self, texts: Texts) -> list[tuple[int, int]]:
        """Where the strings of added tokens stand; none begins in one text and ends in another."""
        if self.added is None or not self.added.search(texts.data):
            return []
        at = texts.offsets.tolist()
        return [(m.start(), m.end()) for a, b in zip(at[:-1], at[1:]) for m in self.added.finditer(texts.data, a, b)]

    def _parts(self, texts: Texts) -> Iterator[Texts]:
        """One text in parts of ``PART_BYTES`` or little more, each of whole chunks and added tokens."""
        size = int(texts.offsets[-1])
        begins, ends = np.array(self._added_in(texts), dtype=np.int64).reshape(-1, 2).T
        low = 0
        while low < size:
            high, at = size, low + PART_BYTES
            while at < size:
                until = min(at + _LOOK, size)
                found = _cuts(texts.data, at, until)
                around = np.searchsorted(begins, found) - 1  # the last added token that begins before
                if len(begins):
                    found = found[(around < 0) | (ends[around] <= found)]
                    edges = np.concatenate((begins, ends))
                    found = np.union1d(found, edges[(edges >= at) & (edges < until)])
                if len(found):
                    high = int(found[0])
                    break
                at = until
            yield Texts(texts.data[low:high], np.array([0, high - low], dtype=np.int64))
            low = high

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a block of texts, one after the other, and how many each has."""
        texts = texts_of(column)
        if len(texts) != 1 or texts.offsets[-1] <= PART_BYTES:
            return self._encode(texts)
        ids = np.concatenate([self._encode(part)[0] for part in self._parts(texts)])
        return ids, np.array([len(ids)], dtype=np.int64)

    def _encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        data = texts.data[:texts.offsets[-1]]
        cut = np.zeros(len(data) + 1, dtype=bool)
        if len(data) > 1:
            cut[_cuts(data, 1, len(data))] = True
        for low, end in self._added_in(texts):
            cut[low:end] = False
            cut[[low, end]] = True
        cut[texts.offsets] = True
        cut[-1] = False
        starts = np.flatnonzero(cut)
        bounds = np.append(starts, len(data)).astype(np.int64)
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                       [None, pa.py_buffer(bounds), pa.py_buffer(texts.data)]).dictionary_encode()
        codes = chunks.indices.to_numpy(zero_copy_only=False)
        joined, lengths = self.table.joined(self.table.rows(chunks.dictionary.to_pylist())[codes])
        total = np.concatenate(([0], np.cumsum(lengths)))[np.searchsorted(starts, texts.offsets)]
        return joined, np.diff(total)
