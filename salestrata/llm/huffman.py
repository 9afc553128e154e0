"""Length-limited canonical Huffman codes over token ids, on numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MAX_BITS = 20
CHECKPOINT = 128  # ids from one bit-offset checkpoint to the next

_PAD = 8
_STEP = 1 << 20


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """The optimal code lengths of at most ``limit`` bits (package-merge); 0 for ids
    that do not occur.  At least as many bits as distinct ids need are allowed."""
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(len(used) - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    # Level by level: the ids' weights, and pairs of the level below, in order.
    leaves, packages = [], np.zeros(0)
    for _ in range(limit):
        merged = np.concatenate((weights, packages))
        rank = np.argsort(merged, kind="stable")
        leaves.append(rank < len(weights))
        merged = merged[rank]
        packages = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    # An id is as long as the number of levels it is chosen on; the lightest are chosen first.
    chosen = 2 * len(order) - 2
    for leaf in reversed(leaves):
        n = int(leaf[:chosen].sum())
        lengths[order[:n]] += 1
        chosen = 2 * (chosen - n)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes by rising length, and by id within a length."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    code, before = 0, 0
    for bits in range(1, int(lengths.max(initial=0)) + 1):
        code <<= bits - before
        before = bits
        ids = np.flatnonzero(lengths == bits)
        codes[ids] = code + np.arange(len(ids), dtype=np.uint64)
        code += len(ids)
    return codes


@dataclass
class Codebook:
    """The lengths are all a reader needs; codes and decoding table follow from them."""

    lengths: np.ndarray

    def __post_init__(self):
        self.codes = canonical_codes(self.lengths)
        self.bits = max(int(self.lengths.max(initial=0)), 1)

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """By the next ``bits`` bits: the id they begin with, and its length."""
        ids = np.flatnonzero(self.lengths)
        ids = ids[np.lexsort((ids, self.lengths[ids]))]
        runs = np.left_shift(np.int64(1), (self.bits - self.lengths[ids]).astype(np.int64))
        symbols = np.zeros(1 << self.bits, dtype=np.uint32)
        steps = np.zeros(1 << self.bits, dtype=np.uint8)
        filled = int(runs.sum())
        symbols[:filled] = np.repeat(ids, runs)
        steps[:filled] = np.repeat(self.lengths[ids], runs)
        return symbols, steps


def encode(book: Codebook, ids: np.ndarray, every: int = CHECKPOINT) -> tuple[bytes, np.ndarray]:
    """The bit stream of the ids, and the bit offset of every ``every``-th id.  Codes are put into their
    places ``_STEP`` ids at a time."""
    if not len(ids):
        return b"", np.zeros(0, dtype=np.uint64)
    lengths = book.lengths[ids]
    if not lengths.all():
        raise ValueError("an id without a code")
    bits = int(lengths.sum(dtype=np.int64))
    words = np.zeros((bits >> 6) + 2, dtype=np.uint64)
    checkpoints, before = [], 0
    for low in range(0, len(ids), _STEP):
        length = lengths[low:low + _STEP].astype(np.int64)
        end = before + np.cumsum(length)
        start = end - length
        code = book.codes[ids[low:low + _STEP]]
        word = start >> 6
        room = 64 - (start & 63) - length  # below 0: the code runs into the next word
        here = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64),
                        code >> np.maximum(-room, 0).astype(np.uint64))
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        words[word[first]] |= np.bitwise_or.reduceat(here, first)
        over = np.flatnonzero(room < 0)
        words[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
        checkpoints.append(start[-low % every::every].astype(np.uint64))
        before = int(end[-1])
    return words.astype(">u8").tobytes()[:(bits + 7) >> 3], np.concatenate(checkpoints)


def decode(book: Codebook, table: tuple[np.ndarray, np.ndarray], stream: bytes,
           checkpoints: np.ndarray, n: int, every: int = CHECKPOINT) -> np.ndarray:
    """The n ids.  All blocks between checkpoints are read side by side, an id of each
    at a time; any one of them can be read alone."""
    symbols, steps = table
    data = np.frombuffer(stream + bytes(_PAD), dtype=np.uint8)
    words = np.ndarray((len(data) - _PAD + 1,), dtype=">u8", buffer=data, strides=(1,))
    at = checkpoints.astype(np.int64)
    out = np.zeros((every, len(at)), dtype=np.uint32)
    shift = np.uint64(64 - book.bits)
    last = len(words) - 1
    for i in range(every if len(at) else 0):
        ahead = words[np.minimum(at >> 3, last)].astype(np.uint64) << (at & 7).astype(np.uint64)
        peek = ahead >> shift
        out[i] = symbols[peek]
        at += steps[peek]
    return out.T.reshape(-1)[:n]
