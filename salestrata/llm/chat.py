"""Operator 8, chat formatting by token-level assembly.

A turn is a begin marker, the text and an end marker:

    system     <<SYS>> text </s>
    user       [INST] text [/INST]
    assistant  <s> text </s>
    other      [ROLE] role [/ROLE] text </s>

(without the spaces).  Markers are control strings with reserved ids above the
tokenizer's own.  In texts and roles a backslash is doubled, and one is put
behind the first character of each control string, so none occurs there;
``unescape`` takes that back.  Escaped segments are encoded each by itself, the reserved
ids are spliced in between, and the loss mask is the prefix sum of +1 where an
assistant's text begins and -1 where it ends: it covers the ids of assistant texts and no marker.

Turns are in order of turn (null first), then role and text.  The rows are sorted
into ranges by conversation and turn, so a conversation of any length is spread
over tasks; the result has pages of at most ``PAGE`` turns of one conversation, in order of
``(part, page)``.

A null text is empty, a null role is the empty role, and both read back so.  A
null conv_id is a conversation of its own.  Repeated rows are turns each, other
columns are not looked at, and an empty table gives an empty result.  A page holds whole texts,
however long.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestrata.llm.shared import in_tasks

# Fixed values of the template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "[ROLE]", "[/ROLE]")
BEGIN = {"system": "<<SYS>>", "user": "[INST]", "assistant": "<s>"}
END = {"user": "[/INST]"}
LAST = "</s>"
OTHER, OTHER_END = "[ROLE]", "[/ROLE]"
LEARNT = "assistant"

PAGE = 256
_PAGES_AT_ONCE, _IDS = 64, 1 << 18  # pages in a batch, ids after which it ends
_CONTROL = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_PAGES = "conv_id long, part int, page int, n_turns int, ids array<int>, loss_mask array<byte>"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Template:
    """The template over a byte-level tokenizer given as a file of ranks."""

    def __init__(self, ranks: str, pattern: str):
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        first = max(table.values(), default=-1) + 1
        self.reserved = {control: first + i for i, control in enumerate(CONTROLS)}
        self.control_of = {number: control for control, number in self.reserved.items()}
        self.first_reserved = first

    def page(self, turns: Iterable[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the turns and their loss mask."""
        segments: list[str | int] = []  # escaped text, or a reserved id
        learnt: list[int] = []  # which segments are learnt
        for role, text in turns:
            if role in BEGIN:
                segments.append(self.reserved[BEGIN[role]])
            else:
                segments += [self.reserved[OTHER], escape(role), self.reserved[OTHER_END]]
            if role == LEARNT:
                learnt.append(len(segments))
            segments += [escape(text), self.reserved[END.get(role, LAST)]]
        texts = [i for i, s in enumerate(segments) if isinstance(s, str)]
        parts: list[list[int]] = [[s] if isinstance(s, int) else [] for s in segments]
        for i in texts:
            parts[i] = self.encoding.encode_ordinary(segments[i])
        ends = np.cumsum([len(p) for p in parts])
        change = np.zeros(int(ends[-1]) + 1, dtype=np.int64)
        np.add.at(change, ends[learnt] - [len(parts[i]) for i in learnt] if learnt else [], 1)
        np.add.at(change, ends[learnt] if learnt else [], -1)
        return np.array(list(chain.from_iterable(parts)), dtype=np.int32), np.cumsum(change[:-1]).astype(np.int8)

    def render(self, ids: np.ndarray) -> str:
        """The formatted text."""
        return "".join(s if isinstance(s, str) else self.control_of[s[0]] for s in self._segments(ids))

    def read_back(self, ids: np.ndarray, mask: np.ndarray) -> tuple[list[tuple[str, str]], str, int]:
        """The turns, the text under the mask, unescaped, and the length of the formatted text; each
        segment between reserved ids is decoded once."""
        reserved = np.flatnonzero(ids >= self.first_reserved)
        learnt = np.concatenate(([0], np.cumsum(mask > 0)))
        segments: list[str | tuple[int]] = []
        under: list[str] = []
        low = n_chars = 0
        for high in [*reserved.tolist(), len(ids)]:
            if high > low:
                text = self.encoding.decode_bytes(ids[low:high].tolist()).decode()
                n_chars += len(text)
                segments.append(text)
                covered = learnt[high] - learnt[low]
                if covered == high - low:
                    under.append(unescape(text))
                elif covered:
                    raise ValueError("a mask ends within a segment")
            if high < len(ids):
                segments.append((int(ids[high]),))
                n_chars += len(self.control_of[int(ids[high])])
            low = high + 1
        return list(self._turns(segments)), "".join(under), n_chars

    def turns(self, ids: np.ndarray) -> Iterator[tuple[str, str]]:
        """The turns that the ids stand for, unescaped."""
        return self._turns(self._segments(ids))

    def _turns(self, segments: Iterable[str | tuple[int]]) -> Iterator[tuple[str, str]]:
        role_of = {begin: role for role, begin in BEGIN.items()}
        role, text = None, ""
        for segment in segments:
            if isinstance(segment, str):
                text = unescape(segment)
                continue
            control = self.control_of[segment[0]]
            if control == OTHER_END:
                role, text = text, ""
            elif control in role_of or control == OTHER:
                role, text = role_of.get(control), ""
            else:
                yield role, text
                text = ""

    def learnt(self, ids: np.ndarray, mask: np.ndarray) -> str:
        """The text under the mask, unescaped."""
        return unescape(self.encoding.decode_bytes(ids[mask > 0].tolist()).decode())

    def _segments(self, ids: np.ndarray) -> Iterator[str | tuple[int]]:
        at = np.flatnonzero(ids >= self.first_reserved)
        low = 0
        for i in [*at.tolist(), len(ids)]:
            if i > low:
                yield self.encoding.decode_bytes(ids[low:i].tolist()).decode()
            if i < len(ids):
                yield (int(ids[i]),)
            low = i + 1


@lru_cache(1)
def template_of(ranks: str, pattern: str) -> Template:
    """One for all tasks of a worker."""
    return Template(ranks, pattern)


def _paging(ranks: str, pattern: str):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, part, page = template_of(ranks, pattern), TaskContext.get().partitionId(), 0
        conv, turns = None, []
        done: list[tuple] = []

        def close() -> None:
            nonlocal page
            done.append((conv, page, len(turns), *template.page(turns)))
            page += 1

        for rows in parts:
            for own, role, text in zip(*(rows.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if turns and (own != conv or len(turns) == PAGE):
                    close()
                    turns = []
                    if len(done[-1][3]) > _IDS or len(done) == _PAGES_AT_ONCE:
                        yield _page_batch(part, done)
                        done = []
                conv = own
                turns.append((role, text))
        if turns:
            close()
        if done:
            yield _page_batch(part, done)
    return batches


def _page_batch(part: int, pages: list[tuple]) -> pa.RecordBatch:
    convs, numbers, sizes, ids, masks = zip(*pages)
    offsets = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(convs, pa.int64()), pa.array([part] * len(pages), pa.int32()), pa.array(numbers, pa.int32()),
         pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(offsets, np.concatenate(ids)),
         pa.ListArray.from_arrays(offsets, np.concatenate(masks))],
        names=["conv_id", "part", "page", "n_turns", "ids", "loss_mask"])


def format_chats(conversations: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``(conv_id, part, page, n_turns, ids, loss_mask)`` from rows of ``(conv_id, turn, role, text)``."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("conv_id", "turn", "role").sortWithinPartitions("conv_id", "turn", "role", "text")
    return in_tasks(ordered.select("conv_id", "role", "text"), _paging(ranks, pattern), _PAGES)


_DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
            "formatted_chars long")


def _digesting(ranks: str, pattern: str):
    """Digests over pages in order; only running hashes are held between pages."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = template_of(ranks, pattern)
        done: list[tuple] = []
        conv, state = None, None

        def row():
            return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        for pages in parts:
            for i in range(pages.num_rows):
                own = pages.column("conv_id")[i].as_py()
                ids = pages.column("ids")[i].values.to_numpy()
                mask = pages.column("loss_mask")[i].values.to_numpy()
                if state is None or own != conv:
                    if state is not None:
                        done.append(row())
                    conv, state = own, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns, learnt, n_chars = template.read_back(ids, mask)
                state[0] += len(turns)
                state[1].update("".join([f"{role}\n{text}\n" for role, text in turns]).encode())
                state[2] += len(learnt)
                state[3].update(learnt.encode())
                state[4] += n_chars
            yield _digest_batch(done)
            done = []
        if state is not None:
            yield _digest_batch([row()])
    return batches


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 6
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                      names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def chat_digests(pages: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per conversation, read back from its pages: the turns, the learnt text, the length of the formatted text."""
    ordered = pages.repartition("conv_id").sortWithinPartitions("conv_id", "part", "page")
    return in_tasks(ordered.select("conv_id", "ids", "loss_mask"), _digesting(ranks, pattern), _DIGESTS)
