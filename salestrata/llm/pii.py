"""Operator 13, personal data by a semi-Markov conditional random field.

Rules find addresses, IP numbers, cards and phones that are written by the book
(``pii_rules``).  Their spans stay.  The model adds those written otherwise: ``a [at] b
[dot] org``, ``10[.]0[.]0[.]1``, a card number with other marks between, a phone number without
its plus sign.

A stretch of text around an address sign or many digits is cut into tokens.  A segmentation
covers them with outside tokens and with entities of at most ``MAX_TOKENS`` tokens, each with
a kind.  Its score is the sum of what its segments score by their whole-span
features (form of the span, numbers and sums of its digits, marks between, what
stands on both sides) and of the transitions between their kinds.  Dynamic programming
over the ends of segments finds boundaries and kinds together; as entities are bounded, only so
many earlier places are held, whatever the length of the stretch.

The weights maximise the likelihood of segmentations, with a penalty, on a bounded sample:
of each kind, and of stretches without any, the ``SAMPLE`` distinct stretches with the least
hash of their bytes, the rules' spans being the answer; and of each of these the same
stretches written otherwise, by ``variants``, which also breaks check sums and ranges, the answer
then being that nothing is there.  An added span must beat its tokens being outside by
``MARGIN``, and overlaps no span of the rules.

A null or empty text has no spans.  Repeated rows are answered each, among equal
segmentations the one with the earlier and more outside tokens counts, other columns are not looked at, and an
empty table gives an empty result.  A text of any length is read whole in one task, a stretch of any length
with ``MAX_TOKENS`` places held.
"""

from __future__ import annotations

import heapq
import random
import re
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestrata.llm.pii_rules import (
    KINDS,
    DigitRuns,
    base_spans,
    code_points,
    luhn,
    stretches,
)
from salestrata.llm.shared import cut, in_tasks
from salestrata.llm.textkit import row_blocks, texts_of

MAX_TOKENS = 24
MAX_BYTES = 96
SAMPLE = 60
MARGIN = 2.0
OUTSIDE = 0  # labels: outside, then the kinds from 1
LABELS = 1 + len(KINDS)
_STEPS, _RATE, _PENALTY = 45, 0.15, 0.02
_SHORT = 220  # bytes: longer stretches are not sampled

_TOKEN = re.compile(rb"[A-Za-z]+|[0-9]+|[\x80-\xff]+|[ \t]+|[\n\r\x0b\x0c]+|.", re.DOTALL)
# Words in front of a span that count as features of their own; fixed values.
_CUES = frozenset((b"tel", b"phone", b"call", b"fax", b"mobile", b"mail", b"email", b"ip", b"address", b"card", b"visa"))
_FIRST = re.compile(rb"[A-Za-z0-9+(]")
_RUNS = ("a", "d")  # a span does not begin or end between two of them


def tokens(raw: bytes) -> list[bytes]:
    return _TOKEN.findall(raw)


def _kind(token: bytes | None) -> str:
    """The class of a token, the token itself if it is a mark."""
    if token is None:
        return "edge"
    c = token[0]
    if 0x30 <= c <= 0x39:
        return "d"
    if 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A:
        return "a"
    if c >= 0x80:
        return "u"
    if c in b" \t":
        return " " if len(token) == 1 else "  "
    return "\n" if c in b"\n\r\x0b\x0c" else chr(c)


_WORDS = {b"at": "at", b"dot": "dot"}
_BRACKETS = (b"[", b"(", b"{", b"<")
_SPACED = [[bracket, b" "] for bracket in _BRACKETS]


def signature(items: list[bytes], low: int, high: int) -> tuple | None:
    """All that the features of the span ``items[low:high]`` are made of; nothing for a span that
    can't be an entity."""
    form, fine, digits = [], [], []
    signs = dots = 0
    spelled = any(token.lower() == b"dot" for token in items[low + 1:high - 1])
    for i in range(low, high):
        token = items[i]
        kind = _kind(token)
        # "at" stands for the sign in brackets, or where a dot is spelled too
        if kind == "a" and low < i < high - 1 and token.lower() in _WORDS and (
                spelled or items[i - 1][-1:] in _BRACKETS or items[i - 2:i] in _SPACED):
            kind = _WORDS[token.lower()]
        if kind == "d":
            digits.append(token)
            fine.append(f"d{min(len(token), 9)}")
        else:
            fine.append(kind)
        form.append(kind)
        signs += kind in ("@", "at")
        dots += bool(signs) and kind in (".", "dot")
    n = sum(map(len, digits))
    if not (signs == 1 and dots) and n < 7 and len(digits) < 4:
        return None
    joined = b"".join(digits)
    check = "luhn" if 14 <= n <= 19 and luhn(joined) else "no" if 14 <= n <= 19 else ""
    small = len(digits) == 4 and all(len(d) <= 3 and int(d) <= 255 for d in digits)
    before = next((t.lower() for t in reversed(items[max(low - 4, 0):low]) if _kind(t) == "a"), b"")
    last = items[high - 1]
    return ("".join(form), ",".join(fine), n, check, small, signs, dots,
            _kind(items[low - 1] if low else None), _kind(items[high] if high < len(items) else None),
            before.decode() if before in _CUES else "", min(len(last), 7) if _kind(last) == "a" else 0)


def features(sign: tuple) -> list[str]:
    """Names of the whole-span features."""
    form, fine, n, check, small, signs, dots, left, right, cue, ending = sign
    between = "".join(sorted(set(form) - set("adu")))
    bucket = "any" if signs else n if n < 7 else "phone" if n in (10, 11) else "7-9" if n < 10 else "12-13" if n < 14 else "card" if n < 20 else "many"
    runs = re.findall(r"\d+", re.sub(r"[^d\d]", " ", fine))
    out = ["bias", f"digits {bucket}", f"check {check}", f"runs {'any' if signs else min(len(runs), 7)}", f"between {between}",
           f"begins {form[0]}", f"ends {form[-1]}", f"left {left}", f"right {right}", f"small {small} {len(runs)}",
           f"open {left in ('a', 'd', 'u')} {right in ('a', 'd', 'u')}", f"letters {'a' in form or 'u' in form} {signs}",
           f"form {form}" if signs == 0 else f"dots {min(dots, 1)}", f"fine {fine}" if signs == 0 else f"ending {ending}",
           f"spaces {form.count(' ')}" if signs == 0 else f"spaced {' ' in form.replace(' at ', '@').replace(' dot ', '.')}"]
    return out + ([f"cue {cue}"] if cue else [])


def arcs(items: list[bytes], end: int) -> Iterator[tuple[int, tuple]]:
    """``(begin, signature)`` of the spans that end in front of token ``end``."""
    if _kind(items[end - 1]) not in _RUNS or (end < len(items) and _kind(items[end]) in _RUNS):
        return
    size = 0
    for low in range(end - 1, max(end - MAX_TOKENS, 0) - 1, -1):
        size += len(items[low])
        if size > MAX_BYTES or _kind(items[low]) == "\n":
            return
        if _FIRST.match(items[low]) and not (low and _kind(items[low]) in _RUNS and _kind(items[low - 1]) in _RUNS):
            sign = signature(items, low, end)
            if sign:
                yield low, sign


class Model:
    """Weights by feature and label, and transitions between labels."""

    def __init__(self, weights: dict[str, np.ndarray], transitions: np.ndarray, margin: float = MARGIN):
        self.weights, self.transitions, self.margin = weights, transitions, margin
        self.scores = lru_cache(1 << 16)(self._scores)

    def __reduce__(self):
        return Model, (self.weights, self.transitions, self.margin)

    def _scores(self, sign: tuple) -> list[float]:
        """The score of each kind for a span."""
        none = np.zeros(LABELS)
        return sum((self.weights.get(f, none) for f in features(sign)), none).tolist()

    def spans(self, items: list[bytes]) -> list[tuple[int, int, int]]:
        """``(first token, end token, label)`` of the entities of the best segmentation."""
        step = self.transitions.tolist()
        best = deque([[0.0] + [-np.inf] * (LABELS - 1)], MAX_TOKENS + 1)  # by label, of the last places
        entries: deque[list[tuple[float, int]]] = deque(maxlen=MAX_TOKENS + 1)
        back: list[list[tuple[int, int]]] = []
        for end in range(1, len(items) + 1):
            here = best[-1]
            entries.append([max((here[p] + step[p][y], -p) for p in range(LABELS)) for y in range(LABELS)])
            value, from_ = entries[-1][OUTSIDE]
            now, back_here = [value] + [-np.inf] * (LABELS - 1), [(end - 1, -from_)] * LABELS
            for low, sign in arcs(items, end):
                scores = self.scores(sign)
                entry = entries[low - end]
                for y in range(1, LABELS):
                    found = entry[y][0] + scores[y] - self.margin
                    if found > now[y]:
                        now[y], back_here[y] = found, (low, -entry[y][1])
            best.append(now)
            back.append(back_here)
        out, end = [], len(items)
        label = max(range(LABELS), key=lambda y: (best[-1][y], -y)) if items else OUTSIDE
        while end:
            low, before = back[end - 1][label]
            if label != OUTSIDE:
                out.append((low, end, label))
            end, label = low, before
        return out[::-1]


def _log_sum(values: np.ndarray, cells: np.ndarray, size: int) -> np.ndarray:
    """Logarithms of the sums of exponentials by cell."""
    top = np.full(size, -np.inf)
    np.maximum.at(top, cells, values)
    safe = np.where(np.isfinite(top), top, 0.0)
    total = np.bincount(cells, np.exp(values - safe[cells]), minlength=size)
    with np.errstate(divide="ignore"):
        return safe + np.log(total)


def _log_sum_axis(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return (safe + np.log(np.exp(values - safe).sum(axis=axis, keepdims=True))).squeeze(axis)


class _Lattice:
    """All segmentations of the examples, as arcs in flat arrays: example, begin, end, label, signature."""

    def __init__(self, examples: list[tuple[list[bytes], list[tuple[int, int, int]]]]):
        signs: dict[tuple | None, int] = {None: 0}
        rows, answers, steps = [], [], np.zeros((LABELS, LABELS))
        for number, (items, spans) in enumerate(examples):
            wanted = {(low, high): label for low, high, label in spans}
            for end in range(1, len(items) + 1):
                rows.append((number, end - 1, end, OUTSIDE, 0))
                answers.append(False)
                for low, sign in arcs(items, end):
                    code = signs.setdefault(sign, len(signs))
                    for label in range(1, LABELS):
                        rows.append((number, low, end, label, code))
                        answers.append(wanted.get((low, end)) == label)
            at, label = 0, OUTSIDE
            for low, high, kind in [*spans, (len(items), len(items), None)]:
                for _ in range(at, low):
                    steps[label, OUTSIDE] += 1
                    label = OUTSIDE
                if kind is not None:
                    steps[label, kind] += 1
                    label = kind
                at = high
        order = sorted(range(len(rows)), key=lambda i: (rows[i][2], rows[i][0]))
        self.example, self.begin, self.end, self.label, self.sign = np.array([rows[i] for i in order]).T
        self.answer = np.array([answers[i] for i in order])
        self.steps = steps
        self.sizes = np.array([len(items) for items, _ in examples])
        names: dict[str, int] = {}
        listed = [[] if s is None else [names.setdefault(f, len(names)) for f in features(s)] for s in signs]
        self.names = list(names)
        self.of_sign = np.repeat(np.arange(len(listed)), [len(x) for x in listed])
        self.of_name = np.array([f for x in listed for f in x], dtype=np.int64)
        self.n_signs = len(listed)

    def gradient(self, weights: np.ndarray, transitions: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """The log likelihood, and its slope by weight and by transition: what the answers have
        of each less what the model expects, by forward and backward sums over the arcs."""
        table = np.zeros((self.n_signs, LABELS))
        for label in range(1, LABELS):
            table[:, label] = np.bincount(self.of_sign, weights[self.of_name, label], minlength=self.n_signs)
        score = table[self.sign, self.label]
        n, longest = len(self.sizes), int(self.sizes.max())
        forward = np.full((n, longest + 1, LABELS), -np.inf)
        forward[:, 0, OUTSIDE] = 0
        entry = np.full((n, longest + 1, LABELS), -np.inf)
        edges = np.searchsorted(self.end, np.arange(longest + 2))
        cells = self.example * LABELS + self.label
        for at in range(longest + 1):
            some = slice(edges[at], edges[at + 1])
            if at:
                values = entry[self.example[some], self.begin[some], self.label[some]] + score[some]
                forward[:, at] = _log_sum(values, cells[some], n * LABELS).reshape(n, LABELS)
            entry[:, at] = _log_sum_axis(forward[:, at, :, None] + transitions, 1)
        whole = _log_sum_axis(forward[np.arange(n), self.sizes], 1)
        # Backward: by begin of the arcs.
        order = np.lexsort((self.example, self.begin))
        edges = np.searchsorted(self.begin[order], np.arange(longest + 2))
        begin = np.full((n, longest + 1, LABELS), -np.inf)
        leave = np.full((n, longest + 1, LABELS), -np.inf)
        leave[np.arange(n), self.sizes] = 0
        for at in range(longest - 1, -1, -1):
            some = order[edges[at]:edges[at + 1]]
            values = score[some] + leave[self.example[some], self.end[some], self.label[some]]
            begin[:, at] = _log_sum(values, cells[some], n * LABELS).reshape(n, LABELS)
            inner = at < self.sizes
            leave[inner, at] = _log_sum_axis(begin[inner, at][:, None, :] + transitions, 2)
        share = np.exp(entry[self.example, self.begin, self.label] + score
                       + leave[self.example, self.end, self.label] - whole[self.example])
        expected_steps = np.exp(forward[:, :, :, None] + transitions + begin[:, :, None, :] - whole[:, None, None, None]).sum((0, 1))
        excess = np.bincount(self.sign * LABELS + self.label, self.answer - share,
                             minlength=self.n_signs * LABELS).reshape(-1, LABELS)
        slope = np.zeros_like(weights)
        for label in range(1, LABELS):
            slope[:, label] = np.bincount(self.of_name, excess[self.of_sign, label], minlength=len(weights))
        likelihood = score[self.answer].sum() + (self.steps * transitions).sum() - whole.sum()
        return float(likelihood), slope, self.steps - expected_steps


def fit(examples: list[tuple[list[bytes], list[tuple[int, int, int]]]]) -> Model:
    """The model of the penalised likelihood, by steps of adapted length along its slope."""
    if not examples:
        return Model({}, np.zeros((LABELS, LABELS)))
    lattice = _Lattice(examples)
    values = [np.zeros((len(lattice.names), LABELS)), np.zeros((LABELS, LABELS))]
    means, squares = ([np.zeros_like(v) for v in values] for _ in range(2))
    for step in range(1, _STEPS + 1):
        _, *slopes = lattice.gradient(*values)
        for value, slope, mean, square in zip(values, slopes, means, squares):
            slope = slope - _PENALTY * value
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope * slope - square)
            value += _RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return Model(dict(zip(lattice.names, values[0])), values[1])


def _changed(rng: random.Random, kind: str, raw: bytes) -> tuple[bytes, bool]:
    """The span written otherwise, and whether it is still what it was."""
    text = raw.decode()
    digits = re.sub(r"\D", "", text)
    if kind == "email":
        local, _, domain = text.partition("@")
        at, dot = rng.choice([(" [at] ", " [dot] "), ("[at]", "."), (" (at) ", "."), ("(at)", "(dot)"), (" at ", " dot "), (" @ ", "."), ("[ at ]", " dot ")])
        if rng.random() < 0.2:
            return f"{local}@{domain.split('.')[0]}".encode(), False
        if rng.random() < 0.5:
            local = re.sub(r"[\d%+]", "", local).strip(".") or "name"
        if domain.count(".") > 1 and rng.random() < 0.5:
            domain = domain.partition(".")[2]
        return (local + at + domain.replace(".", dot)).encode(), True
    if kind == "ip":
        parts = text.split(".")
        if rng.random() < 0.3:
            return ".".join([str(256 + rng.randrange(700)), *parts[1:]]).encode(), False
        return rng.choice(["[.]", "(.)", " . ", "[dot]"]).join(parts).encode(), True
    if kind == "card":
        if rng.random() < 0.5:
            wrong = digits[:-1] + str((int(digits[-1]) + rng.randrange(1, 10)) % 10)
            return rng.choice([wrong, " ".join(wrong[i:i + 4] for i in range(0, len(wrong), 4))]).encode(), False
        return rng.choice([".", "/", "  ", " - ", "_"]).join(digits[i:i + 4] for i in range(0, len(digits), 4)).encode(), True
    area, middle, end = digits[-10:-7], digits[-7:-4], digits[-4:]
    if rng.random() < 0.2:
        return f"({area}) {middle}".encode(), False
    return rng.choice([f"({area}) {middle}-{end}", f"{area}-{middle}-{end}", f"{area}.{middle}.{end}",
                       f"00{digits[:-10]} {area} {middle} {end}"]).encode(), True


def variants(raw: bytes, spans: list[tuple[int, int, int]], rng: random.Random) -> tuple[bytes, list[tuple[int, int, int]]]:
    """A stretch with each of its spans written otherwise; byte spans, label."""
    out, found, at = b"", [], 0
    for low, high, label in spans:
        changed, holds = _changed(rng, KINDS[label - 1], raw[low:high])
        out += raw[at:low]
        if holds:
            found.append((len(out), len(out) + len(changed), label))
        out += changed
        at = high
    return out + raw[at:], found


def _in_tokens(raw: bytes, spans: list[tuple[int, int, int]]) -> tuple[list[bytes], list[tuple[int, int, int]]] | None:
    """The stretch as tokens, the spans by token; nothing if a span is no arc."""
    items = tokens(raw)
    edges = {0: 0}
    for i, token in enumerate(items):
        edges[sum(map(len, items[:i + 1]))] = i + 1
    found = []
    for low, high, label in spans:
        if low not in edges or high not in edges or edges[low] not in {b for b, _ in arcs(items, edges[high])}:
            return None
        found.append((edges[low], edges[high], label))
    return items, found


def _stratum(spans: list[tuple[int, int, int]]) -> int:
    return spans[0][2] if spans else 0


def _local_spans(spans, low: int, high: int) -> list[tuple[int, int, int]] | None:
    """The spans in a stretch, offsets within it; nothing if they overlap each other or its bounds."""
    a, b = np.searchsorted(spans.start, (low, high))
    out, last = [], low
    for i in range(max(int(a) - 1, 0), int(b)):
        start, end = int(spans.start[i]), int(spans.end[i])
        if end <= low:
            continue
        if start < last or end > high:
            return None
        out.append((start - low, end - low, int(spans.kind[i]) + 1))
        last = end
    return out


def _sampling(sample: int):
    """The least stretches by hash of each stratum that a task has."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[dict[int, bytes]] = [{} for _ in range(LABELS)]
        heaps: list[list[int]] = [[] for _ in range(LABELS)]
        for block in row_blocks(parts):
            texts = texts_of(block.column("text"))
            runs = DigitRuns(texts)
            spans = base_spans(texts, runs)
            for _, low, high in stretches(texts, runs):
                if high - low > _SHORT:
                    continue
                own = _local_spans(spans, low, high)
                if own is None:
                    continue
                raw = texts.data[low:high].tobytes()
                key, of = xxhash.xxh64_intdigest(raw) >> 1, _stratum(own)
                if key in kept[of]:
                    continue
                heapq.heappush(heaps[of], -key)
                kept[of][key] = raw
                if len(heaps[of]) > sample:
                    del kept[of][-heapq.heappop(heaps[of])]
        rows = [(of, key, raw) for of, some in enumerate(kept) for key, raw in some.items()]
        columns = list(zip(*rows)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary()))],
                                         names=["stratum", "key", "raw"])
    return batches


def training_stretches(docs: DataFrame, sample: int = SAMPLE) -> list[bytes]:
    """At most ``sample`` distinct stretches of each stratum."""
    rows = cut(in_tasks(docs.select("text"), _sampling(sample), "stratum int, key long, raw binary")
               .groupBy("stratum", "key").agg(F.min("raw").alias("raw")))
    return [bytes(r["raw"]) for of in range(LABELS)
            for r in rows.where(F.col("stratum") == of).orderBy("key").limit(sample).collect()]


def examples_of(raws: Iterable[bytes]) -> list[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Stretches with the rules' spans, and the same written otherwise, twice."""
    out = []
    for raw in raws:
        rng = random.Random(xxhash.xxh64_intdigest(raw))
        texts = texts_of(pa.array([raw.decode(errors="ignore")], pa.large_string()))
        clean = texts.text(0)
        spans = _local_spans(base_spans(texts, DigitRuns(texts)), 0, len(clean))
        if spans is None:
            continue
        versions = [(clean, spans)] + ([variants(clean, spans, rng) for _ in range(2)] if spans else [])
        out += [found for version in versions if (found := _in_tokens(*version))]
    return out


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    return fit(examples_of(training_stretches(docs, sample)))


def _added(model: Model, texts, runs, spans) -> list[tuple[int, int, int, int]]:
    """``(row, start, end, kind)`` of the model's spans that overlap none of the rules'."""
    out = []
    furthest = np.maximum.accumulate(spans.end)  # of the rules' spans up to each
    for row, low, high in stretches(texts, runs):
        items = tokens(texts.data[low:high].tobytes())
        found = model.spans(items)
        if not found:
            continue
        edges = low + np.concatenate(([0], np.cumsum([len(t) for t in items])))
        for first, end, label in found:
            a, b = int(edges[first]), int(edges[end])
            before = int(np.searchsorted(spans.start, b))
            if not before or furthest[before - 1] <= a:
                out.append((row, a, b, label - 1))
    return out


def _finding(broadcast):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        for block in row_blocks(parts):
            texts = texts_of(block.column("text"))
            runs = DigitRuns(texts)
            base = base_spans(texts, runs)
            added = np.array(_added(model, texts, runs, base), dtype=np.int64).reshape(-1, 4).T
            row, start, end, kind = (np.concatenate((x, y)) for x, y in
                                     zip((base.row, base.start, base.end, base.kind), added))
            is_base = np.arange(len(row)) < len(base.row)
            order = np.lexsort((end, kind, start, row))
            row, start, end, kind, is_base = (x[order] for x in (row, start, end, kind, is_base))
            first = code_points(texts, start, row)
            last = first + [int(np.count_nonzero((texts.data[a:b] & 0xC0) != 0x80)) for a, b in zip(start, end)]
            n = np.array([np.bincount(row[is_base & (kind == k)], minlength=len(texts)) for k in range(len(KINDS))])
            said: list[list[str]] = [[] for _ in range(len(texts))]
            ruled: list[list[str]] = [[] for _ in range(len(texts))]
            for r, a, b, k, by_rule in zip(row.tolist(), first.tolist(), last.tolist(), kind.tolist(), is_base.tolist()):
                span = f"{KINDS[k]}:{a}:{b}"
                said[r].append(span)
                if by_rule:
                    ruled[r].append(span)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), *(pa.array(x) for x in n),
                 pa.array([",".join(x) for x in ruled], pa.string()), pa.array([",".join(x) for x in said], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_spans", "spans"])
    return batches


def personal_data(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans)``, one row per document: counts and spans
    of the rules, and these with what the model adds; ``kind:start:end`` in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs))
    return in_tasks(docs.selectExpr("cast(doc_id as long) as doc_id", "text"), _finding(shared),
                    "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_spans string, spans string")

