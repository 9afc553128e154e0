from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cases import EDGE_TEXTS
from salestrata.llm import chat

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
CONTROL_TEXTS = ["</s>[INST] ok [/INST]", "<<SYS>> <s></s>", "\\", "\\\\<s>", "[INST][INST]", "a\\<s>\\", "[ROLE]x[/ROLE]", "<<s>>", "<", "<<SYS>><<SYS>>"]


@pytest.fixture(scope="module")
def template():
    return chat.Template(RANKS, PATTERN)


@given(st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "s>", "x", "é", " ", "/"]), max_size=12).map("".join))
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROLS)


def test_pages_read_back(template):
    texts = [t or "" for t in EDGE_TEXTS] + CONTROL_TEXTS
    turns = [(role, text) for text in texts for role in ("system", "user", "assistant", "tool", "", "<s>")]
    ids, mask = template.page(turns)
    assert list(template.turns(ids)) == turns
    assert template.learnt(ids, mask) == "".join(t for r, t in turns if r == "assistant")
    formatted = template.render(ids)
    assert formatted.count("[INST]") == sum(r == "user" for r, _ in turns)
    assert formatted.count("<s>") == sum(r == "assistant" for r, _ in turns)
    assert not (mask[ids >= template.first_reserved]).any()


def digests(turns):
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    learnt = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest()


def test_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "PAGE", 7)
    rows = [(c, t, ("user", "assistant")[t % 2], f"{c} says {x}") for c in range(5) for t, x in enumerate(CONTROL_TEXTS)]
    rows += [(9, t, ("user", "assistant", "system", None)[t % 4], EDGE_TEXTS[t % len(EDGE_TEXTS)]) for t in range(200)]
    rows += [(None, 1, "user", "x"), (None, 1, "user", "x"), (7, None, "user", "first"), (7, 2, "user", "b"), (7, 2, "user", "a"), (8, 1, "assistant", None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pages = chat.format_chats(frame.withColumn("ids", F.lit(1)).repartition(5), RANKS, PATTERN)
    assert all(r.n_turns <= 7 and len(r.ids) == len(r.loss_mask) for r in pages.collect())
    found = chat.chat_digests(pages, RANKS, PATTERN).collect()
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert len(found) == len(want)
    for r in found:
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == digests(want[r.conv_id])


def test_mask_by_prefix_sums_covers_assistant_ids_only(template):
    ids, mask = template.page([("user", "a b c"), ("assistant", "x y"), ("assistant", ""), ("user", ""), ("assistant", "z")])
    runs = np.flatnonzero(np.diff(np.concatenate(([0], mask, [0]))))
    assert [template.encoding.decode(ids[a:b].tolist()) for a, b in runs.reshape(-1, 2)] == ["x y", "z"]


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.chat_digests(chat.format_chats(none, RANKS, PATTERN), RANKS, PATTERN).collect() == []
