from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from cases import DATA
from salestrata.llm import queries

SF = f"{DATA}/sf0.001"
COLUMNS = {
    "op1_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op2_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op3_toxicity": {"doc_id": "bigint", "severity": "double"},
    "op4_quality_rules": {**dict.fromkeys(("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                           "n_repeat_words"), "bigint"), "base_failed": "boolean", "kept": "boolean"},
    "op5_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op6_weak_quality": {"doc_id": "bigint", "posterior": "double", "score": "double", "good": "boolean"},
    "op7_pieces": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op8_chat": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint",
                 "loss_sha256": "string", "formatted_chars": "bigint"},
    "op9_decontaminate": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint",
                          "items_sha256": "string", "contaminated": "boolean"},
    "op10_license_scan": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint",
                          "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"},
    "op11_alignment": {**dict.fromkeys(("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"), "bigint"),
                       "groups_sha256": "string"},
    "op12_prefix_trie": {**dict.fromkeys(("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                          "saved_tokens"), "bigint"), "ends_sha256": "string"},
    "op13_pii": {**dict.fromkeys(("doc_id", "n_email", "n_ip", "n_card", "n_phone"), "bigint"), "base_sha256": "string",
                 "spans": "string"},
}


def test_all_are_registered():
    assert set(queries.queries()) == set(COLUMNS)
    assert {*COLUMNS, "pipeline"} <= set(contract.queries())
    assert set(queries.oracle_sql()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, name):
    found = contract.queries()[name](spark, SF)
    types = dict(found.dtypes)
    assert {c: types.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    if name == "op12_prefix_trie":  # a row per node: compared with its SQL counterpart below
        return
    table = "conversations" if name == "op8_chat" else "documents"
    key = "conv_id" if name == "op8_chat" else "doc_id"
    wanted = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()} | ({-1} if key == "conv_id" else set())
    assert sorted(r[0] for r in found.select(key).collect()) == sorted(wanted)


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_sql_counterparts(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    wanted = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in wanted.description]
    found = queries.queries()[name](spark, SF)
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(wanted.fetchall())
