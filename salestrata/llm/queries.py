"""The named results of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestrata.llm import (
    alignment,
    chat,
    decontaminate,
    language_id,
    license_scan,
    pieces,
    pii,
    prefix_trie,
    quality_rules,
    simhash,
    token_files,
    toxicity,
    weak_quality,
)
from salestrata.llm.shared import cut, documents, new_folder, remove

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

# A conversation more, of control strings only.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    token_files.write(documents(spark, sf_dir), BYTE_BPE, folder)
    found = cut(token_files.digests(spark, folder))  # all that is asked of the files
    remove(spark, folder)
    return found


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op6_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.weak_quality(documents(spark, sf_dir))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.token_digests(documents(spark, sf_dir), PIECES)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(documents(spark, sf_dir),
                                        spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
                                "conv_id long, turn long, role string, text string")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(*own.columns).union(own)
    pages = chat.format_chats(rows, BYTE_RANKS, public_tokenizers.PATTERN)
    return chat.chat_digests(pages, BYTE_RANKS, public_tokenizers.PATTERN)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(documents(spark, sf_dir)).drop("detections")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(documents(spark, sf_dir), BYTE_BPE, PIECES)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie.prefix_trie(prefix_trie.regrafted(turns, every=20, most=4)).drop("k1", "k2")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(documents(spark, sf_dir))
    return found.withColumn("base_sha256", F.sha2("base_spans", 256)).drop("base_spans")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_token_files, op2_language_id, op3_toxicity, op4_quality_rules, op5_simhash,
        op6_weak_quality, op7_pieces, op8_chat, op9_decontaminate, op10_license_scan,
        op11_alignment, op12_prefix_trie, op13_pii,
    )}


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATE = f"""
WITH items AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, len(w[i:i + 9]) AS n, array_to_string(w[i:i + 9], ' ') AS win
    FROM items, range(1, greatest(len(w) - 9, 1) + 1) AS r(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
docs AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
found AS (
    SELECT d.doc_id, p.i, s.n, item_id
    FROM docs d, sizes s, range(1, len(d.w) - s.n + 2) AS p(i)
    JOIN windows x ON x.n = s.n AND x.win = array_to_string(d.w[p.i:p.i + s.n - 1], ' ')),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM found, range(i, i + n) AS q(j) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""


# Escaped as the template says: markers of control strings that stand in texts.
_TAILS = "s>|/s>|INST\\]|/INST\\]|<SYS>>|ROLE\\]|/ROLE\\]"


def _escaped(column: str) -> str:
    return rf"regexp_replace(replace({column}, '\', '\\'), '([<\[])({_TAILS})', '\1\\\2', 'g')"


_CHAT = f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}')),
sized AS (
    SELECT *, length({_escaped("text")}) + CASE role
        WHEN 'system' THEN length('<<SYS>></s>') WHEN 'user' THEN length('[INST][/INST]')
        WHEN 'assistant' THEN length('<s></s>')
        ELSE length('[ROLE][/ROLE]</s>') + length({_escaped("role")}) END AS n
    FROM rows),
told AS (
    SELECT conv_id, count(*) AS n_turns, sum(n)::BIGINT AS formatted_chars,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learnt
    FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learnt) AS loss_chars,
    sha256(learnt) AS loss_sha256, formatted_chars
FROM told
"""


# crc32 of an id's decimal digits, a bit at a time: -1 stands for the eight steps behind a byte.
_CRC32 = """
xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(1, length(d) + 1),
        lambda i: [ascii(d[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END), 4294967295)
"""

_PREFIX_TRIE = f"""
WITH own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC32} % 4 AS h
          FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS d FROM own)),
rebuilt AS (
    SELECT c.conv_id, 0 AS side, p, role, text FROM convs c JOIN own o ON o.conv_id = base AND p <= h
    UNION ALL
    SELECT conv_id, 1, p, role, text FROM convs JOIN own USING (conv_id) WHERE p > h),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY side, p) AS d FROM rebuilt),
paths AS (
    SELECT conv_id, d, text, string_agg(md5(length(role) || ':' || role || text), '')
        OVER (PARTITION BY conv_id ORDER BY d) AS k FROM numbered
    UNION ALL SELECT conv_id, 0, '', '' FROM convs),
nodes AS (
    SELECT k, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        (count(*) - 1) * len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')) AS saved
    FROM paths GROUP BY k),
children AS (SELECT left(k, length(k) - 32) AS k, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
below AS (
    SELECT a.k, sum((c.n IS NULL)::INT) AS n_leaves, sum(saved) AS saved_tokens
    FROM nodes v LEFT JOIN children c USING (k) JOIN paths a ON a.conv_id = v.conv_id AND a.d <= v.depth GROUP BY a.k),
ends AS (
    SELECT k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM paths
    JOIN (SELECT conv_id, max(d) AS d FROM paths GROUP BY conv_id) USING (conv_id, d) GROUP BY k)
SELECT v.conv_id, v.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, v.n_convs, coalesce(n, 0)::BIGINT AS n_children,
    n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes v JOIN below USING (k) LEFT JOIN children USING (k) LEFT JOIN ends USING (k)
LEFT JOIN nodes u ON v.depth > 0 AND u.k = left(v.k, length(v.k) - 32)
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_chat": _CHAT, "op9_decontaminate": _DECONTAMINATE, "op12_prefix_trie": _PREFIX_TRIE}
