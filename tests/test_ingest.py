"""Landing files: tolerance, arrays, lineage, the sink."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from helpers import VALID, as_tuples, event
from pyspark.sql import Observation
from pyspark.sql import functions as F

from salestrata.functions import json_text, store_path
from salestrata.operators import classify_sales, clean_rows
from salestrata.sources import ingest_jsonl, write_jsonl

TS = "2026-01-01 00:00:00"


def land(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode("utf-8"))
    return path


def ids(raw):
    return sorted(str(r[0]) for r in raw.select(json_text("raw", "event_id")).collect())


def test_bad_lines_are_skipped_and_counted(spark, tmp_path):
    land(tmp_path, "dt=20260101/a.jsonl", "\n".join([
        event(event_id="1"), "{bad", "", "  ", '[{"event_id": "2"}, {"event_id": "3"}]',
        '{"event_id": "x", "event_id": "y"}', event(event_id="ü"), "null", "5",
        '{"event_id": "4"} {"event_id": "5"}', '{"event_id": "6"}, {"event_id": "7"}', "[]",
    ]) + "\n")
    seen = Observation("lines")
    raw = ingest_jsonl(spark, str(tmp_path), TS, seen)
    assert ids(raw) == sorted(["1", "2", "3", "ü", "None", "None"])
    assert seen.get == {"n_lines": 12, "n_blank": 2, "n_bad": 4}


def test_columns_and_lineage(spark, tmp_path):
    land(tmp_path, "dt=20260101/with space+plus%41.jsonl", event() + "\n")
    land(tmp_path, "dt=20260102/deep/er/é.jsonl", event() + "\n")
    raw = ingest_jsonl(spark, str(tmp_path), TS)
    assert raw.dtypes == [("ingestion_ts", "timestamp_ntz"), ("source_filename", "string"),
                          ("raw", "variant")]
    inside = str(tmp_path).lstrip("/")
    assert sorted(r.source_filename for r in raw.collect()) == [
        f"{inside}/dt=20260101/with space+plus%41.jsonl", f"{inside}/dt=20260102/deep/er/é.jsonl"]
    assert {r.ingestion_ts for r in raw.collect()} == {datetime(2026, 1, 1)}


@pytest.mark.parametrize("uri,path", [
    ("s3a://bucket/raw/sales/dt=20260101/a.jsonl", "raw/sales/dt=20260101/a.jsonl"),
    ("file:///data/a%20b+c.jsonl", "data/a b+c.jsonl"),
    ("file:/data/a.jsonl", "data/a.jsonl"),
    ("abfss://box@account.host/x/%C3%A9", "x/é"),
    ("hdfs://node:8020/x", "x"),
])
def test_store_path(spark, uri, path):
    assert spark.range(1).select(store_path(F.lit(uri))).first()[0] == path


def test_ingest_time_defaults_to_now(spark, tmp_path):
    land(tmp_path, "a.jsonl", event() + "\n")
    before = spark.sql("SELECT localtimestamp()").first()[0]
    stamp = ingest_jsonl(spark, str(tmp_path)).first().ingestion_ts
    assert before <= stamp <= spark.sql("SELECT localtimestamp()").first()[0]


def test_line_ends_and_byte_order_mark(spark, tmp_path):
    land(tmp_path, "a.jsonl", b"\xef\xbb\xbf" + b"\r\n".join(
        event(event_id=i).encode() for i in "123"))
    assert ids(ingest_jsonl(spark, str(tmp_path), TS)) == ["1", "2", "3"]


def test_compressed_files(spark, tmp_path):
    import gzip
    land(tmp_path, "a.jsonl.gz", gzip.compress((event(event_id="1") + "\n").encode()))
    assert ids(ingest_jsonl(spark, str(tmp_path), TS)) == ["1"]


def test_an_array_beyond_the_size_of_a_variant(spark, tmp_path):
    one = json.dumps({"event_id": "e", "pad": "x" * 100_000})
    land(tmp_path, "line.jsonl", "[" + ",".join([one] * 1400) + "]")
    for multi_line in (False, True):
        raw = ingest_jsonl(spark, str(tmp_path), TS, multi_line=multi_line)
        assert raw.select(json_text("raw", "event_id").alias("id")).where("id = 'e'").count() == 1400


@pytest.mark.parametrize("line", [
    '{"a": 1}]', '{"a": 1}] {"b": 2}', '{"a": 1}, {"b": 2}]', '[{"a": 1},', '[{"a": 1}]]', ']', ',',
    '{"a": 1},', '[1] [2]', '[1], [2]', '[1], [2]]', '1, 2', '1 2', '"a" "b"', '{"a": 1}}', "[", "{",
    '"open', '["open]', "tru", "[1, 2", "{'a': 1}", "NaN", "[NaN]", "01", '{"a": 1, "a": 2}',
])
def test_a_line_is_one_value_or_bad(spark, tmp_path, line):
    land(tmp_path, "a.jsonl", line + "\n")
    seen = Observation("lines")
    assert ingest_jsonl(spark, str(tmp_path), TS, seen).collect() == []
    assert seen.get == {"n_lines": 1, "n_blank": 0, "n_bad": 1}


@pytest.mark.parametrize("line,records", [
    ('{"a": 1}', ['{"a":1}']), (' {"a": "]}"} ', ['{"a":"]}"}']), ("\t[1, [2], {}]\t", ["1", "[2]", "{}"]),
    ("[]", []), ("[[]]", ["[]"]), ("5", ["5"]), ('"x"', ['"x"']), ('"[1]"', ['"[1]"']),
    ("true", ["true"]), ("null", ["null"]), ('"end of text"', ['"end of text"']),
    ('["end of text"]', ['"end of text"']),
])
def test_the_records_of_a_line(spark, tmp_path, line, records):
    land(tmp_path, "a.jsonl", line + "\n")
    raw = ingest_jsonl(spark, str(tmp_path), TS)
    assert [r[0] for r in raw.select(F.to_json("raw")).collect()] == records


def test_json_nulls_are_records(spark, tmp_path):
    land(tmp_path, "a.jsonl", "null\n[null, null]\n")
    raw = ingest_jsonl(spark, str(tmp_path), TS)
    assert [r[0] for r in raw.select(F.to_json("raw")).collect()] == ["null"] * 3


def test_array_spread_over_lines(spark, tmp_path):
    land(tmp_path, "dt=20260101/a b.json",
         json.dumps([{**VALID, "event_id": str(i)} for i in range(3)], indent=2))
    land(tmp_path, "dt=20260102/one.json", json.dumps(VALID, indent=2))
    land(tmp_path, "dt=20260102/bad.json", "[{")
    land(tmp_path, "dt=20260102/two.json", json.dumps(VALID, indent=2) * 2)
    land(tmp_path, "dt=20260102/mark.json",
         b"\xef\xbb\xbf" + json.dumps({**VALID, "event_id": "m"}, indent=2).encode())
    seen = Observation("documents")
    raw = ingest_jsonl(spark, str(tmp_path), TS, seen, multi_line=True)
    assert ids(raw) == ["0", "1", "2", "e-1", "m"]
    assert seen.get == {"n_lines": 5, "n_blank": 0, "n_bad": 2}
    assert any(r.source_filename.endswith("dt=20260101/a b.json") for r in raw.collect())
    assert clean_rows(classify_sales(raw)).count() == 5


def test_sink_writes_one_object_per_line(spark, tmp_path):
    rows = spark.createDataFrame(
        [("e1", datetime(2026, 1, 2, 3, 4, 5, 6), "日本", 2),
         (None, datetime(2026, 1, 2), "home", None)],
        "event_id string, event_ts timestamp_ntz, category string, quantity int").coalesce(1)
    folder = write_jsonl(rows, str(tmp_path), dt="20260102")
    assert folder == f"{tmp_path}/dt=20260102"
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "dt=20260102").glob("part-*"))
    assert text.endswith("\n") and "日本" in text
    assert [json.loads(line) for line in text.splitlines()] == [
        {"event_id": "e1", "event_ts": "2026-01-02T03:04:05.000006+00:00", "category": "日本",
         "quantity": 2},
        {"event_id": None, "event_ts": "2026-01-02T00:00:00.000000+00:00", "category": "home",
         "quantity": None}]


def test_sink_appends_and_bounds_files(spark, tmp_path):
    rows = spark.range(10).coalesce(1).selectExpr("string(id) AS event_id")
    for _ in range(2):
        write_jsonl(rows, str(tmp_path), dt="20260102", max_records_per_file=4)
    assert len(list((tmp_path / "dt=20260102").glob("part-*"))) == 6
    assert ingest_jsonl(spark, str(tmp_path), TS).count() == 20
    write_jsonl(rows, str(tmp_path))
    assert len(list(tmp_path.glob("dt=*"))) == 2


def test_round_trip_keeps_the_typed_values(spark, tmp_path):
    land(tmp_path, "in/a.jsonl", event(event_id=None) + "\n" + event(unit_price=None) + "\n")
    before = clean_rows(classify_sales(ingest_jsonl(spark, str(tmp_path / "in"), TS), "literal"))
    write_jsonl(before.drop("source_filename", "ingestion_ts"), str(tmp_path / "out"))
    after = clean_rows(classify_sales(ingest_jsonl(spark, str(tmp_path / "out"), TS), "literal"))
    assert sorted(map(str, as_tuples(after.drop("source_filename")))) == sorted(
        map(str, as_tuples(before.drop("source_filename"))))
