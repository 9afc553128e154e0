"""Listings: complete, and in a few calls however many names there are."""

from __future__ import annotations

import time

import pytest

from salestrata import files
from salestrata.sources.jsonl import skipped_names


@pytest.fixture
def calls(spark, monkeypatch):
    """The calls from Python to the JVM while it is on."""
    client = spark.sparkContext._gateway._gateway_client
    seen = []
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda command, *a, **k: (seen.append(command[:1]), send(command, *a, **k))[1])
    return seen


def put(root, *names):
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.touch()


def test_names_of_any_form(spark, tmp_path):
    names = ["a b.jsonl", "dt=1/é%20 [x].jsonl", "dt=1/b; isDirectory=true; length=3", "_x/deep/y", ".z", "dt=2/_w", "k=v/_a=b/c",
             "new\nline", "p, q", "c\\d,", "e:f"]
    put(tmp_path, *names)
    (tmp_path / "empty").mkdir()
    root = str(tmp_path)
    assert sorted(files.walk(spark, root)) == sorted(n for n in names if n not in ("_x/deep/y", ".z", "dt=2/_w"))
    assert sorted(files.children(spark, root)) == sorted(
        ["a b.jsonl", "dt=1", "_x", ".z", "dt=2", "k=v", "empty", "new\nline", "p, q", "c\\d,", "e:f"])
    assert files.is_folder(spark, f"{root}/dt=1") and not files.is_folder(spark, f"{root}/a b.jsonl")
    assert files.data_files(spark, root) == {
        root: frozenset({"a b.jsonl", "new\nline", "p, q", "c\\d,", "e:f"}), f"{root}/dt=1": frozenset({"é%20 [x].jsonl", "b; isDirectory=true; length=3"}),
        f"{root}/k=v/_a=b": frozenset({"c"})}
    assert skipped_names(spark, root) == [f"{root}/.z", f"{root}/_x", f"{root}/dt=2/_w"]


def test_a_missing_or_empty_folder(spark, tmp_path):
    for folder in (tmp_path, tmp_path / "none"):
        assert files.walk(spark, str(folder)) == [] == files.children(spark, str(folder))
        assert files.data_files(spark, str(folder)) == {}


def test_a_hundred_thousand_files_take_a_few_calls(spark, tmp_path, calls):
    for day in range(100):
        folder = tmp_path / f"dt={day}"
        folder.mkdir()
        for i in range(1000):
            (folder / f"{i:05d}.jsonl").touch()
    put(tmp_path, "dt=7/_late")
    calls.clear()
    begin = time.perf_counter()
    assert sum(map(len, files.data_files(spark, str(tmp_path)).values())) == 100_000
    assert len(files.children(spark, str(tmp_path))) == 100
    assert len(calls) < 80
    calls.clear()
    assert skipped_names(spark, str(tmp_path)) == [f"{tmp_path}/dt=7/_late"]
    assert len(calls) < 100 * 30  # by folder, not by file
    assert time.perf_counter() - begin < 60
