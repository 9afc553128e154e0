"""The spark-submit job, step by step."""

from __future__ import annotations

import json

import pytest
from helpers import event, raw_rows
from pyspark.sql import functions as F

import run_layers
from salestrata.operators import reports
from salestrata.plans import FolderTables, SalesLayers
from salestrata.session import fresh_folder


def lines(folder):
    return [json.loads(line) for part in folder.glob("part-*") for line in part.read_text().splitlines()]


def test_load_rebuild_report(spark, tmp_path):
    root = fresh_folder(spark, "job")
    landing = tmp_path / "landing" / "dt=20260101"
    landing.mkdir(parents=True)
    (landing / "a.jsonl").write_text("\n".join([event(), event(category="beauty"), event(quantity=0)]))
    tables = ["--tables", f"{root}/tables"]
    for _ in range(2):
        run_layers.main(["load", *tables, "--landing", str(tmp_path / "landing"),
                         "--checkpoint", f"{root}/checkpoint"])
        layers = SalesLayers(FolderTables(spark, f"{root}/tables"))
        assert layers.reconcile().first().balanced  # the load has added to the fact
        run_layers.main(["rebuild", *tables])
    run_layers.main(["report", *tables, "--out", str(tmp_path / "out")])
    assert {p.name for p in (tmp_path / "out").iterdir()} == {
        *run_layers.REPORTS, "reject_reasons", "reconciliation"}
    assert lines(tmp_path / "out" / "reconciliation") == [
        {"raw_rows": 3, "clean_rows": 2, "reject_rows": 1, "fact_rows": 2, "balanced": True}]
    assert lines(tmp_path / "out" / "category_revenue")[0] == {
        "category": "beauty", "total_sales": 1, "total_units": 2, "total_revenue": 25.0}


def test_reports_from_the_book_are_the_reports(spark, tmp_path):
    lines_ = [event(), event(category=None, country=None, total_amount=70), event(event_ts="2026-01-09", marketing_channel=None),
              event(payment_method=None), event(quantity=0)] + [event(country=f"C{i}", total_amount=i) for i in range(12)]
    layers = SalesLayers(FolderTables(spark, fresh_folder(spark, "book")))
    layers.tables.create()
    layers.append_raw(raw_rows(spark, lines_), "a")
    layers.rebuild_staging()
    layers.rebuild_fact()
    run_layers.write_reports(layers, str(tmp_path / "out"))
    for name in run_layers.REPORTS:
        wanted = getattr(reports, name)(layers.fact())
        written = lines(tmp_path / "out" / name)
        assert written == [json.loads(r[0]) for r in wanted.select(
            F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()], name
        assert all(set(row) == set(wanted.columns) for row in written)
    assert {"category": None, "total_sales": 1, "total_units": 2, "total_revenue": 70.0} in lines(tmp_path / "out" / "category_revenue")


def test_missing_arguments_are_named(capsys):
    with pytest.raises(SystemExit):
        run_layers.main(["load", "--tables", "x"])
    assert "--landing and --checkpoint" in capsys.readouterr().err
