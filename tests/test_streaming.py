"""Incremental loads: only new files, repeatable batches."""

from __future__ import annotations

import os
import uuid

import pytest
from helpers import event, raw_rows

from salestrata.plans import CatalogTables, FolderTables, SalesLayers
from salestrata.plans.layers import LoadsFailed
from salestrata.session import fresh_folder
from salestrata.sources.jsonl import skipped_names
from salestrata.streaming import load_new_files


@pytest.fixture(params=["folders", "catalog"])
def place(request, spark, tmp_path):
    root = fresh_folder(spark, "stream")
    tables = (FolderTables(spark, f"{root}/tables") if request.param == "folders"
              else CatalogTables(spark, f"t{uuid.uuid4().hex[:8]}_"))
    tables.create()
    return SalesLayers(tables), tmp_path / "landing", f"{root}/checkpoint"


def land(landing, name, *lines):
    path = landing / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", "utf-8")
    return path


def totals(layers):
    return layers.raw().count(), layers.clean().count(), layers.rejects().count()


def test_only_new_files_are_loaded(place):
    layers, landing, checkpoint = place
    first = land(landing, "dt=20260101/a b.jsonl", event(), event(quantity=0), "{bad", "")
    loaded = load_new_files(layers, str(landing), checkpoint)
    assert totals(layers) == (2, 1, 1)
    seen = layers.load_log().collect()
    assert [(r.load_day, r.load_id) for r in seen] == [("20260101", loaded[0])] * 2
    assert [tuple(r)[3:] for r in seen] == [(4, 2, 1, 1)] * 2
    assert sum((r.source_filename or "").endswith("a b.jsonl") for r in seen) == 1
    assert layers.raw().first().source_filename.endswith("dt=20260101/a b.jsonl")

    load_new_files(layers, str(landing), checkpoint)
    assert totals(layers) == (2, 1, 1)

    land(landing, "dt=20260102/b.jsonl", event(), event())
    load_new_files(layers, str(landing), checkpoint)
    assert totals(layers) == (4, 3, 1)

    # A file rewritten in place is known by its path and not read again.
    first.write_text(event() + "\n" + event() + "\n" + event() + "\n", "utf-8")
    load_new_files(layers, str(landing), checkpoint)
    assert totals(layers) == (4, 3, 1)


def test_late_file_with_an_old_time_is_loaded(place):
    layers, landing, checkpoint = place
    land(landing, "new.jsonl", event())
    load_new_files(layers, str(landing), checkpoint)
    old = land(landing, "old.jsonl", event())
    os.utime(old, (1_000_000_000, 1_000_000_000))
    load_new_files(layers, str(landing), checkpoint)
    assert totals(layers) == (2, 2, 0)


def test_a_backlog_goes_in_several_batches(place):
    layers, landing, checkpoint = place
    for i in range(5):
        land(landing, f"{i}.jsonl", event(event_id=str(i)))
    load_new_files(layers, str(landing), checkpoint, max_files_per_batch=2)
    assert totals(layers) == (5, 5, 0)
    assert layers.tables.read("raw_sales").select("load_id").distinct().count() == 3


def test_a_batch_that_failed_half_way_is_repeated_without_duplicates(place):
    layers, landing, checkpoint = place
    land(landing, "a.jsonl", event(), event(quantity=0))

    class Stops(SalesLayers):
        def append_raw(self, rows, load_id=None):
            super().append_raw(rows, load_id)
            raise RuntimeError("lost between two steps")

    with pytest.raises(Exception, match="lost between two steps"):
        load_new_files(Stops(layers.tables), str(landing), checkpoint)
    assert totals(layers) == (2, 0, 0)
    land(landing, "b.jsonl", event())
    load_new_files(layers, str(landing), checkpoint)
    assert totals(layers) == (3, 2, 1)


def test_raw_only(place):
    layers, landing, checkpoint = place
    land(landing, "a.jsonl", event(), event(quantity=0))
    load_new_files(layers, str(landing), checkpoint, stage=False)
    assert layers.raw().count() == 2
    layers.rebuild_staging()
    assert totals(layers) == (2, 1, 1)


def test_a_new_checkpoint_never_overwrites_earlier_loads(place):
    layers, landing, checkpoint = place
    land(landing, "a.jsonl", event())
    load_new_files(layers, str(landing), checkpoint)
    load_new_files(layers, str(landing), f"{checkpoint}-2")
    assert totals(layers) == (2, 2, 0)


def test_batch_and_stream_loads_share_the_tables(spark, place):
    layers, landing, checkpoint = place
    load_id = layers.append_raw(raw_rows(spark, [event()]))
    layers.stage_load(load_id)
    land(landing, "a.jsonl", event())
    load_new_files(layers, str(landing), checkpoint)
    layers.rebuild_fact()
    counts = layers.reconcile().first()
    assert counts.balanced and counts.fact_rows == 2


def test_an_amount_too_large_stops_no_other_file(place):
    layers, landing, checkpoint = place
    land(landing, "dt=20260101/a.jsonl", event(total_amount=100000000))
    for _ in range(2):
        with pytest.raises(LoadsFailed):
            load_new_files(layers, str(landing), checkpoint)
        land(landing, "dt=20260102/b.jsonl", event())
    assert totals(layers) == (2, 1, 0)
    rejecting = SalesLayers(layers.tables, on_overflow="reject")
    assert load_new_files(rejecting, str(landing), checkpoint) == []
    assert totals(layers) == (2, 1, 1)


def test_each_day_has_a_checkpoint_of_its_own(place):
    layers, landing, checkpoint = place
    land(landing, "dt=20260101/a.jsonl", event())
    land(landing, "dt=20260102/a.jsonl", event())
    land(landing, "loose.jsonl", event())
    land(landing, "other/deep.jsonl", event())
    loads = load_new_files(layers, str(landing), checkpoint)
    assert sorted(load_id.split("-")[0] for load_id in loads) == ["20260101", "20260102", "undated"]
    assert totals(layers) == (4, 4, 0)
    late = land(landing, "dt=20260101/late.jsonl", event())
    os.utime(late, (1_000_000_000, 1_000_000_000))
    land(landing, "dt=20260102/b.jsonl", event())
    assert len(load_new_files(layers, str(landing), checkpoint, days=["20260101"])) == 1
    assert len(load_new_files(layers, str(landing), checkpoint)) == 1
    assert totals(layers) == (6, 6, 0)


def test_names_that_spark_passes_over_are_reported(spark, place, caplog):
    layers, landing, checkpoint = place
    for name in ("a.jsonl", "_b.jsonl", ".c.jsonl", "_x/d.jsonl"):
        land(landing, name, event())
    with caplog.at_level("WARNING"):
        load_new_files(layers, str(landing), checkpoint)
    assert totals(layers) == (1, 1, 0)
    assert [name.rpartition("/")[2] for name in skipped_names(spark, str(landing))] == [".c.jsonl", "_b.jsonl", "_x"]
    assert "3 names" in caplog.text


def test_every_name_in_the_landing_folder_is_loaded(place):
    layers, landing, checkpoint = place
    names = ["dt=20260101/a.jsonl", "dt=2026-01-05/a.jsonl", "dt=20260105_late/a.jsonl", "dt=backfill/x/a.jsonl",
             "dt=a [1]/a.jsonl", "dt=x.jsonl", "dt=y,z.jsonl", "dt=/a.jsonl", "d", "dt", "da", "dtx", "plain.jsonl", "_a=b/a.jsonl"]
    for name in names:
        land(landing, name, event())
    loaded = load_new_files(layers, str(landing), checkpoint)
    found = {r.source_filename.partition("landing/")[2] for r in layers.raw().collect()}
    assert found == set(names)
    assert totals(layers) == (len(names), len(names), 0)
    assert len(loaded) == 6  # a stream for each named folder, one for the rest
    assert load_new_files(layers, str(landing), checkpoint) == []
    land(landing, "dt=late.jsonl", event())
    load_new_files(layers, str(landing), checkpoint)
    assert layers.raw().count() == len(names) + 1


def test_only_folders_with_other_names_start_a_stream(place, monkeypatch):
    from salestrata.streaming import incremental
    layers, landing, checkpoint = place
    started = []
    reads = incremental.read_lines
    monkeypatch.setattr(incremental, "read_lines", lambda spark, path, **k: (started.append(path), reads(spark, path, **k))[1])
    days = 50 if isinstance(layers.tables, FolderTables) else 8
    for day in range(days):
        land(landing, f"dt=202601{day:02d}/a.jsonl", event(event_id=str(day)))
    land(landing, "loose.jsonl", event())
    load_new_files(layers, str(landing), checkpoint, stage=False)
    assert len(started) == days + 1 == layers.raw().count()
    started.clear()
    assert load_new_files(layers, str(landing), checkpoint, stage=False) == [] and started == []
    late = land(landing, "dt=20260107/deep/late.jsonl", event())
    os.utime(late, (1_000_000_000, 1_000_000_000))
    assert len(load_new_files(layers, str(landing), checkpoint, stage=False)) == 1
    assert len(started) == 1 and layers.raw().count() == days + 2
    land(landing, "other/loose.jsonl", event())
    started.clear()
    load_new_files(layers, str(landing), checkpoint, stage=False)
    assert len(started) == 1 and layers.raw().count() == days + 3


def test_a_folder_whose_stream_failed_is_looked_at_again(place):
    layers, landing, checkpoint = place
    land(landing, "dt=20260101/a.jsonl", event())

    class Stops(SalesLayers):
        def append_lines(self, *args):
            raise RuntimeError("lost before the load")

    with pytest.raises(Exception, match="lost before"):
        load_new_files(Stops(layers.tables), str(landing), checkpoint)
    assert len(load_new_files(layers, str(landing), checkpoint)) == 1
    assert totals(layers) == (1, 1, 0)
