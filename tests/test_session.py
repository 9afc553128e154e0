"""The shared folder: the cluster's own where it names one."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from salestrata import files, session
from salestrata.catalog.events_feed import read_events
from salestrata.catalog.results import raw_sales
from salestrata.plans import FolderTables, SalesLayers
from salestrata.session import SESSION_CONF, fresh_folder, shared_folder, spread


class Session:
    """As much of a session as the folder depends on."""

    def __init__(self, **conf):
        self.conf = {key.replace("_", "."): value for key, value in conf.items()}


def test_the_folder_the_cluster_names():
    spark = Session(spark_checkpoint_dir="s3a://bucket/shared/", spark_master="yarn")
    assert shared_folder(spark) == "s3a://bucket/shared"


def test_fresh_folders(spark):
    one, two = fresh_folder(spark, "x"), fresh_folder(spark, "x")
    assert one.startswith(f"{shared_folder(spark)}/x-") and one != two
    assert not files.exists(spark, one) and files.exists(spark, one.rpartition("/")[0])


def test_a_folder_of_its_own_in_local_mode_only():
    local = Session(spark_master="local[8]")
    assert shared_folder(local) == shared_folder(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(spark_master="spark://head:7077"))


def test_session_settings(spark):
    for key, value in SESSION_CONF.items():
        assert spark.conf.get(key) == value


def rows_by_task(rows):
    return [row["count"] for row in rows.groupBy(F.spark_partition_id().alias("task")).count().collect()]


def test_a_table_of_one_large_row_group_is_dealt_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "LARGE_TASK", 100, raising=False)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    dealt = read_events(spark, str(tmp_path))
    sizes = rows_by_task(dealt)
    assert len(sizes) > 8 and max(sizes) < sum(sizes) / 4
    assert dealt.exceptAll(events).isEmpty() and events.exceptAll(dealt).isEmpty()


def test_a_small_or_even_table_is_read_as_it_lies(spark, monkeypatch):
    small = spark.range(1000).coalesce(1)
    assert spread(small, "id") is small
    monkeypatch.setattr(session, "LARGE_TASK", 100)
    even, empty = spark.range(0, 4000, 1, 8), spark.range(0)
    assert spread(even, "id") is even and spread(empty, "id") is empty


def test_a_scan_that_leaves_cores_idle_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(session, "LARGE_TASK", 100)
    for tasks in (5, 9):  # three of eight cores without a task; a last round of one task
        rows = spark.range(0, 9000, 1, tasks)
        dealt = spread(rows, "id")
        assert dealt is not rows and len(rows_by_task(dealt)) > 9
        assert dealt.exceptAll(rows).isEmpty() and rows.exceptAll(dealt).isEmpty()
    for tasks in (8, 16, 35):
        rows = spark.range(0, 9000, 1, tasks)
        assert spread(rows, "id") is rows


@pytest.mark.parametrize("given", ["0", "2", "9"])
def test_partitioned_writes_keep_the_folders_of_a_task_open(spark, monkeypatch, given):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before, during, write = spark.conf.get(key), [], DataFrameWriter.parquet

    def parquet(self, *args, **named):
        during.append(int(self._spark.conf.get(key)))
        return write(self, *args, **named)

    layers = SalesLayers(FolderTables(spark, fresh_folder(spark, "open")))
    layers.tables.create()
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    spark.conf.set(key, given)
    try:
        layers.append_raw(raw_sales(spark, "/root/testdata/sf0.001"), "20260101-a")
        layers.stage_pending()
        layers.publish_pending()
        assert spark.conf.get(key) == given
    finally:
        spark.conf.set(key, before)
    assert len(during) == 3 and min(during) > 2  # with two folders open and two allowed, Spark sorts
    assert layers.reconcile().first().balanced and layers.fact().count() == 950
