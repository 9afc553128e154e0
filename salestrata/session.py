"""Session settings, and the shared folder that written intermediates go to."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestrata import files

# timeZone: results do not depend on it (all times are zone-free), but the
#   default of the ingest time does.
# ansi: an amount too large for its column must fail the write, not turn NULL.
# codec: zstd made the tables a third smaller than the default for about five
#   percent more time to write.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

# For loads of a large landing folder.  Text shrinks eight- to twelvefold on its
# way into RAW, so 1 GB of text per task gives RAW files of around 100 MB;
# parsing is row by row, so the larger split needs no more memory.  The low open cost
# packs many small landing files into one task.
LOAD_CONF = {
    "spark.sql.files.maxPartitionBytes": "1g",
    "spark.sql.files.openCostInBytes": "256k",
}

# Rows that a task may hold before it is worth a shuffle to deal them out, and how much longer
# than with even tasks a scan may then take.
LARGE_TASK = 250_000
UNEVEN = 1.25

# Folders that a task writes side by side: the three kinds of a load's lines, or both sides of
# the split.  Spark begins to sort as soon as so many are open, so it is one more.
OPEN_FILES = 4
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"

_local_folders: list[tempfile.TemporaryDirectory] = []


def build_session(app: str = "salestrata", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Only a local-mode session without the setting gets a folder of its own; a
    cluster's session without it is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
    if not _local_folders:
        _local_folders.append(tempfile.TemporaryDirectory(prefix="salestrata-"))
    return _local_folders[0].name


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A name for a new folder in the shared one.  What is written there is removed
    when the driver ends, if not before."""
    parent = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    files.remove_at_exit(spark, parent)
    return f"{parent}/data"


@contextmanager
def open_files(session: SparkSession) -> Iterator[None]:
    """For partitioned writes, whatever the session's settings: a task's rows go straight into their
    folders.  Else Spark sorts them all first, to have one file open at a time, and large tasks spill.
    Past ``OPEN_FILES`` folders in a task it sorts the rest."""
    before = session.conf.get(_OPEN_FILES)
    session.conf.set(_OPEN_FILES, max(int(before), OPEN_FILES))
    try:
        yield
    finally:
        session.conf.set(_OPEN_FILES, before)


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """The same rows; dealt out by ranges of their keys if the tasks of the scan are large and leave cores idle: too few
    of them, one far larger than the rest, or a last round of a few.

    Spark cannot split a row group, so a table of a few large ones keeps as few cores busy, whatever
    follows without a shuffle.  The rows of each task are counted from the footers.  Ranges keep
    neighbours together, which compress better in the files written from them."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    by_task = rows.select(F.spark_partition_id().alias("task")).groupBy("task").agg(F.count(F.lit(1)).alias("n"))
    largest, total, tasks = by_task.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0)),
                                        F.count(F.lit(1))).first()
    if largest <= LARGE_TASK or max(largest, math.ceil(tasks / cores) * total / tasks) <= UNEVEN * total / cores:
        return rows
    return rows.repartitionByRange(2 * cores, *keys)
