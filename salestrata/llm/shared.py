"""Intermediate tables and files of the operators, in the folder all executors see."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import salestrata
from salestrata import files

from salestrata.session import fresh_folder, shared_folder


new_folder = fresh_folder
remove = files.remove


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in the tasks, wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_salestrata_shipped", False):
        return
    root = Path(salestrata.__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="salestrata-package-")  # on the driver; Spark serves it to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = shutil.make_archive(os.path.join(folder, "salestrata_package"), "zip",
                                  root.parent, root.name)
    context.addPyFile(archive)
    context._salestrata_shipped = True


# What goes to a Python worker at a time; Spark's default is eight times as much.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH = "8m"


def in_tasks(frame: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand in the tasks.  Sessions that do not say how
    large an Arrow batch may be get ``BATCH``, as batches are held in Python beside Spark's own memory."""
    spark = frame.sparkSession
    ship_package(spark)
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, BATCH)
    return frame.mapInArrow(function, schema)


def cut(frame: DataFrame) -> DataFrame:
    """The frame's rows, kept in the checkpoint folder: later steps neither repeat
    the work nor depend on the executors that did it.  Spark removes the files
    with the frame if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set,
    and in any case they go with the driver."""
    spark = frame.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    if not getattr(context, "_salestrata_checkpoints", False):
        files.remove_at_exit(spark, context.getCheckpointDir())  # a folder of this application alone
        context._salestrata_checkpoints = True
    return frame.checkpoint()


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The same for rows with texts: written as Parquet, which shrinks them."""
    folder = fresh_folder(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def _first_of_task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for part in parts:
        new = []
        for i, key in enumerate(part.column("key").to_pylist()):
            if key not in seen:
                seen.add(key)
                new.append(i)
        if new:
            yield part.take(pa.array(new))


def one_text_each(rows: DataFrame) -> DataFrame:
    """``(key, text)`` with each key once, of ``(key, text)`` rows that have a bounded number
    of keys, which are hashes of their texts; copies do not leave their task."""
    rows = rows.select("key", "text")
    return in_tasks(rows, _first_of_task, rows.schema).groupBy("key").agg(F.min("text").alias("text"))


# Rows of a few numbers that may be sent to all executors.
SMALL = 10_000


def small_side(frame: DataFrame, most: int = SMALL) -> DataFrame:
    """A side of a join, marked for broadcast if it has ``most`` rows at most.  It is
    counted first; a larger one is joined by its key."""
    frame = cut(frame)
    return F.broadcast(frame) if frame.count() <= most else frame


def columns(names: Iterable[str]) -> list[Column]:
    """The columns of these names as they stand, dots and all."""
    return [F.col(f"`{name}`") for name in names]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
