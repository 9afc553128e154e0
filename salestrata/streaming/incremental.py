"""Incremental load: only files not loaded before, then the quality split."""

from __future__ import annotations

import hashlib
import json
import logging
import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from salestrata import files
from salestrata.plans.layers import SalesLayers
from salestrata.sources.jsonl import read_lines

_QUERY_ID = "sql.streaming.queryId"
# Everything in a folder but names that begin with ``dt=``, ``_`` or ``.``; those of the
# latter that are no folder of a day and that Spark reads are added by name.
_UNDATED = "[^d_.]*,d,d[^t]*,dt,dt[^=]*"

log = logging.getLogger(__name__)


def landing_days(layers: SalesLayers, landing: str) -> dict[str, str]:
    """The ``dt=`` folders by what follows the sign, be it a day or not; the rest of the
    landing folder under the empty name."""
    dated, rest = _sorted_out(layers.tables.spark, landing)
    by_name = sorted(files.literal(name) for name in rest if name.startswith(("dt=", "_", ".")))
    undated = {"": f"{landing}/{{{','.join([_UNDATED, *by_name])}}}"} if rest else {}
    return {**undated, **{day: f"{landing}/{files.literal(f'dt={day}')}" for day in dated}}


def _sorted_out(spark: SparkSession, landing: str) -> tuple[list[str], list[str]]:
    """What follows the sign of the ``dt=`` folders, and the names of all else that Spark reads."""
    names = [name for name in files.children(spark, landing) if not files.hidden(name)]
    dated = {name for name in names if name.startswith("dt=") and name != "dt="
             and files.is_folder(spark, f"{landing}/{name}")}
    return sorted(name[3:] for name in dated), sorted(name for name in names if name not in dated)


class FolderIndex:
    """What each folder's names were when it was last loaded, as one digest a folder, in a file
    beside the checkpoints.  A folder whose names are the same has nothing new; it is
    noted after its stream has ended, so one that failed is looked at again."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.file = spark, f"{checkpoint}/folders.json"
        self.known: dict[str, str] = json.loads(files.read_text(spark, self.file) or "{}")

    @staticmethod
    def digest(names: list[str]) -> str:
        whole = hashlib.sha256()
        for name in sorted(names):
            whole.update(name.encode() + b"\0")
        return whole.hexdigest()

    def note(self, day: str, digest: str) -> None:
        self.known[day] = digest
        files.replace_text(self.spark, self.file, json.dumps(self.known, sort_keys=True))


def _names_of(spark: SparkSession, landing: str, day: str, shown: dict[str, list[str]]) -> list[str]:
    """The paths of a day's files that Spark reads; ``shown`` gets those that it passes over."""
    if day:
        folder = f"{landing}/dt={day}"
        visible = files.walk(spark, folder)
        shown[day] = [f"{folder}/{name}" for name in files.hidden_below(spark, folder, visible)]
        return visible
    dated, rest = _sorted_out(spark, landing)
    paths = []
    shown[""] = [f"{landing}/{name}" for name in files.children(spark, landing) if files.hidden(name)]
    for name in rest:
        folder = f"{landing}/{name}"
        if not files.is_folder(spark, folder):
            paths.append(name)
            continue
        visible = files.walk(spark, folder)
        paths += [f"{name}/{path}" for path in visible]
        shown[""] += [f"{folder}/{path}" for path in files.hidden_below(spark, folder, visible)]
    return paths


def load_new_files(layers: SalesLayers, landing: str, checkpoint: str, *, stage: bool = True,
                   ingestion_ts: datetime | str | None = None,
                   max_files_per_batch: int | None = None, days: list[str] | None = None) -> list[str]:
    """Loads the files of ``landing`` that ``checkpoint`` has not seen; the names of the loads.

    Each ``dt=`` folder is a stream of its own with a checkpoint of its own, so what the
    driver lists and remembers at a time is the files of one day.  ``days``
    names those to look at (``""`` for files outside of any); without it all are listed,
    as a file may arrive late in any, but only those whose names have changed since
    (``FolderIndex``) start a stream.

    Every batch becomes one load of RAW, named after the day, the query and the
    batch, so a batch that Spark runs again replaces what its first run left
    behind.  What its files held is in the load log.  A new checkpoint starts new
    queries and loads all files again.  The streams write RAW only.  With
    ``stage`` the loads not staged yet are then classified into STAGING, each by
    itself: one that fails is raised at the end and holds up no other.

    A file is known by its path: one rewritten in place is not read again.  The
    files seen are remembered without an age limit, since a file that arrives
    late with an old time would otherwise be skipped.  ``max_files_per_batch``
    bounds a batch; the backlog is then worked off in several batches.
    Files that Spark passes over by their names are logged as a warning.
    """
    spark = layers.tables.spark
    landing, checkpoint = landing.rstrip("/"), checkpoint.rstrip("/")
    options = {"maxFileAge": "36500d"}
    if max_files_per_batch:
        options["maxFilesPerTrigger"] = str(max_files_per_batch)
    loaded: list[str] = []
    index = FolderIndex(spark, checkpoint)

    for day, folder in landing_days(layers, landing).items():
        if days is not None and day not in days:
            continue
        passed_over: dict[str, list[str]] = {}
        digest = index.digest(_names_of(spark, landing, day, passed_over))
        if shown := passed_over[day]:
            log.warning("%d names begin with '_' or '.' and are not read: %s", len(shown), shown[:10])
        if index.known.get(day) == digest:
            continue

        def load(batch: DataFrame, batch_id: int, day: str = day) -> None:
            query_id = batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID)
            name = f"{query_id}-{batch_id:010d}"
            prefix = re.sub(r"[^A-Za-z0-9_.\-]", "_", day) or "undated"
            loaded.append(layers.append_lines(batch, f"{prefix}-{name}", ingestion_ts))

        query = (read_lines(spark, folder, streaming=True, **options).writeStream.foreachBatch(load)
                 .option("checkpointLocation", f"{checkpoint}/{f'dt={day}' if day else 'undated'}")
                 .trigger(availableNow=True)
                 .start())
        query.awaitTermination()
        index.note(day, digest)

    if stage:
        layers.stage_pending()
    return loaded
