"""RAW, STAGING and ANALYTICS as Parquet tables.

All tables are partitioned by ``load_day`` and ``load_id``; the day is the date that
the load's name begins with.  STAGING is one table for both sides of the split,
partitioned further by ``outcome``: one scan of RAW writes both.

A write of loads replaces the partitions it has rows for.  Spark writes the new files
beside the old ones and puts them in their place when all of them are whole, so a
write that fails leaves the table as it was.  Partitions that were to be replaced
and got no row are dropped after that.  A load that failed half way, or a streaming
batch that Spark runs again, can be repeated without duplicates.  Nothing is cached; each step
reads what the step before has written, so a lost executor costs its running tasks
and nothing else.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestrata import files
from salestrata.operators.reconcile import reconcile_by_load, reconcile_layers
from salestrata.operators.staging import classify_sales, staged_rows
from salestrata.profiles import Profile, resolve_profile
from salestrata.schema import (
    BAD_COLUMNS,
    CLEAN_COLUMNS,
    FACT_COLUMNS,
    LOG_COLUMNS,
    RAW_COLUMNS,
    REJECT_COLUMNS,
    STAGED_COLUMNS,
    ddl,
)
from salestrata.session import fresh_folder, open_files
from salestrata.sources.jsonl import file_counts, records_from_sorted, sorted_lines

RAW, STAGED, FACT, LOG, BAD = "raw_sales", "stg_sales", "fact_sales", "load_log", "bad_lines"
LOAD = ("load_day", "load_id")
UNDATED = "undated"
_PROFILE = "salestrata.profile"
COMPACTED = "compacted"
_READY = ".ready"
TOGETHER = 500  # loads in one write
_COMPACTED_TABLES = (RAW, STAGED, FACT)

# table: (layer, columns, partition columns)
_TABLES = {
    RAW: ("raw", RAW_COLUMNS, [*LOAD]),
    LOG: ("raw", LOG_COLUMNS, [*LOAD]),
    BAD: ("raw", BAD_COLUMNS, [*LOAD]),
    STAGED: ("staging", STAGED_COLUMNS, [*LOAD, "outcome"]),
    FACT: ("analytics", FACT_COLUMNS, [*LOAD]),
}


def load_day(load_id: str) -> str:
    """The day a load's name begins with, as in ``20260101-...`` or ``2026-01-01-...``."""
    named = re.match(r"([0-9]{8}|[0-9]{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01]))-", load_id)
    return named[1].replace("-", "") if named else UNDATED


class Tables(Protocol):
    spark: SparkSession

    def read(self, table: str) -> DataFrame: ...
    def read_load(self, table: str, load_id: str) -> DataFrame: ...
    def read_loads(self, table: str, load_ids: Sequence[str]) -> DataFrame: ...
    def loads(self, table: str, outcome: str | None = None) -> set[str]: ...
    def add_loads(self, table: str, rows: DataFrame) -> None: ...
    def replace(self, table: str, rows: DataFrame) -> None: ...
    def replace_load(self, table: str, load_id: str, rows: DataFrame) -> None: ...
    def is_compacted(self, load_id: str) -> bool: ...
    def profile(self) -> str | None: ...
    def set_profile(self, name: str) -> None: ...


def _of_load(rows: DataFrame, load_id: str) -> DataFrame:
    return rows.withColumns({"load_day": F.lit(load_day(load_id)), "load_id": F.lit(load_id)})


def _unreplaced(before: dict[str, frozenset[str]], after: dict[str, frozenset[str]]) -> list[str]:
    """Partition folders that a write of their table left alone."""
    return [folder for folder, names in before.items() if after.get(folder) == names]


class _Compaction:
    """Makes one load of all loads of a past day, table by table.

    The new files are written aside and noted as ready before anything is
    removed; ``recover`` takes a compaction that was cut short to its end.  The load
    log and the bad lines keep their rows, by which a load that is run again later is known.
    Readers should wait: between the removal and the move a day is missing.
    """

    def compact_day(self, day: str) -> None:
        self.recover()
        pending = {i for i in self.loads(RAW) - self.loads(STAGED) if load_day(i) == day}
        if pending:
            raise ValueError(f"loads of {day} are not staged yet: {sorted(pending)}")
        for table in _COMPACTED_TABLES:
            _, columns, partitions = _TABLES[table]
            rows = self.read(table).where(F.col("load_day") == day).select(*columns, *partitions[len(LOAD):])
            if any(load_day(i) == day for i in self.loads(table)):
                with open_files(rows.sparkSession):
                    (rows.write.mode("overwrite").partitionBy(*partitions[len(LOAD):])
                     .parquet(f"{self._aside()}/{table}/{day}"))
        files.write_text(self.spark, f"{self._aside()}/{day}.ready", f"{day}-{COMPACTED}")
        self.recover()

    def recover(self) -> None:
        """Puts compacted days that are whole in the place of their loads."""
        for name in files.children(self.spark, self._aside()):
            if not name.endswith(".ready"):
                continue
            day = name.removesuffix(".ready")
            merged = f"{day}-{COMPACTED}"
            for table in _COMPACTED_TABLES:
                written = f"{self._aside()}/{table}/{day}"
                if files.exists(self.spark, written):
                    self._drop_day(table, day)
                    files.move(self.spark, written, self._load_folder(table, merged))
                self._adopt(table, merged)
            files.remove(self.spark, f"{self._aside()}/{name}")

    def is_compacted(self, load_id: str) -> bool:
        """Whether a load of the log has become part of its day."""
        merged = f"{load_day(load_id)}-{COMPACTED}"
        return (merged != load_id and self._has(RAW, merged) and self._has(LOG, load_id)
                and not self._has(RAW, load_id))


class FolderTables(_Compaction):
    """The tables as folders ``root/<layer>/<table>``, without a catalog.

    A rebuild writes a new generation of its table, ``root/_generations/<table>/<number>``, beside the one
    that is read, and notes it as ready when it is whole: a reader sees all of the old one or all of the
    new one.  The one before is kept until the next rebuild, for readers that have begun.  ``path`` is where
    a table is read now; until its first rebuild that is its own folder.  A load goes into the
    generation read when it is written; one that a rebuild has passed by is pending again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def create(self) -> None:
        """Empty tables, so that they can be read before the first load."""
        for table in _TABLES:
            if not files.exists(self.spark, self._home(table)):
                self._write(table, self.spark.createDataFrame([], self._schema(table)))

    def _home(self, table: str) -> str:
        return f"{self.root}/{_TABLES[table][0]}/{table}"

    def _generations(self, table: str) -> str:
        return f"{self.root}/_generations/{table}"

    def _current(self, table: str) -> int:
        """The last generation that is whole; 0 is the table's own folder."""
        return max((int(name.removesuffix(_READY)) for name in files.children(self.spark, self._generations(table))
                    if name.endswith(_READY)), default=0)

    def _generation(self, table: str, number: int) -> str:
        return f"{self._generations(table)}/{number:09d}" if number else self._home(table)

    def path(self, table: str) -> str:
        return self._generation(table, self._current(table))

    def _schema(self, table: str, skipped: int = 0) -> str:
        _, columns, partitions = _TABLES[table]
        return ddl({**columns, **dict.fromkeys(partitions[skipped:], "string")})

    def _write(self, table: str, rows: DataFrame) -> None:
        with open_files(rows.sparkSession):
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*_TABLES[table][2]).parquet(self.path(table)))

    def _replace(self, table: str, rows: DataFrame, folder: str) -> None:
        before = files.data_files(self.spark, folder)
        self._write(table, rows)
        for left in _unreplaced(before, files.data_files(self.spark, folder)):
            files.remove(self.spark, left)

    def _load_folder(self, table: str, load_id: str) -> str:
        return f"{self.path(table)}/load_day={load_day(load_id)}/load_id={load_id}"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.schema(self._schema(table)).parquet(self.path(table))

    def read_load(self, table: str, load_id: str) -> DataFrame:
        # The folder itself: no listing of the loads before it.
        folder, schema = self._load_folder(table, load_id), self._schema(table, skipped=len(LOAD))
        if not files.exists(self.spark, folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    def read_loads(self, table: str, load_ids: Sequence[str]) -> DataFrame:
        """The rows of some loads, with the load they are of; their folders alone are listed."""
        schema, root = self._schema(table), self.path(table)
        folders = [f"{root}/load_day={load_day(load_id)}/load_id={load_id}" for load_id in load_ids]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", root).parquet(*folders)

    def loads(self, table: str, outcome: str | None = None) -> set[str]:
        """The loads that have a partition, from the names of the folders."""
        root = self.path(table)
        if outcome:
            return {path.split("/")[1].removeprefix("load_id=") for path in files.walk(self.spark, root)
                    if path.split("/")[2:3] == [f"outcome={outcome}"]}
        return {load.removeprefix("load_id=") for day in files.children(self.spark, root) if "=" in day
                for load in files.children(self.spark, f"{root}/{day}")}

    def add_loads(self, table: str, rows: DataFrame) -> None:
        """Writes loads that have no partition yet, in one job; rows name their load."""
        self._write(table, rows)

    def replace(self, table: str, rows: DataFrame) -> None:
        before = self._current(table)
        folder = self._generation(table, before + 1)
        with open_files(rows.sparkSession):
            rows.write.mode("overwrite").partitionBy(*_TABLES[table][2]).parquet(folder)
        files.write_text(self.spark, f"{folder}{_READY}", "")
        for number in range(max(before - 2, 1), before):  # of which no reader is left
            files.remove(self.spark, f"{self._generation(table, number)}{_READY}")
            files.remove(self.spark, self._generation(table, number))
        if before:
            for name in files.children(self.spark, self._home(table)):
                if name.startswith(f"{LOAD[0]}="):
                    files.remove(self.spark, f"{self._home(table)}/{name}")

    def replace_load(self, table: str, load_id: str, rows: DataFrame) -> None:
        self._replace(table, _of_load(rows, load_id), self._load_folder(table, load_id))


    def _aside(self) -> str:
        return f"{self.root}/_compact"

    def _drop_day(self, table: str, day: str) -> None:
        files.remove(self.spark, f"{self.path(table)}/load_day={day}")

    def _adopt(self, table: str, load_id: str) -> None:
        """Nothing: a folder is a partition by its place."""

    def _has(self, table: str, load_id: str) -> bool:
        return files.exists(self.spark, self._load_folder(table, load_id))

    def profile(self) -> str | None:
        """The profile that STAGING was made with, as the tables remember it."""
        return files.read_text(self.spark, f"{self._home(STAGED)}/_profile")

    def set_profile(self, name: str) -> None:
        files.write_text(self.spark, f"{self._home(STAGED)}/_profile", name)


@contextmanager
def _dynamic_overwrite(session: SparkSession) -> Iterator[None]:
    key = "spark.sql.sources.partitionOverwriteMode"
    before = session.conf.get(key)
    session.conf.set(key, "dynamic")
    try:
        yield
    finally:
        session.conf.set(key, before)


class CatalogTables(_Compaction):
    """The tables in schemas ``raw``, ``staging`` and ``analytics``.

    ``stg_sales_clean`` and ``stg_sales_rejects`` are views, each one partition
    value of ``stg_sales``.  ``prefix`` goes before the schema names.  A row
    inserted into RAW by hand without an ingest time gets the current one.
    """

    def __init__(self, spark: SparkSession, prefix: str = ""):
        self.spark = spark
        self.prefix = prefix

    def name(self, table: str) -> str:
        return f"{self.prefix}{_TABLES[table][0]}.{table}"

    def create(self) -> None:
        for table, (layer, columns, partitions) in _TABLES.items():
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.prefix}{layer}")
            schema = ddl({**columns, **dict.fromkeys(partitions, "string")})
            if table == RAW:
                schema = schema.replace("timestamp_ntz", "timestamp_ntz DEFAULT localtimestamp()", 1)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({schema}) USING parquet "
                           f"PARTITIONED BY ({', '.join(partitions)})")
        for view, columns, outcome in (("stg_sales_clean", CLEAN_COLUMNS, "clean"),
                                       ("stg_sales_rejects", REJECT_COLUMNS, "reject")):
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {self.prefix}staging.{view} AS "
                f"SELECT {', '.join(columns)} FROM {self.name(STAGED)} WHERE outcome = '{outcome}'")

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def read_load(self, table: str, load_id: str) -> DataFrame:
        return (self.read(table).where((F.col("load_day") == load_day(load_id)) & (F.col("load_id") == load_id))
                .drop(*LOAD))

    def read_loads(self, table: str, load_ids: Sequence[str]) -> DataFrame:
        days = sorted({load_day(load_id) for load_id in load_ids})
        return self.read(table).where(F.col("load_day").isin(days) & F.col("load_id").isin(list(load_ids)))

    def add_loads(self, table: str, rows: DataFrame) -> None:
        """Writes loads that have no partition yet, in one job; rows name their load."""
        self._insert(table, rows)
        self.spark.catalog.refreshTable(self.name(table))

    def loads(self, table: str, outcome: str | None = None) -> set[str]:
        named = [row[0] for row in self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()]
        wanted = f"/outcome={outcome}" if outcome else ""
        return {re.search("load_id=([^/]+)", name)[1] for name in named if name.endswith(wanted)}

    def _location(self, table: str) -> str:
        described = self.spark.sql(f"DESCRIBE FORMATTED {self.name(table)}")
        return described.where("col_name = 'Location'").first().data_type

    def _insert(self, table: str, rows: DataFrame) -> None:
        _, columns, partitions = _TABLES[table]
        with _dynamic_overwrite(rows.sparkSession), open_files(rows.sparkSession):
            rows.select(*columns, *partitions).sparkSession.sql(
                f"INSERT OVERWRITE TABLE {self.name(table)} PARTITION ({', '.join(partitions)}) "
                "SELECT * FROM {rows}", rows=rows.select(*columns, *partitions))

    def _replace(self, table: str, rows: DataFrame, inside: str) -> None:
        root = self._location(table)
        before = files.data_files(self.spark, root + inside)
        # A streaming batch has a session of its own, which knows its rows; this
        # one has to be told that the files it may have listed are others now.
        self._insert(table, rows)
        for left in _unreplaced(before, files.data_files(self.spark, root + inside)):
            values = dict(part.split("=", 1) for part in left[len(root):].strip("/").split("/"))
            named = ", ".join(f"{key} = '{value}'" for key, value in values.items())
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({named})")
        self.spark.catalog.refreshTable(self.name(table))

    def replace(self, table: str, rows: DataFrame) -> None:
        self._replace(table, rows, "")

    def replace_load(self, table: str, load_id: str, rows: DataFrame) -> None:
        self._replace(table, _of_load(rows, load_id), f"/load_day={load_day(load_id)}/load_id={load_id}")


    def _aside(self) -> str:
        return f"{self._location(RAW)}/_compact"  # a name that no reader of the table looks at

    def _load_folder(self, table: str, load_id: str) -> str:
        return f"{self._location(table)}/load_day={load_day(load_id)}/load_id={load_id}"

    def _partitions(self, table: str, **values: str) -> list[str]:
        """The partitions with these values, as specifications."""
        wanted = ", ".join(f"{key} = '{value}'" for key, value in values.items())
        shown = self.spark.sql(f"SHOW PARTITIONS {self.name(table)} PARTITION ({wanted})").collect()
        return [", ".join("{} = '{}'".format(*part.split("=", 1)) for part in row[0].split("/")) for row in shown]

    def _drop_day(self, table: str, day: str) -> None:
        for named in self._partitions(table, load_day=day):
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({named})")
        files.remove(self.spark, f"{self._location(table)}/load_day={day}")  # the empty folders above the partitions
        self.spark.catalog.refreshTable(self.name(table))

    def _adopt(self, table: str, load_id: str) -> None:
        """Tells the catalog of the partitions in a load's folder."""
        folder = self._load_folder(table, load_id)
        named = f"load_day = '{load_day(load_id)}', load_id = '{load_id}'"
        inner = _TABLES[table][2][len(LOAD):]
        found = [named] if not inner else [f"{named}, {name.split('=')[0]} = '{name.split('=')[1]}'"
                                           for name in files.children(self.spark, folder) if not files.hidden(name)]
        if files.exists(self.spark, folder):
            for partition in found:
                self.spark.sql(f"ALTER TABLE {self.name(table)} ADD IF NOT EXISTS PARTITION ({partition})")
        self.spark.catalog.refreshTable(self.name(table))

    def _has(self, table: str, load_id: str) -> bool:
        return bool(self._partitions(table, load_day=load_day(load_id), load_id=load_id))

    def profile(self) -> str | None:
        """The profile that STAGING was made with, as the tables remember it."""
        shown = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(STAGED)}").where(F.col("key") == _PROFILE).first()
        return shown.value if shown else None

    def set_profile(self, name: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(STAGED)} SET TBLPROPERTIES ('{_PROFILE}' = '{name}')")


class LoadsFailed(RuntimeError):
    """Some loads failed a step; the others have passed it."""

    def __init__(self, failed: dict[str, Exception], done: list[str]):
        super().__init__("; ".join(f"{load_id}: {error}" for load_id, error in failed.items()))
        self.failed, self.done = failed, done


class SalesLayers:
    """The load steps over a set of tables.

    Without a ``profile`` it is the one that STAGING was made with, or the
    documented one.  Loads are staged with that one only; another takes a rebuild."""

    def __init__(self, tables: Tables, profile: str | Profile | None = None,
                 on_overflow: str = "fail"):
        self.tables = tables
        self._profile = resolve_profile(profile) if profile else None
        self.on_overflow = on_overflow

    @property
    def profile(self) -> Profile:
        return self._profile or resolve_profile(self.tables.profile() or "documented")

    def append_raw(self, rows: DataFrame, load_id: str | None = None) -> str:
        """Adds a load to RAW.  The same ``load_id`` again replaces that load."""
        load_id = load_id or f"{datetime.now(timezone.utc):%Y%m%d}-{uuid.uuid4().hex}"
        if not re.fullmatch(r"[A-Za-z0-9_.\-]+", load_id):
            raise ValueError(f"load_id may hold letters, digits, '_', '.', '-': {load_id!r}")
        self.tables.replace_load(RAW, load_id, rows.select(*RAW_COLUMNS))
        return load_id

    def append_lines(self, lines: DataFrame, load_id: str | None = None,
                     ingestion_ts: datetime | str | None = None) -> str:
        """Adds a load of ``(value, source_filename)`` lines to RAW, its bad lines to a table of
        their own, and to the load log what each file held: its lines, records, blank and bad lines.

        The text is read and parsed once: the parsed lines are written, a tenth of their size, and all
        three tables are made from those.  The log has every file, however many there are; the row for the
        whole load is their sum, and the only one if a line is of no file."""
        if load_id and self.tables.is_compacted(load_id):
            return load_id  # a batch run again after its load has become part of its day
        folder = fresh_folder(self.tables.spark, "lines")
        parsed = sorted_lines(lines).withColumn("n", F.size("records"))
        with open_files(parsed.sparkSession):
            parsed.write.partitionBy("kind").parquet(folder)
        parsed = self.tables.spark.read.schema(parsed.schema).parquet(folder)
        load_id = self.append_raw(records_from_sorted(parsed.where("kind = 'read'"), ingestion_ts), load_id)
        self.tables.replace_load(BAD, load_id, parsed.where("kind = 'bad'").select(*BAD_COLUMNS))
        by_file = file_counts(parsed)
        whole = by_file.agg(*[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)
                              for name in by_file.columns[1:]]).withColumn("source_filename", F.lit(None).cast("string"))
        if parsed.where("source_filename is null").isEmpty():
            whole = whole.unionByName(by_file)
        self.tables.replace_load(LOG, load_id, whole.select(*LOG_COLUMNS))
        files.remove(self.tables.spark, folder)
        return load_id

    def _staged(self, raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        return staged_rows(classify_sales(raw, self.profile, self.on_overflow, keep), keep)

    @contextmanager
    def _of_one_profile(self) -> Iterator[None]:
        made_with = self.tables.profile()
        if made_with and made_with != self.profile.name:
            raise ValueError(f"STAGING is of profile {made_with!r}; another takes a rebuild")
        yield
        if not made_with:
            self.tables.set_profile(self.profile.name)

    def stage_load(self, load_id: str) -> None:
        """Classifies one load of RAW into its partitions of STAGING."""
        with self._of_one_profile():
            self.tables.replace_load(STAGED, load_id, self._staged(self.tables.read_load(RAW, load_id)))

    def _stage_loads(self, load_ids: list[str]) -> None:
        with self._of_one_profile():
            self.tables.add_loads(STAGED, self._staged(self.tables.read_loads(RAW, load_ids), LOAD))

    def stage_pending(self) -> list[str]:
        """Stages the loads that are in RAW and not in STAGING, many in a job.  One that fails, as on
        an amount too large, keeps no other from being staged; the failures are raised at the end."""
        return self._together(self._stage_loads, self.tables.loads(RAW) - self.tables.loads(STAGED))

    def publish_load(self, load_id: str) -> None:
        """Puts the clean side of one load into its partition of the fact table."""
        clean = self.tables.read_load(STAGED, load_id).where(F.col("outcome") == "clean")
        self.tables.replace_load(FACT, load_id, clean.select(*FACT_COLUMNS))

    def _publish_loads(self, load_ids: list[str]) -> None:
        clean = self.tables.read_loads(STAGED, load_ids).where(F.col("outcome") == "clean")
        self.tables.add_loads(FACT, clean.select(*FACT_COLUMNS, *LOAD))

    def publish_pending(self) -> list[str]:
        """Publishes the loads that have clean rows in STAGING and no fact, many in a job."""
        return self._together(self._publish_loads, self.tables.loads(STAGED, "clean") - self.tables.loads(FACT))

    @staticmethod
    def _together(step, load_ids: set[str]) -> list[str]:
        """Takes a step for ``TOGETHER`` loads at a time.  A write that fails leaves nothing behind; it is
        repeated for both halves of its loads, so those that make it fail are left by themselves after a
        few halvings, and all others are written."""
        done, failed = [], {}
        ordered = sorted(load_ids)
        waiting = [ordered[i:i + TOGETHER] for i in range(0, len(ordered), TOGETHER)][::-1]
        while waiting:
            some = waiting.pop()
            try:
                step(some)
                done += some
            except Exception as error:  # the other loads must not wait for this one
                if len(some) == 1:
                    failed[some[0]] = error
                else:
                    waiting += [some[len(some) // 2:], some[:len(some) // 2]]
        if failed:
            raise LoadsFailed(failed, done)
        return done

    def rebuild_staging(self) -> None:
        """Replaces STAGING from all of RAW."""
        profile = self.profile
        self.tables.replace(STAGED, self._staged(self.tables.read(RAW), LOAD))
        self.tables.set_profile(profile.name)

    def rebuild_fact(self) -> None:
        """Replaces the fact table from the clean side of STAGING."""
        clean = self.tables.read(STAGED).where(F.col("outcome") == "clean")
        self.tables.replace(FACT, clean.select(*FACT_COLUMNS, *LOAD))

    def load_log(self) -> DataFrame:
        """One row per load and file; the whole load's numbers where ``source_filename`` is NULL."""
        return self.tables.read(LOG).select(*LOAD, *LOG_COLUMNS)

    def bad_lines(self) -> DataFrame:
        """The lines that were counted as bad, as they came."""
        return self.tables.read(BAD).select(*LOAD, *BAD_COLUMNS)

    def raw(self) -> DataFrame:
        return self.tables.read(RAW).select(*RAW_COLUMNS)

    def clean(self) -> DataFrame:
        return self.tables.read(STAGED).where(F.col("outcome") == "clean").select(*CLEAN_COLUMNS)

    def rejects(self) -> DataFrame:
        return self.tables.read(STAGED).where(F.col("outcome") == "reject").select(*REJECT_COLUMNS)

    def fact(self) -> DataFrame:
        return self.tables.read(FACT).select(*FACT_COLUMNS)

    def reconcile(self) -> DataFrame:
        return reconcile_layers(self.raw(), self.clean(), self.rejects(), self.fact())

    def reconcile_loads(self) -> DataFrame:
        """The same load by load, with the load log beside it.  What the log says of loads that have
        become one of their day counts for that one."""
        staged, log = self.tables.read(STAGED), self.tables.read(LOG).where("source_filename is null")
        raw = self.tables.read(RAW)
        merged = raw.where(F.col("load_id").endswith(f"-{COMPACTED}")).select(
            F.col("load_day").alias("merged_day"), F.col("load_id").alias("merged_id")).distinct()
        own = raw.select(F.col("load_id").alias("own_id")).distinct()
        log = (log.join(own, F.col("load_id") == F.col("own_id"), "left")
               .join(merged, F.col("load_day") == F.col("merged_day"), "left")
               .select("load_day", F.expr("if(own_id is null, coalesce(merged_id, load_id), load_id)").alias("load_id"), "n_records"))
        return reconcile_by_load(raw, staged.where("outcome = 'clean'"), staged.where("outcome = 'reject'"),
                                 self.tables.read(FACT), log, LOAD)
