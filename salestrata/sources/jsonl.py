"""Tolerant ingest of JSON Lines folders into RAW rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salestrata import files
from salestrata.functions import store_path
from salestrata.operators.records import parse_text, records, strip_outer_array
from salestrata.schema import RAW_COLUMNS


def read_lines(spark: SparkSession, path: str, streaming: bool = False,
               **options: str) -> DataFrame:
    """Every line of every file under ``path``, with the file it is from.

    The recursive lookup reads all folders and keeps ``dt=`` from turning into
    a column; ``dt`` is the day of the load, not of the sale.  Names that begin
    with ``_`` or ``.`` are not read, as by every file source of Spark:
    ``skipped_names`` lists them.
    """
    reader = spark.readStream if streaming else spark.read
    lines = reader.options(recursiveFileLookup="true", **options).format("text").load(path)
    return lines.select("value", store_path(F.col("_metadata.file_path")).alias("source_filename"))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The same with the whole text of a file as one value."""
    files = read_lines(spark, path, wholetext="true")
    # Spark drops a byte order mark from lines, but not from a whole file.
    return files.withColumn("value", F.regexp_replace("value", "^\ufeff", ""))


def ingest_time(ingestion_ts: datetime | str | None) -> Column:
    if ingestion_ts is None:
        return F.localtimestamp()
    return F.lit(str(ingestion_ts)).cast("timestamp_ntz")


def _parsed(lines: DataFrame) -> DataFrame:
    blank = F.rlike("value", F.lit(r"^\s*$"))
    return parse_text(lines.select("value", "source_filename", blank.alias("blank")))


def _kinds() -> dict[str, Column]:
    return {"n_lines": F.lit(True), "n_blank": F.col("blank"), "n_bad": records().isNull() & ~F.col("blank")}


def records_from_lines(lines: DataFrame, ingestion_ts: datetime | str | None = None,
                       observation: Observation | str | None = None) -> DataFrame:
    """RAW rows from ``(value, source_filename)`` lines.

    A line that is not one JSON value, is blank, or repeats a key gives no row
    and the load goes on.  ``observation`` counts them on the way, without a
    second pass: ``n_lines``, ``n_blank`` and ``n_bad`` (blank not included).
    ``sorted_lines`` and ``file_counts`` have them by file.
    """
    parsed = _parsed(lines)
    if observation is not None:
        parsed = parsed.observe(observation, *[F.count_if(kind).alias(name) for name, kind in _kinds().items()])
    raw = strip_outer_array(parsed.drop("blank"))
    return raw.withColumn("ingestion_ts", ingest_time(ingestion_ts)).select(*RAW_COLUMNS)


def sorted_lines(lines: DataFrame) -> DataFrame:
    """``(source_filename, kind, records, value)`` per line, parsed once: ``records`` is an array, empty
    for a line without any; ``value`` is there for bad lines, whose ``kind`` is ``bad``."""
    blank = F.rlike("value", F.lit(r"^\s*$"))
    parsed = parse_text(lines.select("value", F.col("value").alias("line"), "source_filename", blank.alias("blank")))
    taken = parsed.select("source_filename", "line", "blank", records().alias("records"))
    kind = F.when(F.col("blank"), "blank").when(F.col("records").isNull(), "bad").otherwise("read")
    return taken.select("source_filename", kind.alias("kind"), F.coalesce("records", F.array().cast("array<variant>")).alias("records"),
                        F.when(kind == "bad", F.col("line")).alias("value"))


def records_from_sorted(lines: DataFrame, ingestion_ts: datetime | str | None = None) -> DataFrame:
    """RAW rows of such lines."""
    rows = lines.select("source_filename", F.explode("records").alias("raw"))
    return rows.withColumn("ingestion_ts", ingest_time(ingestion_ts)).select(*RAW_COLUMNS)


def file_counts(lines: DataFrame) -> DataFrame:
    """``(source_filename, n_lines, n_records, n_blank, n_bad)`` of all files, from such lines.
    Only the sizes of the record arrays are looked at."""
    return lines.groupBy("source_filename").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("n").cast("long")).alias("n_records"),
        F.count_if(F.col("kind") == "blank").alias("n_blank"), F.count_if(F.col("kind") == "bad").alias("n_bad"))


def skipped_names(spark: SparkSession, path: str) -> list[str]:
    """The files and folders under ``path`` that Spark's sources pass over: those with a
    name that begins with ``_`` or ``.``; a names-only listing."""
    return [f"{path.rstrip('/')}/{name}" for name in files.hidden_below(spark, path.rstrip("/"))]


def ingest_jsonl(spark: SparkSession, path: str, ingestion_ts: datetime | str | None = None,
                 observation: Observation | str | None = None,
                 multi_line: bool = False) -> DataFrame:
    """RAW rows of all files under ``path``: narrow, one stage, no shuffle.

    ``multi_line`` is for files that each hold one JSON value spread over
    several lines, such as a pretty-printed array.  Such a file is one task and
    one text in memory, 2 GB at most; a file that is not one JSON value gives
    no row and counts as a bad line.  Plain JSON Lines, which Spark splits, is
    the route for volume.
    """
    texts = read_files(spark, path) if multi_line else read_lines(spark, path)
    return records_from_lines(texts, ingestion_ts, observation)
