"""Spark job over the three layers, for spark-submit.

    run_layers.py load    --landing URI --tables URI --checkpoint URI
    run_layers.py rebuild --tables URI
    run_layers.py report  --tables URI --out URI
    run_layers.py compact --tables URI --day YYYYMMDD

``load`` takes in the files not loaded before, prints what each held, splits them
into clean rows and rejects and adds the clean ones to the fact table; ``rebuild``
replaces STAGING and the fact table from RAW;
``report`` writes every report as one folder of JSON Lines; ``compact`` makes one
load of a day's loads.  Without ``--tables`` the layers are catalog tables.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestrata import files
from salestrata.operators import reports
from salestrata.plans import CatalogTables, FolderTables, SalesLayers, report_book
from salestrata.session import LOAD_CONF, build_session, fresh_folder
from salestrata.streaming import load_new_files

def _of_book(report: str, key: str, measures: dict[str, str], rank: str | None, top: int | None = None):
    """A report out of the book: its key under its own name, ranked or in the order of the key."""
    def take(book: DataFrame) -> DataFrame:
        value = F.col("key").cast("timestamp_ntz") if key == "day" else F.col("key")
        rows = book.where(F.col("report") == report).select(
            value.alias(key), *[F.col(column).alias(name) for name, column in measures.items()])
        ordered = rows.orderBy(F.desc(rank), F.asc_nulls_last(key)) if rank else rows.orderBy(key)
        return ordered.limit(top) if top else ordered
    return take


_SALES = {"total_sales": "total_sales"}
_UNITS = {"total_units": "total_units"}
_REVENUE = {"total_revenue": "total_revenue"}
REPORTS = {
    "daily_summary": _of_book("daily", "day", {"events": "total_sales", "units": "total_units",
                                               "revenue": "total_revenue"}, None),
    "daily_revenue": _of_book("daily", "day", _SALES | _REVENUE, None),
    "category_revenue": _of_book("category", "category", _SALES | _UNITS | _REVENUE, "total_revenue"),
    "payment_methods": _of_book("payment_method", "payment_method", _SALES | _REVENUE, "total_sales"),
    "top_countries": _of_book("country", "country", _SALES | _REVENUE, "total_revenue", 10),
    "marketing_channels": _of_book("marketing_channel", "marketing_channel", _SALES | _REVENUE, "total_revenue"),
}


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("step", choices=["load", "rebuild", "report", "compact"])
    parser.add_argument("--tables", help="root folder of the tables; catalog tables without it")
    parser.add_argument("--landing", help="folder the JSON Lines files land in")
    parser.add_argument("--checkpoint", help="folder that remembers the files loaded")
    parser.add_argument("--out", help="folder the reports go to")
    parser.add_argument("--profile", choices=["documented", "literal"],
                        help="the one STAGING was made with, or documented, without it")
    parser.add_argument("--on-overflow", default="fail", choices=["fail", "reject"])
    parser.add_argument("--day", help="the past day whose loads become one")
    parser.add_argument("--max-files-per-batch", type=int)
    args = parser.parse_args(argv)
    needed = {"load": ["landing", "checkpoint"], "rebuild": [], "report": ["out"],
              "compact": ["day"]}[args.step]
    missing = [f"--{name}" for name in needed if not getattr(args, name)]
    if missing:
        parser.error(f"{args.step} needs {' and '.join(missing)}")
    return args


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session(f"salestrata-{args.step}", conf=LOAD_CONF if args.step == "load" else None)
    tables = FolderTables(spark, args.tables) if args.tables else CatalogTables(spark)
    tables.create()
    layers = SalesLayers(tables, args.profile, args.on_overflow)
    if args.step == "load":
        loads = []
        try:
            loads = load_new_files(layers, args.landing, args.checkpoint,
                                   max_files_per_batch=args.max_files_per_batch, stage=False)
        finally:
            layers.load_log().where(F.col("load_id").isin(loads)).orderBy("load_id", "source_filename").show(100, False)
        layers.stage_pending()
        layers.publish_pending()
    elif args.step == "compact":
        tables.compact_day(args.day)
    elif args.step == "rebuild":
        layers.rebuild_staging()
        layers.rebuild_fact()
    else:
        write_reports(layers, args.out)


def write_reports(layers: SalesLayers, out: str) -> None:
    """Every report as a folder of JSON Lines; a NULL key is written as such.

    The five reports by one key come from one scan of the fact, through the
    sums of ``report_book``; those sums are what is read once per report."""
    def put(rows, name: str) -> None:
        rows.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{out}/{name}")

    book = fresh_folder(layers.tables.spark, "book")
    report_book(layers.tables.spark, layers.fact()).write.parquet(book)
    sums = layers.tables.spark.read.parquet(book)
    for name, report in REPORTS.items():
        put(report(sums), name)
    put(reports.reject_reasons(layers.rejects()), "reject_reasons")
    put(layers.reconcile(), "reconciliation")
    files.remove(layers.tables.spark, book)


if __name__ == "__main__":
    main()
