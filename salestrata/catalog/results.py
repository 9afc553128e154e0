"""Named results over the ``events`` table."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestrata import files
from salestrata.functions import (
    json_text,
    json_value,
    safe_number,
    safe_timestamp,
    sales_day,
    store_path,
)
from salestrata.operators import (
    classify_sales,
    clean_rows,
    extract_event,
    parse_text,
    reject_rows,
    rule_flags,
    sales_rules,
    strip_outer_array,
)
from salestrata.operators import reports
from salestrata.plans import CatalogTables, FolderTables, SalesLayers, report_book
from salestrata.profiles import DOCUMENTED, LITERAL, Profile
from salestrata.schema import EVENT_COLUMNS, MONEY_COLUMNS
from salestrata.session import fresh_folder
from salestrata.sources import ingest_jsonl, records_from_lines, write_jsonl
from salestrata.catalog.events_feed import (
    FILE_FORMS,
    INGESTION_TS,
    NUMBER_FORMS,
    TIME_FORMS,
    iso_text,
    messy_lines,
    pick_form,
    read_events,
    sales_events,
    sales_lines,
)
from salestrata.streaming import load_new_files

Query = Callable[[SparkSession, str], DataFrame]

# The reports read the fact table, the histogram reads the rejects.
REPORTS = {
    "daily_summary": reports.daily_summary,
    "q1_daily_revenue": reports.daily_revenue,
    "q2_category_revenue": reports.category_revenue,
    "q3_payment_methods": reports.payment_methods,
    "q4_top_countries": reports.top_countries,
    "q5_marketing_channels": reports.marketing_channels,
}


# --- the layers over the derived feed, nothing written ------------------------

def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_from_lines(sales_lines(read_events(spark, sf_dir)), INGESTION_TS)


def classified(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    return classify_sales(raw_sales(spark, sf_dir), profile)


def clean(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    return clean_rows(classified(spark, sf_dir, profile))


def rejects(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    return reject_rows(classified(spark, sf_dir, profile))


def _raw_count(spark, sf_dir):
    return reports.row_count(raw_sales(spark, sf_dir), "total_raw_rows")


def _clean_count(spark, sf_dir, profile):
    return reports.row_count(clean(spark, sf_dir, profile), "clean_rows")


def _reject_count(spark, sf_dir, profile):
    return reports.row_count(rejects(spark, sf_dir, profile), "reject_rows")


def _reject_reasons(spark, sf_dir, profile):
    return reports.reject_reasons(rejects(spark, sf_dir, profile))


def _report(report, spark, sf_dir, profile):
    return report(clean(spark, sf_dir, profile))


def _stg_sales_rejects(spark, sf_dir, profile):
    """The payload goes out as its fields, as a variant cannot be compared."""
    fields = [
        (safe_number(json_text("raw", key), 2) if key in MONEY_COLUMNS
         else json_text("raw", key)).alias(key)
        for key in EVENT_COLUMNS
    ]
    return rejects(spark, sf_dir, profile).select("reason", *fields, "source_filename",
                                                  "ingestion_ts")


def _report_book(spark, sf_dir, profile):
    return report_book(spark, clean(spark, sf_dir, profile))


def _rule_flags(spark, sf_dir, profile):
    return rule_flags(extract_event(raw_sales(spark, sf_dir), profile), sales_rules(profile))


# --- single operators over values made from every event -----------------------

def _json_access(spark, sf_dir):
    """Absent key, JSON null, and text of strings, numbers, booleans, objects."""
    lines = read_events(spark, sf_dir).selectExpr(
        "event_id as row_id",
        "case event_id % 3 when 0 then '{}' when 1 then '{\"a\": null}' "
        "else '{\"a\": \"E' || event_id || '\"}' end as a",
        "'{\"n\": ' || event_id || ', \"flag\": ' || (event_id % 2 = 0) "
        "|| ', \"A\": 1, \"o\": ' || props || '}' as b")
    parsed = lines.select("row_id", F.try_parse_json("a").alias("va"),
                          F.try_parse_json("b").alias("vb"))
    return parsed.select(
        "row_id",
        json_value("va", "a").isNull().alias("a_is_absent"),
        json_text("va", "a").alias("a_text"),
        json_text("vb", "n").alias("n_text"),
        json_text("vb", "flag").alias("flag_text"),
        json_value("vb", "a").isNull().alias("other_case_is_absent"),
        json_text("vb", "o").alias("object_text"),
    )


def _strip_outer_array(spark, sf_dir):
    """Lines with no, one or several elements, or an object without an array."""
    lines = read_events(spark, sf_dir).selectExpr(
        "event_id as row_id",
        "case event_id % 4 when 3 then props "
        "else '[' || repeat(props || ', ', cast(event_id % 4 as int)) || event_id || ']' end as value")
    records = strip_outer_array(parse_text(lines))
    is_object = json_value("raw", "k").isNotNull()
    return records.select(
        "row_id", json_text("raw", "k").alias("k"),
        F.when(~is_object, F.expr("variant_get(raw, '$', 'string')")).alias("scalar"))


def _tolerant_load(spark, sf_dir):
    records = records_from_lines(messy_lines(read_events(spark, sf_dir)), INGESTION_TS)
    return records.groupBy(F.col("source_filename").alias("line_kind")).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count(json_text("raw", "event_id")).alias("n_with_id"),
        F.max(json_text("raw", "event_id")).alias("last_id"))


def _safe_timestamps(spark, sf_dir):
    texts = read_events(spark, sf_dir).selectExpr(
        "event_id as row_id", f"{pick_form(TIME_FORMS, iso=iso_text('ts'))} as text")
    parsed = safe_timestamp(F.col("text"))
    return texts.select("row_id", "text", parsed.alias("event_ts"),
                        sales_day(parsed).cast("timestamp_ntz").alias("day"))


def _safe_numbers(spark, sf_dir):
    parts = {"price": "cast(cast(value as decimal(10,2)) as string)",
             "k": "get_json_object(props, '$.k')"}
    texts = read_events(spark, sf_dir).selectExpr(
        "event_id as row_id", f"{pick_form(NUMBER_FORMS, **parts)} as text")
    return texts.select("row_id", "text",
                        safe_number(F.col("text")).alias("whole"),
                        safe_number(F.col("text"), 2).cast("decimal(10,2)").alias("money"))


def _store_paths(spark, sf_dir):
    files = read_events(spark, sf_dir).selectExpr(
        "event_id as row_id", f"{pick_form(FILE_FORMS)} as uri")
    return files.select("row_id", "uri", store_path(F.col("uri")).alias("source_filename"))


def _ingest_time(spark, sf_dir):
    """Without a given ingest time all rows of a load carry the same current one."""
    records = records_from_lines(sales_lines(read_events(spark, sf_dir)))
    recent = F.col("ingestion_ts").between(F.localtimestamp() - F.expr("interval 1 day"),
                                           F.localtimestamp())
    return records.agg(F.count(F.lit(1)).alias("n_records"),
                       F.count_if(recent).alias("n_recent"),
                       (F.min("ingestion_ts") == F.max("ingestion_ts")).alias("one_time"))


def _money_overflow(spark, sf_dir):
    """Totals a million times the usual: those beyond the column are rejected."""
    lines = sales_events(read_events(spark, sf_dir)).select(
        F.to_json(F.struct(
            "event_id", F.col("event_ts").cast("string").alias("event_ts"), "quantity",
            "unit_price", (F.col("total_amount") * 1000000).alias("total_amount"))).alias("value"),
        F.lit("feed").alias("source_filename"))
    records = records_from_lines(lines, INGESTION_TS)
    split = classify_sales(records, DOCUMENTED, on_overflow="reject")
    return split.groupBy("reason").agg(F.count(F.lit(1)).alias("n"),
                                       F.max(F.when(F.col("reason").isNull(), F.col("total_amount")))
                                       .cast("decimal(10,2)").alias("largest_kept"))


# --- the same with files and tables, in the shared folder ----------------------

def _write_lines(lines: DataFrame, folder: str) -> None:
    lines.select("value").write.text(folder)


def _jsonl_sink(spark, sf_dir):
    """Writes every event as JSON Lines, reads the folder back, sums it up."""
    root = f"{fresh_folder(spark, 'sink')}/raw/sales"
    events = sales_events(read_events(spark, sf_dir))
    events = events.withColumn("event_id", F.when(F.col("fault") != 0, F.col("event_id")))
    write_jsonl(events.drop("fault"), root, dt="20260101", max_records_per_file=1_000_000)
    raw = ingest_jsonl(spark, root, INGESTION_TS)
    folder = F.regexp_extract("source_filename", r"(raw/sales/dt=[0-9]{8})/[^/]+$", 1)
    records = extract_event(raw).withColumn("folder", folder)
    no_id = F.col("event_id").isNull()
    return records.groupBy("folder", "ingestion_ts").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(no_id).alias("n_null_ids"),
        F.count_if(json_value("raw", "event_id").isNull()).alias("n_absent_ids"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
        F.sum(F.col("quantity").cast("bigint")).alias("units"),
        F.sum("total_amount").cast("decimal(20,2)").alias("revenue"),
    )


def _written_layers(spark, sf_dir, profile, load_ids=("20260101-first",)) -> SalesLayers:
    """Loads of the feed, each the same, then both rebuilds."""
    layers = SalesLayers(FolderTables(spark, fresh_folder(spark, "layers")), profile)
    layers.tables.create()
    rows = raw_sales(spark, sf_dir)
    for load_id in load_ids:
        layers.append_raw(rows, load_id)
        rows = layers.tables.read_load("raw_sales", load_ids[0])
    layers.rebuild_staging()
    layers.rebuild_fact()
    return layers


def _reconciliation(spark, sf_dir, profile):
    return _written_layers(spark, sf_dir, profile).reconcile()


def _fact_count(spark, sf_dir, profile):
    return reports.row_count(_written_layers(spark, sf_dir, profile).fact(), "fact_rows")


def _fact_sales(spark, sf_dir, profile):
    return _written_layers(spark, sf_dir, profile).fact()


# The second load is written twice.
_TWO_LOADS = ("20260101-first", "20260102-second", "20260102-second")


def _layer_tables(spark, sf_dir, profile):
    return _written_layers(spark, sf_dir, profile, _TWO_LOADS).reconcile()


def _layer_reports(spark, sf_dir, profile):
    return reports.category_revenue(_written_layers(spark, sf_dir, profile, _TWO_LOADS).fact())


def _incremental_layers(spark, sf_dir) -> SalesLayers:
    """Lands the feed under two days and loads after each, plus once for nothing."""
    root = fresh_folder(spark, "incremental")
    layers = SalesLayers(FolderTables(spark, f"{root}/tables"))
    layers.tables.create()
    lines = sales_lines(read_events(spark, sf_dir))
    for day in ("20260101", None, "20260102"):
        if day:
            _write_lines(lines, f"{root}/landing/raw/sales/dt={day}")
        load_new_files(layers, f"{root}/landing", f"{root}/checkpoint", ingestion_ts=INGESTION_TS)
    return layers


def _incremental_load(spark, sf_dir):
    loads = _incremental_layers(spark, sf_dir).tables.read("raw_sales")
    folder = F.regexp_extract("source_filename", r"(raw/sales/dt=[0-9]{8})/[^/]+$", 1)
    return loads.groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_distinct("load_id").alias("n_loads"))


def _incremental_split(spark, sf_dir):
    layers = _incremental_layers(spark, sf_dir)
    staged = layers.clean().selectExpr("'clean' as outcome", "total_amount").unionAll(
        layers.rejects().selectExpr("reason as outcome", "cast(null as decimal(10,2))"))
    return staged.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"),
                                         F.sum("total_amount").cast("decimal(20,2)").alias("revenue"))


def _rebuild_after_failure(spark, sf_dir):
    """A rebuild that fails, on an amount its column cannot hold: the tables are as before."""
    layers = _written_layers(spark, sf_dir, DOCUMENTED)
    too_large = sales_lines(read_events(spark, sf_dir)).select(
        F.regexp_replace("value", '"total_amount": [0-9.]+', '"total_amount": 100000000').alias("value"),
        "source_filename")
    layers.append_raw(records_from_lines(too_large, INGESTION_TS), "20260102-too-large")
    try:
        layers.rebuild_staging()
        failed = False
    except PySparkException as error:
        failed = "NUMERIC_VALUE_OUT_OF_RANGE" in str(error)
    return layers.reconcile().select(F.lit(failed).alias("failed"), "clean_rows", "reject_rows", "fact_rows")


def _load_counts(spark, sf_dir):
    """The load log of the feed with all kinds of lines; a kind is a file here."""
    layers = SalesLayers(FolderTables(spark, fresh_folder(spark, "log")))
    layers.append_lines(messy_lines(read_events(spark, sf_dir)), "20260101-messy", INGESTION_TS)
    return layers.load_log()


def _bad_lines(spark, sf_dir):
    """The lines of the same feed that are no JSON value, as they came, summed up by file."""
    layers = SalesLayers(FolderTables(spark, fresh_folder(spark, "bad")))
    layers.append_lines(messy_lines(read_events(spark, sf_dir)), "20260101-messy", INGESTION_TS)
    return layers.bad_lines().groupBy("load_id", "source_filename").agg(
        F.count(F.lit(1)).alias("n_lines"), F.min("value").alias("first_line"),
        F.sum(F.length("value")).alias("n_chars"))


def _reconciliation_by_load(spark, sf_dir):
    """Three loads from lines, and one without a log.  The first is then missing from the fact and the second, of the
    same size, is there twice: the totals balance, these two loads do not."""
    layers = SalesLayers(FolderTables(spark, fresh_folder(spark, "by-load")))
    layers.tables.create()
    feed = sales_lines(read_events(spark, sf_dir))
    for load_id in ("20260101-a", "20260101-b"):
        layers.append_lines(feed, load_id, INGESTION_TS)
    layers.append_lines(messy_lines(read_events(spark, sf_dir)), "20260102-c", INGESTION_TS)
    layers.append_raw(raw_sales(spark, sf_dir), "20260103-d")
    layers.rebuild_staging()
    layers.rebuild_fact()
    twice = layers.tables.read_load("fact_sales", "20260101-b")
    aside = fresh_folder(spark, "twice")
    twice.unionAll(twice).write.parquet(aside)
    layers.tables.replace_load("fact_sales", "20260101-b", spark.read.parquet(aside))
    layers.tables.replace_load("fact_sales", "20260101-a", twice.limit(0))
    return layers.reconcile_loads()


def _incremental_fact(spark, sf_dir):
    """Two loads published one by one; the second leaves the first one's files alone."""
    root = fresh_folder(spark, "fact")
    layers = SalesLayers(FolderTables(spark, root))
    layers.tables.create()
    seen = []
    for load_id in _TWO_LOADS[:2]:
        layers.append_raw(raw_sales(spark, sf_dir), load_id)
        layers.stage_pending()
        layers.publish_pending()
        seen.append(files.data_files(spark, f"{root}/analytics/fact_sales/load_day=20260101"))
    return reports.category_revenue(layers.fact()).withColumn("first_load_kept", F.lit(seen[0] == seen[1]))


def _catalog_tables(spark, sf_dir):
    """The layers as catalog tables, read back by their names in SQL."""
    tables = CatalogTables(spark, f"layers_{uuid.uuid4().hex[:8]}_")
    tables.create()
    layers = SalesLayers(tables)
    layers.append_raw(raw_sales(spark, sf_dir), "20260101-first")
    layers.rebuild_staging()
    layers.rebuild_fact()
    named = ("raw.raw_sales", "staging.stg_sales_clean", "staging.stg_sales_rejects", "analytics.fact_sales")
    counted = spark.sql(" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {tables.prefix}{name}" for name in named)).collect()
    for layer in ("raw", "staging", "analytics"):
        spark.sql(f"DROP SCHEMA {tables.prefix}{layer} CASCADE")
    return spark.createDataFrame(counted, "table_name string, n_rows long")


def queries() -> dict[str, Query]:
    per_profile = {
        "clean_count": _clean_count,
        "reject_count": _reject_count,
        "fact_count": _fact_count,
        "reject_reasons": _reject_reasons,
        **{name: partial(_report, report) for name, report in REPORTS.items()},
        "reconciliation": _reconciliation,
        "stg_sales_clean": clean,
        "stg_sales_rejects": _stg_sales_rejects,
        "fact_sales": _fact_sales,
        "report_book": _report_book,
        "rule_flags": _rule_flags,
        "layer_tables": _layer_tables,
        "layer_reports": _layer_reports,
    }
    named: dict[str, Query] = {"raw_count": _raw_count}
    for suffix, profile in (("", DOCUMENTED), ("__literal", LITERAL)):
        for name, build in per_profile.items():
            named[name + suffix] = partial(build, profile=profile)
    named |= {
        "json_access": _json_access,
        "strip_outer_array": _strip_outer_array,
        "tolerant_load": _tolerant_load,
        "safe_timestamps": _safe_timestamps,
        "safe_numbers": _safe_numbers,
        "store_paths": _store_paths,
        "ingest_time": _ingest_time,
        "money_overflow": _money_overflow,
        "jsonl_sink": _jsonl_sink,
        "incremental_load": _incremental_load,
        "incremental_split": _incremental_split,
        "incremental_fact": _incremental_fact,
        "rebuild_after_failure": _rebuild_after_failure,
        "load_counts": _load_counts,
        "bad_lines": _bad_lines,
        "reconciliation_by_load": _reconciliation_by_load,
        "catalog_tables": _catalog_tables,
    }
    return named


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.category_revenue(clean(spark, sf_dir, DOCUMENTED))
