"""RAW, STAGING and ANALYTICS as folders and as catalog tables."""

from __future__ import annotations

import threading
import uuid

import pytest
from conftest import TESTDATA
from helpers import event, raw_rows
from pyspark.sql import functions as F

from salestrata import files
from salestrata.catalog.results import raw_sales
from salestrata.operators import classify_sales, clean_rows, reject_rows, reports
from salestrata.plans import CatalogTables, FolderTables, SalesLayers
from salestrata.plans.layers import LoadsFailed, load_day
from salestrata.schema import CLEAN_COLUMNS, FACT_COLUMNS, RAW_COLUMNS, REJECT_COLUMNS
from salestrata.session import fresh_folder


@pytest.fixture(params=["folders", "catalog"])
def tables(request, spark):
    if request.param == "folders":
        folders = FolderTables(spark, fresh_folder(spark, "tables"))
        folders.create()
        folders.create()
        return folders
    catalog = CatalogTables(spark, f"t{uuid.uuid4().hex[:8]}_")
    catalog.create()
    catalog.create()
    return catalog


def counts(layers):
    row = layers.reconcile().first()
    assert row.balanced
    return row.raw_rows, row.clean_rows, row.reject_rows, row.fact_rows


def counted(layers):
    return tuple(layers.reconcile().first())[:4]


def rebuild(layers):
    layers.rebuild_staging()
    layers.rebuild_fact()
    return counts(layers)


def test_append_and_rebuild(spark, tables):
    layers = SalesLayers(tables)
    layers.append_raw(raw_rows(spark, [event(), event(quantity=0)]))
    assert rebuild(layers) == (2, 1, 1, 1)
    assert rebuild(layers) == (2, 1, 1, 1)
    layers.append_raw(raw_rows(spark, [event(), event(event_id=None)]))
    assert rebuild(layers) == (4, 2, 2, 2)
    assert dict(layers.raw().dtypes) == RAW_COLUMNS
    assert dict(layers.clean().dtypes) == CLEAN_COLUMNS
    assert dict(layers.rejects().dtypes) == REJECT_COLUMNS
    assert layers.fact().columns == list(FACT_COLUMNS)
    reasons = [tuple(r) for r in reports.reject_reasons(layers.rejects()).collect()]
    assert reasons == [("Missing event_id", 1), ("Non-positive quantity", 1)]
    payload = layers.rejects().where("reason = 'Missing event_id'").selectExpr(
        "variant_get(raw, '$.category', 'string')").first()[0]
    assert payload == "home"


def test_tables_are_empty_before_the_first_load(tables):
    assert counts(SalesLayers(tables)) == (0, 0, 0, 0)
    assert rebuild(SalesLayers(tables)) == (0, 0, 0, 0)


def test_written_layers_hold_what_the_frames_hold(spark, tables):
    raw = raw_sales(spark, f"{TESTDATA}/sf0.001")
    layers = SalesLayers(tables)
    layers.append_raw(raw)
    assert rebuild(layers)[0] == 1000

    def payloads(rows):
        return sorted(rows.select("reason", F.to_json("raw"), "source_filename").collect())

    classified = classify_sales(raw)
    assert payloads(layers.rejects()) == payloads(reject_rows(classified))
    assert sorted(map(str, layers.fact().collect())) == sorted(
        map(str, clean_rows(classified).collect()))


def test_same_load_again_replaces_it(spark, tables):
    layers = SalesLayers(tables)
    layers.append_raw(raw_rows(spark, [event()]), "kept")
    layers.append_raw(raw_rows(spark, [event(quantity=0)] * 3), "again")
    layers.append_raw(raw_rows(spark, [event()] * 2), "again")
    assert rebuild(layers) == (3, 3, 0, 3)


def test_staging_load_by_load(spark, tables):
    layers = SalesLayers(tables)
    for load_id, lines in (("a", [event(), event(quantity=0)]), ("b", [event()])):
        layers.append_raw(raw_rows(spark, lines), load_id)
        layers.stage_load(load_id)
    layers.rebuild_fact()
    assert counts(layers) == (3, 2, 1, 2)
    # Now load a has no rejects: its old reject partition must go.
    layers.append_raw(raw_rows(spark, [event()]), "a")
    layers.stage_load("a")
    layers.rebuild_fact()
    assert counts(layers) == (2, 2, 0, 2)


def test_rebuild_drops_what_is_no_longer_there(spark, tables):
    layers = SalesLayers(tables)
    layers.append_raw(raw_rows(spark, [event(event_id=None)]), "a")
    assert rebuild(layers) == (1, 0, 1, 0)
    assert rebuild(SalesLayers(tables, profile="literal")) == (1, 1, 0, 1)


def test_empty_load(spark, tables):
    layers = SalesLayers(tables)
    layers.append_raw(raw_rows(spark, ["{bad"]), "a")
    assert rebuild(layers) == (0, 0, 0, 0)
    assert reports.row_count(layers.fact(), "fact_rows").first().fact_rows == 0
    assert reports.category_revenue(layers.fact()).collect() == []


def test_an_amount_too_large_in_a_reject_does_no_harm(spark, tables):
    layers = SalesLayers(tables)
    layers.append_raw(raw_rows(spark, [event(), event(quantity=0, total_amount=1e12, unit_price=1e12)]))
    assert rebuild(layers) == (2, 1, 1, 1)


def test_overflow_fails_the_rebuild_or_goes_to_rejects(spark, tables):
    layers = SalesLayers(tables)
    layers.append_raw(raw_rows(spark, [event(), event(total_amount=100000000)]))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        layers.rebuild_staging()
    assert counted(layers) == (2, 0, 0, 0)
    rejecting = SalesLayers(tables, on_overflow="reject")
    assert rebuild(rejecting) == (2, 1, 1, 1)
    assert rejecting.rejects().first().reason == "Unknown validation error"


def test_a_rebuild_that_fails_leaves_the_tables_as_they_were(spark, tables):
    layers = SalesLayers(tables)
    layers.append_raw(raw_rows(spark, [event(), event(quantity=0)]), "a")
    assert rebuild(layers) == (2, 1, 1, 1)
    layers.append_raw(raw_rows(spark, [event(total_amount=100000000)]), "b")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        layers.rebuild_staging()
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        layers.stage_load("b")
    assert counted(layers) == (3, 1, 1, 1)


def test_a_load_that_fails_holds_up_no_other(spark, tables):
    layers = SalesLayers(tables)
    for load_id, line in (("20260101-a", event()), ("20260101-b", event(total_amount=100000000)), ("20260102-c", event())):
        layers.append_raw(raw_rows(spark, [line]), load_id)
    with pytest.raises(LoadsFailed, match="20260101-b"):
        layers.stage_pending()
    assert tables.loads("stg_sales") == {"20260101-a", "20260102-c"}
    assert layers.publish_pending() == ["20260101-a", "20260102-c"]
    rejecting = SalesLayers(tables, on_overflow="reject")
    assert rejecting.stage_pending() == ["20260101-b"]
    assert rejecting.stage_pending() == [] == rejecting.publish_pending()
    assert counts(layers) == (3, 2, 1, 2)


def test_publishing_a_load_touches_its_partition_only(spark, tables):
    layers = SalesLayers(tables)
    layers.append_raw(raw_rows(spark, [event(), event(quantity=0)]), "20260101-a")
    layers.append_raw(raw_rows(spark, [event(category="beauty")]), "20260102-b")
    layers.stage_pending()
    layers.publish_load("20260101-a")
    first = set(layers.tables.read("fact_sales").select("_metadata.file_path").distinct().collect())
    layers.publish_load("20260102-b")
    assert first < set(layers.tables.read("fact_sales").select("_metadata.file_path").distinct().collect())
    published = reports.category_revenue(layers.fact()).collect()
    layers.rebuild_fact()
    assert reports.category_revenue(layers.fact()).collect() == published


def test_a_fact_that_lacks_a_row_does_not_balance(spark, tables):
    layers = SalesLayers(tables)
    layers.append_raw(raw_rows(spark, [event(event_id="1"), event(event_id="2")]), "a")
    assert rebuild(layers) == (2, 2, 0, 2)
    lacking = SalesLayers(tables)
    tables.replace_load("fact_sales", "a", layers.clean().where("event_id = '1'"))
    row = lacking.reconcile().first()
    assert (row.clean_rows, row.fact_rows, row.balanced) == (2, 1, False)


def test_the_profile_is_remembered(spark, tables):
    layers = SalesLayers(tables, profile="literal")
    layers.append_raw(raw_rows(spark, [event(event_id=None)]), "a")
    layers.stage_pending()
    assert tables.profile() == "literal"
    assert rebuild(SalesLayers(tables)) == (1, 1, 0, 1)
    layers.append_raw(raw_rows(spark, [event(event_id=None)]), "b")
    with pytest.raises(LoadsFailed, match="profile 'literal'"):
        SalesLayers(tables, profile="documented").stage_pending()
    assert rebuild(SalesLayers(tables, profile="documented")) == (2, 0, 2, 0)
    assert rebuild(SalesLayers(tables)) == (2, 0, 2, 0)


def test_load_log(spark, tables):
    layers = SalesLayers(tables)
    lines = [("a", event()), ("a", "{bad"), ("a", " "), ("b", "[]"), ("b", f"[{event()}, {event()}]"), (None, event())]
    frame = spark.createDataFrame([(v, f) for f, v in lines], "value string, source_filename string")
    layers.append_lines(frame, "20260101-a")
    wanted = [(None, 6, 4, 1, 1), ("a", 3, 1, 1, 1), ("b", 2, 2, 0, 0)]

    def logged(load_id):
        rows = layers.load_log().where(f"load_id = '{load_id}'").collect()
        return sorted((tuple(r)[2:] for r in rows), key=str)
    # a line without a file name is in the whole load's row only, and then that is the only row
    assert logged("20260101-a") == [wanted[0]]
    layers.append_lines(frame.where("source_filename is not null"), "20260101-b")
    assert logged("20260101-b") == sorted([(None, 5, 3, 1, 1), *wanted[1:]], key=str)
    layers.append_lines(frame.limit(0), "20260101-b")
    assert logged("20260101-b") == [(None, 0, 0, 0, 0)]


@pytest.mark.parametrize("load_id", ["0007", "2026-01-01", "1e3", "1.0"])
def test_load_id_is_text_whatever_it_looks_like(spark, tables, load_id):
    layers = SalesLayers(tables)
    layers.append_raw(raw_rows(spark, [event()]), load_id)
    layers.append_raw(raw_rows(spark, [event(quantity=0)]), "other")
    rebuild(layers)
    layers.stage_load(load_id)
    layers.rebuild_fact()
    assert counts(layers) == (2, 1, 1, 1)
    assert tables.read("stg_sales").where("outcome = 'clean'").first().load_id == load_id


def test_load_id_is_checked(spark, tables):
    with pytest.raises(ValueError):
        SalesLayers(tables).append_raw(raw_rows(spark, [event()]), "a/b' OR 1=1")


def test_catalog_names(spark):
    tables = CatalogTables(spark, f"t{uuid.uuid4().hex[:8]}_")
    tables.create()
    layers = SalesLayers(tables)
    layers.append_raw(raw_rows(spark, [event(), event(quantity="two")]))
    rebuild(layers)
    assert spark.table(f"{tables.prefix}raw.raw_sales").count() == 2
    assert spark.table(f"{tables.prefix}staging.stg_sales_clean").columns == list(CLEAN_COLUMNS)
    assert spark.table(f"{tables.prefix}staging.stg_sales_rejects").first().reason == "Invalid quantity"
    assert spark.table(f"{tables.prefix}analytics.fact_sales").count() == 1


def test_the_tables_answer_plain_sql(spark):
    tables = CatalogTables(spark, f"t{uuid.uuid4().hex[:8]}_")
    tables.create()
    layers = SalesLayers(tables)
    layers.append_raw(raw_rows(spark, [
        event(), event(country="BR", total_amount=70), event(payment_method="paypal"),
        event(event_ts="2026-01-09", category="beauty"), event(quantity="two")]))
    rebuild(layers)
    fact = f"{tables.prefix}analytics.fact_sales"
    sales = "count(*) AS total_sales, sum(total_amount) AS total_revenue"
    for key, order, report in (
            ("country", "total_revenue", reports.top_countries),
            ("payment_method", "total_sales", reports.payment_methods),
            ("marketing_channel", "total_revenue", reports.marketing_channels)):
        rows = spark.sql(f"SELECT {key}, {sales} FROM {fact} GROUP BY {key} ORDER BY {order} DESC")
        assert rows.collect() == report(layers.fact()).collect()
    days = spark.sql(f"SELECT cast(event_ts AS date), {sales} FROM {fact} GROUP BY 1 ORDER BY 1")
    assert [tuple(r)[1:] for r in days.collect()] == [
        tuple(r)[1:] for r in reports.daily_revenue(layers.fact()).collect()]


def test_ingest_time_default_of_the_raw_table(spark):
    tables = CatalogTables(spark, f"t{uuid.uuid4().hex[:8]}_")
    tables.create()
    spark.sql(f"INSERT INTO {tables.prefix}raw.raw_sales (source_filename, raw, load_id) "
              f"SELECT 'by hand', parse_json('{event()}'), 'x'")
    row = SalesLayers(tables).raw().select("source_filename", "ingestion_ts").first()
    assert row.source_filename == "by hand" and row.ingestion_ts is not None


def test_loads_and_rebuilds_survive_dynamic_overwrite_mode(spark, tables):
    layers = SalesLayers(tables)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        layers.append_raw(raw_rows(spark, [event(event_id=None)]), "a")
        layers.stage_load("a")
        layers.append_raw(raw_rows(spark, [event()]), "a")
        layers.stage_load("a")
        layers.rebuild_fact()
        assert counts(layers) == (1, 1, 0, 1)
        layers.append_raw(raw_rows(spark, [event(quantity=0)]), "a")
        assert rebuild(layers) == (1, 0, 1, 0)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_a_day_becomes_one_load(spark, tables, monkeypatch):
    layers = SalesLayers(tables)

    def lines(*texts):
        return spark.createDataFrame([(t, "f") for t in texts], "value string, source_filename string")
    for load_id, text in (("20260101-a", event(event_id="1")), ("20260101-b", event(quantity=0)), ("20260102-c", event(event_id="3"))):
        layers.append_lines(lines(text), load_id)
    with pytest.raises(ValueError, match="20260101-a"):
        tables.compact_day("20260101")
    layers.stage_pending()
    layers.publish_pending()
    before = counts(layers)
    # cut short when the first table is in place: the rest is put there by the next call
    moved = files.move

    def move_once(*args):
        moved(*args)
        raise OSError("lost")
    monkeypatch.setattr(files, "move", move_once)
    with pytest.raises(OSError, match="lost"):
        tables.compact_day("20260101")
    monkeypatch.setattr(files, "move", moved)
    tables.recover()
    assert counts(layers) == before == (3, 2, 1, 2)
    assert by_load(layers) == {"20260101-compacted": (2, 1, 1, 1, 2, True), "20260102-c": (1, 1, 0, 1, 1, True)}
    for table in ("raw_sales", "stg_sales", "fact_sales"):
        assert tables.loads(table) == {"20260101-compacted", "20260102-c"}
    assert layers.stage_pending() == [] == layers.publish_pending()
    # a batch that is run again after that adds nothing, a late load does
    layers.append_lines(lines(event(event_id="1")), "20260101-a")
    layers.append_lines(lines(event(event_id="4")), "20260101-late")
    layers.stage_pending()
    tables.compact_day("20260101")
    assert tables.loads("raw_sales") == {"20260101-compacted", "20260102-c"}
    layers.rebuild_fact()
    assert counts(layers) == (4, 3, 1, 3)
    assert sorted(r.event_id for r in layers.fact().collect()) == ["1", "3", "4"]


@pytest.mark.parametrize("call", range(1, 12))
def test_a_compaction_cut_short_anywhere_is_taken_to_its_end(spark, monkeypatch, call):
    tables = CatalogTables(spark, f"t{uuid.uuid4().hex[:8]}_")
    tables.create()
    layers = SalesLayers(tables)
    for load_id, text in (("20260101-a", event(event_id="1")), ("20260101-b", event(quantity=0))):
        layers.append_raw(raw_rows(spark, [text]), load_id)
    layers.stage_pending()
    layers.publish_pending()
    done = []

    def cut_short(step):
        def take(*args, **kwargs):
            done.append(step)
            if len(done) == call:
                raise OSError("lost")
            return step(*args, **kwargs)
        return take
    with monkeypatch.context() as patched:
        for owner, name in ((files, "write_text"), (files, "move"), (files, "remove"), (CatalogTables, "_drop_day"), (CatalogTables, "_adopt")):
            patched.setattr(owner, name, cut_short(getattr(owner, name)))
        with pytest.raises(OSError, match="lost"):
            tables.compact_day("20260101")
    tables.recover()
    assert counts(layers) == (2, 1, 1, 1)
    tables.compact_day("20260101")
    assert tables.loads("raw_sales") == {"20260101-compacted"}
    assert counts(layers) == (2, 1, 1, 1)


def test_load_log_has_every_file_of_a_large_load(spark, tables):
    layers = SalesLayers(tables)
    text = F.expr("if(id % 1000 = 7, '{bad', '{}')").alias("value")
    layers.append_lines(spark.range(12_000).select(text, F.format_string("f%05d", "id").alias("source_filename")), "20260101-many")
    log = layers.load_log()
    assert log.where("source_filename is not null and n_lines = 1").count() == 12_000
    bad = [r.source_filename for r in log.where("source_filename is not null and n_bad = 1").collect()]
    assert sorted(bad) == [f"f{i:05d}" for i in range(7, 12_000, 1000)]
    assert [(r.n_lines, r.n_bad) for r in log.where("source_filename is null").collect()] == [(12_000, 12)]


@pytest.mark.parametrize("load_id,day", [
    ("20260105-a", "20260105"), ("2026-01-05-a", "20260105"), ("2026-13-05-a", "undated"), ("2026-01-32-a", "undated"),
    ("2026-01-05", "undated"), ("2026-1-5-a", "undated"), ("backfill-a", "undated"), ("20260105_late-a", "undated")])
def test_the_day_of_a_load(load_id, day):
    assert load_day(load_id) == day


def test_days_in_iso_form_are_pruned_and_compacted_by_day(spark):
    tables = FolderTables(spark, fresh_folder(spark, "iso"))
    tables.create()
    layers = SalesLayers(tables)
    for load_id in ("20260105-a", "2026-01-05-b", "backfill-c"):
        layers.append_raw(raw_rows(spark, [event()]), load_id)
    layers.stage_pending()
    layers.publish_pending()
    assert tables.read("raw_sales").where("load_day = '20260105'").count() == 2
    tables.compact_day("20260105")
    assert tables.loads("fact_sales") == {"20260105-compacted", "backfill-c"}
    assert counts(layers) == (3, 3, 0, 3)


def test_two_hundred_pending_loads_take_a_bounded_number_of_jobs(spark, tables):
    layers = SalesLayers(tables)
    poisoned = {"20260101-017", "20260101-140"}
    values = F.concat(F.lit("20260101-"), F.format_string("%03d", F.col("id")))
    feed = spark.range(200).withColumn("load_id", values)
    text = F.when(F.col("load_id").isin(sorted(poisoned)), F.lit(event(total_amount=100000000))).otherwise(F.lit(event()))
    rows = feed.select(F.localtimestamp().alias("ingestion_ts"), F.lit("f").alias("source_filename"),
                       F.parse_json(text).alias("raw"), F.lit("20260101").alias("load_day"), "load_id")
    tables.add_loads("raw_sales", rows)
    assert len(tables.loads("raw_sales")) == 200

    def jobs(step):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, group)
        try:
            step()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    def stage():
        with pytest.raises(LoadsFailed) as raised:
            layers.stage_pending()
        assert set(raised.value.failed) == poisoned and len(raised.value.done) == 198
    # halvings down to two loads: 2 * 2 * 8 writes at most, each a handful of jobs
    assert jobs(stage) < 150
    assert tables.loads("stg_sales") == tables.loads("raw_sales") - poisoned
    assert jobs(lambda: layers.publish_pending()) < 12
    assert counted(layers) == (200, 198, 0, 198)
    rejecting = SalesLayers(tables, on_overflow="reject")
    assert set(rejecting.stage_pending()) == poisoned
    assert counted(layers) == (200, 198, 2, 198)


def test_the_lines_of_a_load_are_read_once(spark, tables):
    read = spark.sparkContext.accumulator(0)

    def count(value):
        read.add(1)
        return value
    seen = F.udf(count, "string").asNondeterministic()
    lines = spark.createDataFrame([(event(), "a"), ("{bad", "a"), (" ", "b"), (f"[{event()}, 7]", "b"), ("[]", "c")],
                                  "value string, source_filename string").select(seen("value").alias("value"), "source_filename")
    layers = SalesLayers(tables)
    layers.append_lines(lines, "20260101-a")
    assert read.value == 5
    assert sorted(tuple(r)[2:] for r in layers.load_log().where("source_filename is not null").collect()) == [
        ("a", 2, 1, 0, 1), ("b", 2, 2, 1, 0), ("c", 1, 0, 0, 0)]
    assert [tuple(r) for r in layers.bad_lines().collect()] == [("20260101", "20260101-a", "a", "{bad")]
    assert layers.raw().count() == 3
    layers.append_lines(spark.createDataFrame([(event(), "a")], "value string, source_filename string"), "20260101-a")
    assert layers.bad_lines().count() == 0 and layers.raw().count() == 1


def by_load(layers):
    return {r.load_id: tuple(r)[2:] for r in layers.reconcile_loads().collect()}


def test_reconciliation_by_load(spark, tables):
    layers = SalesLayers(tables)
    assert by_load(layers) == {}
    lines = spark.createDataFrame([(event(), "a"), (event(quantity=0), "a"), ("{bad", "a")], "value string, source_filename string")
    for load_id in ("20260101-a", "20260101-b"):
        layers.append_lines(lines, load_id)
    layers.append_raw(raw_rows(spark, [event()]), "20260102-c")
    layers.append_lines(lines.where("value = '{bad'"), "20260103-none")
    layers.stage_pending()
    layers.publish_pending()
    good = (2, 1, 1, 1, 2, True)
    assert by_load(layers) == {"20260101-a": good, "20260101-b": good, "20260102-c": (1, 1, 0, 1, None, True),
                               "20260103-none": (0, 0, 0, 0, 0, True)}
    twice = tables.read_load("fact_sales", "20260101-b")
    rows = spark.createDataFrame(twice.collect() * 2, twice.schema)
    tables.replace_load("fact_sales", "20260101-b", rows)
    tables.replace_load("fact_sales", "20260101-a", twice.limit(0))
    assert layers.reconcile().first().balanced  # the totals can't tell
    found = by_load(layers)
    assert found["20260101-a"] == (2, 1, 1, 0, 2, False) and found["20260101-b"] == (2, 1, 1, 2, 2, False)
    assert found["20260102-c"][-1]
    tables.replace_load("raw_sales", "20260102-d", layers.raw().limit(1))  # rows that RAW has and STAGING has not
    assert by_load(layers)["20260102-d"][-1] is False


def test_a_reader_during_rebuilds_never_sees_fewer_rows(spark):
    tables = FolderTables(spark, fresh_folder(spark, "readers"))
    tables.create()
    layers = SalesLayers(tables)
    for i in range(4):
        layers.append_raw(raw_rows(spark, [event(), event(quantity=0)]), f"2026010{i + 1}-a")
    assert rebuild(layers) == (8, 4, 4, 4)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append((layers.fact().count(), layers.rejects().count()))
            except Exception as error:  # a file that is gone counts as lost rows
                seen.append(str(error))
    readers = [threading.Thread(target=read) for _ in range(2)]
    for reader in readers:
        reader.start()
    try:
        for _ in range(20):
            layers.rebuild_staging()
            layers.rebuild_fact()
    finally:
        stop.set()
        for reader in readers:
            reader.join()
    assert len(seen) > 20 and set(seen) == {(4, 4)}
    for table in ("stg_sales", "fact_sales"):  # this generation and the one before
        assert len([n for n in files.children(spark, f"{tables.root}/_generations/{table}") if not n.endswith(".ready")]) == 2


def test_loads_go_into_the_generation_that_is_read(spark):
    tables = FolderTables(spark, fresh_folder(spark, "generations"))
    tables.create()
    layers = SalesLayers(tables)
    assert tables.path("fact_sales") == f"{tables.root}/analytics/fact_sales"
    layers.append_raw(raw_rows(spark, [event()]), "20260101-a")
    assert rebuild(layers) == (1, 1, 0, 1) == rebuild(layers)
    layers.append_raw(raw_rows(spark, [event()]), "20260102-b")
    layers.stage_pending()
    layers.publish_pending()
    assert counts(layers) == (2, 2, 0, 2)
    tables.compact_day("20260101")
    assert counts(layers) == (2, 2, 0, 2)
    # a rebuild that failed left an unfinished generation: it is not read, and the next one replaces it
    unfinished = tables._generation("fact_sales", tables._current("fact_sales") + 1)
    layers.fact().limit(1).withColumn("load_day", F.lit("x")).write.partitionBy("load_day").parquet(unfinished)
    assert counts(layers) == (2, 2, 0, 2)
    assert rebuild(layers) == (2, 2, 0, 2) == rebuild(SalesLayers(FolderTables(spark, tables.root)))
