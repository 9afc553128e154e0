"""Physical plans: what is scanned, what is shuffled, what is done once."""

from __future__ import annotations

import pytest
from conftest import TESTDATA
from helpers import event, explained, raw_rows

from salestrata import catalog
from salestrata.catalog.results import raw_sales
from salestrata.operators import classify_sales, clean_rows, reject_rows, reports, staged_rows
from salestrata.plans import FolderTables, SalesLayers, report_book
from salestrata.session import fresh_folder
from salestrata.sources import ingest_jsonl
from salestrata.sources.jsonl import records_from_lines


@pytest.fixture(scope="module")
def layers(spark):
    built = SalesLayers(FolderTables(spark, fresh_folder(spark, "plans")))
    built.append_raw(raw_rows(spark, [event(), event(quantity=0)]))
    built.rebuild_staging()
    built.rebuild_fact()
    return built


def test_ingest_and_staging_do_not_shuffle(spark, layers, tmp_path):
    (tmp_path / "a.jsonl").write_text(event() + "\n")
    classified = classify_sales(layers.raw())
    for rows in (ingest_jsonl(spark, str(tmp_path)), clean_rows(classified),
                 reject_rows(classified), staged_rows(classified)):
        assert "Exchange" not in explained(rows)


def test_text_is_parsed_once(spark):
    lines = spark.createDataFrame([(event(), "f")], "value string, source_filename string")
    plan = explained(clean_rows(classify_sales(records_from_lines(lines))))
    # One parser for top-level arrays and one for all other text; a text takes one.
    assert plan.count("from_json(") == 2


def test_only_the_needed_paths_of_raw_are_read(layers):
    plan = explained(clean_rows(classify_sales(layers.raw())).groupBy("category").count())
    # event_id, event_ts, quantity, total_amount, category: no whole record.
    assert "ReadSchema: struct<raw:struct<0:string,1:string,2:string,3:string,4:string>>" in plan


def test_reports_read_their_columns_and_combine_before_the_shuffle(layers):
    plan = explained(reports.category_revenue(layers.fact()))
    assert ("ReadSchema: struct<category:string,quantity:decimal(38,0),total_amount:decimal(10,2)>"
            in plan)
    assert "partial_sum" in plan and "hashpartitioning(category" in plan
    assert "ReadSchema: struct<>" in explained(reports.row_count(layers.fact(), "n"))


def test_top_countries_sort_no_more_than_needed(layers):
    plan = explained(reports.top_countries(layers.fact()))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_sides_of_the_split_prune_partitions(layers):
    plan = explained(reports.reject_reasons(layers.rejects()))
    assert "(outcome#" in plan and "ReadSchema: struct<reason:string>" in plan


def test_report_book_scans_once(spark, layers):
    plan = explained(report_book(spark, layers.fact()))
    assert plan.count("Scan parquet") == 2  # once in the tree, once in its details
    assert plan.count("Expand") == 2


@pytest.mark.parametrize("name", catalog.queries())
def test_no_rows_are_dealt_round_robin(spark, name):
    plan = explained(catalog.queries()[name](spark, f"{TESTDATA}/sf0.001"))
    assert "RoundRobinPartitioning" not in plan


def test_no_python_in_any_plan(spark):
    plan = explained(reports.category_revenue(clean_rows(classify_sales(
        raw_sales(spark, f"{TESTDATA}/sf0.001")))))
    assert "Python" not in plan and "BatchEval" not in plan
