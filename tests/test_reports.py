"""Reports: ordering, null keys, exact money, days without a session zone."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import TESTDATA
from helpers import ABSENT, as_tuples, event, raw_rows

from salestrata.catalog import queries
from salestrata.operators import classify_sales, clean_rows, reports
from salestrata.plans import report_book

D = Decimal


def fact(spark, lines):
    return clean_rows(classify_sales(raw_rows(spark, lines)))


def test_day_is_a_zone_free_midnight(spark):
    rows = reports.daily_summary(fact(spark, [
        event(event_ts="2026-01-02T23:59:59.999999+00:00"),
        event(event_ts="2026-01-03T00:00:00+00:00"),
        event(event_ts="2026-01-02T00:30:00-11:00")]))
    assert dict(rows.dtypes) == {"day": "timestamp_ntz", "events": "bigint", "units": "bigint",
                                 "revenue": "decimal(20,2)"}
    assert as_tuples(rows) == [(datetime(2026, 1, 2), 2, 4, D("50.00")),
                               (datetime(2026, 1, 3), 1, 2, D("25.00"))]


@pytest.mark.parametrize("name", ["daily_summary", "q1_daily_revenue", "fact_sales",
                                  "safe_timestamps", "jsonl_sink"])
def test_results_do_not_depend_on_the_session_zone(spark, zone, name):
    results = []
    for zone_name in ("UTC", "America/New_York", "Asia/Kolkata"):
        zone(zone_name)
        rows = queries()[name](spark, f"{TESTDATA}/sf0.001")
        results.append(sorted(map(str, rows.collect())))
    assert results[0] == results[1] == results[2]


def test_time_inside_a_clock_change_is_kept(spark, zone):
    zone("America/New_York")
    rows = fact(spark, [event(event_ts="2026-03-08T02:30:00+00:00")])
    assert rows.first().event_ts == datetime(2026, 3, 8, 2, 30)
    assert reports.daily_revenue(rows).first().day == datetime(2026, 3, 8)


def test_cents_add_up_exactly(spark):
    rows = fact(spark, [event(total_amount="0.10", quantity=1)] * 30
                + [event(total_amount="99999999.99", quantity=1)] * 3)
    assert as_tuples(reports.category_revenue(rows)) == [("home", 33, 33, D("300000002.97"))]


def test_ties_go_by_key_and_null_is_a_group(spark):
    rows = fact(spark, [event(category=c) for c in ("b", "a", ABSENT, None, "c")]
                + [event(category="z", total_amount=1)])
    assert [r.category for r in reports.category_revenue(rows).collect()] == [
        None, "a", "b", "c", "z"]


def test_ten_countries_at_most_and_the_tenth_is_fixed(spark):
    rows = fact(spark, [event(country=f"C{i:02d}") for i in range(14)]
                + [event(country="top"), event(country="top")])
    top = reports.top_countries(rows).collect()
    assert [r.country for r in top] == ["top"] + [f"C{i:02d}" for i in range(9)]


def test_report_book_holds_all_reports(spark):
    lines = [event(category=ABSENT), event(country=None), event(payment_method="paypal"),
             event(event_ts="2026-01-05"), event(marketing_channel="social", quantity=5)]
    rows = fact(spark, lines)
    book = {}
    for r in report_book(spark, rows).collect():
        book.setdefault(r.report, {})[r.key] = (r.total_sales, r.total_units, r.total_revenue)
    assert set(book) == {"daily", "category", "payment_method", "country", "marketing_channel"}
    assert book["category"] == {r.category: (r.total_sales, r.total_units, r.total_revenue)
                                for r in reports.category_revenue(rows).collect()}
    assert book["daily"] == {"2026-01-02": (4, 11, D("100.00")), "2026-01-05": (1, 2, D("25.00"))}
    for report, single in (("payment_method", reports.payment_methods),
                           ("country", reports.top_countries),
                           ("marketing_channel", reports.marketing_channels)):
        assert {k: (v[0], v[2]) for k, v in book[report].items()} == {
            r[0]: (r.total_sales, r.total_revenue) for r in single(rows).collect()}
    assert sum(v[0] for v in book["country"].values()) == 5


def test_units_beyond_a_bigint_fail_instead_of_wrapping(spark):
    rows = fact(spark, [event(quantity=9223372036854775807), event(quantity=1)])
    with pytest.raises(Exception, match="OVERFLOW|OUT_OF_RANGE"):
        reports.category_revenue(rows).collect()
