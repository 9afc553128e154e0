"""One fault at a time, in both profiles, from memory and through Parquet."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from helpers import ABSENT, event, raw_rows

from salestrata.operators import classify_sales, clean_rows
from salestrata.session import fresh_folder

D = Decimal
CLEAN = None

# line, reason (documented), reason (literal), checked clean values, literal ones
GOLDEN = [
    (event(), CLEAN, CLEAN, {"total_amount": D("25.00"), "unit_price": D("12.50")},
     {"total_amount": D("25.00"), "unit_price": D("13.00")}),
    (event(event_id=ABSENT), "Missing event_id", "Missing event_id", {}, {}),
    (event(event_id=None), "Missing event_id", CLEAN, {}, {"event_id": None}),
    (event(event_id=""), CLEAN, CLEAN, {"event_id": ""}, {"event_id": ""}),
    (event(event_ts=ABSENT), "Invalid event_ts", "Invalid event_ts", {}, {}),
    (event(event_ts="not-a-timestamp"), "Invalid event_ts", "Invalid event_ts", {}, {}),
    (event(event_ts="2026-02-30"), "Invalid event_ts", "Invalid event_ts", {}, {}),
    (event(event_ts="now"), "Invalid event_ts", "Invalid event_ts", {}, {}),
    (event(event_ts="2026"), "Invalid event_ts", "Invalid event_ts", {}, {}),
    (event(event_ts="1700000000"), "Invalid event_ts", "Invalid event_ts", {}, {}),
    (event(event_ts=1700000000), "Invalid event_ts", "Invalid event_ts", {}, {}),
    (event(quantity="two"), "Invalid quantity", "Invalid quantity", {}, {}),
    (event(quantity=None), "Invalid quantity", "Invalid quantity", {}, {}),
    (event(quantity=ABSENT), "Invalid quantity", "Invalid quantity", {}, {}),
    (event(quantity=True), "Invalid quantity", "Invalid quantity", {}, {}),
    (event(quantity={"n": 1}), "Invalid quantity", "Invalid quantity", {}, {}),
    (event(quantity=0), "Non-positive quantity", "Non-positive quantity", {}, {}),
    (event(quantity=-1), "Non-positive quantity", "Non-positive quantity", {}, {}),
    (event(quantity=0.4), "Non-positive quantity", "Non-positive quantity", {}, {}),
    (event(total_amount="NaN"), "Invalid total_amount", "Invalid total_amount", {}, {}),
    (event(total_amount="Infinity"), "Invalid total_amount", "Invalid total_amount", {}, {}),
    (event(total_amount=None), "Invalid total_amount", "Invalid total_amount", {}, {}),
    (event(total_amount=ABSENT), "Invalid total_amount", "Invalid total_amount", {}, {}),
    (event(total_amount="1,000"), "Invalid total_amount", "Invalid total_amount", {}, {}),
    (event(total_amount=-1.00), "Negative total_amount", "Negative total_amount", {}, {}),
    (event(total_amount=-0.4), "Negative total_amount", CLEAN, {}, {"total_amount": D("0.00")}),
    (event(event_id=ABSENT, quantity="two", total_amount=-1), "Missing event_id",
     "Missing event_id", {}, {}),
    (event(quantity=0, total_amount=None), "Non-positive quantity", "Non-positive quantity",
     {}, {}),
    (event(quantity=0, total_amount=100000000, unit_price=1e12), "Non-positive quantity",
     "Non-positive quantity", {}, {}),
    (event(event_id=ABSENT, Event_ID="E1"), "Missing event_id", "Missing event_id", {}, {}),
    ("5", "Missing event_id", "Missing event_id", {}, {}),
    ("null", "Missing event_id", "Missing event_id", {}, {}),
    ('"text"', "Missing event_id", "Missing event_id", {}, {}),
]
SAME = [
    (event(event_ts="2026-01-02T23:30:00-05:00"), {"event_ts": datetime(2026, 1, 2, 23, 30)}),
    (event(event_ts="2026-01-02"), {"event_ts": datetime(2026, 1, 2)}),
    (event(event_ts=" 2026-01-02 10:00:00 "), {"event_ts": datetime(2026, 1, 2, 10)}),
    (event(quantity=0.5), {"quantity": D(1)}),
    (event(quantity=2.5), {"quantity": D(3)}),
    (event(quantity="2"), {"quantity": D(2)}),
    (event(quantity="1e3"), {"quantity": D(1000)}),
    (event(total_amount=0), {"total_amount": D("0.00")}),
    (event(unit_price="x", customer_id="abc"), {"unit_price": None, "customer_id": None}),
    (event(customer_id=9007199254740993, product_id="1" * 38),
     {"customer_id": D(9007199254740993), "product_id": D("1" * 38)}),
    (event(category=ABSENT), {"category": None}),
    (event(country="Perú", category="日本"), {"country": "Perú", "category": "日本"}),
    (event(order_id=5, session_id=True), {"order_id": "5", "session_id": "true"}),
    (event(extra={"kept": "in raw"}), {"event_id": "e-1"}),
]
GOLDEN += [(line, CLEAN, CLEAN, values, values) for line, values in SAME]
GOLDEN += [(event(total_amount=12.50), CLEAN, CLEAN, {"total_amount": D("12.50")},
            {"total_amount": D("13.00")})]


@pytest.fixture(scope="module", params=["in memory", "parquet"])
def raw(request, spark):
    rows = raw_rows(spark, [line for line, *_ in GOLDEN])
    if request.param == "in memory":
        return rows
    folder = fresh_folder(spark, "golden")
    rows.write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.mark.parametrize("profile,reason_at,values_at", [("documented", 1, 3), ("literal", 2, 4)])
def test_golden_rows(raw, profile, reason_at, values_at):
    classified = classify_sales(raw, profile)
    reasons = {r.source_filename: r.reason
               for r in classified.select("source_filename", "reason").collect()}
    cleaned = {r.source_filename: r for r in clean_rows(classified).collect()}
    assert len(reasons) == len(GOLDEN)
    for number, golden in enumerate(GOLDEN):
        line, reason, values = golden[0], golden[reason_at], golden[values_at]
        assert reasons[str(number)] == reason, line
        assert (str(number) in cleaned) == (reason is CLEAN), line
        for name, value in values.items():
            assert cleaned[str(number)][name] == value, (line, name)


def test_same_event_twice_is_two_clean_rows(spark):
    assert clean_rows(classify_sales(raw_rows(spark, [event(), event()]))).count() == 2


@pytest.mark.parametrize("changes", [{"total_amount": 100000000}, {"unit_price": 99999999.999}])
def test_overflow_fails_or_is_rejected(spark, changes):
    raw = raw_rows(spark, [event(), event(**changes)])
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        clean_rows(classify_sales(raw)).collect()
    classified = classify_sales(raw, on_overflow="reject")
    assert sorted(str(r.reason) for r in classified.collect()) == ["None", "Unknown validation error"]
    assert clean_rows(classified).count() == 1


def test_overflow_needs_ansi(spark):
    classified = classify_sales(raw_rows(spark, [event()]))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            clean_rows(classified)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_column_types(spark):
    from salestrata.schema import CLEAN_COLUMNS
    clean = clean_rows(classify_sales(raw_rows(spark, [event()])))
    assert dict(clean.dtypes) == CLEAN_COLUMNS
    assert clean.columns == list(CLEAN_COLUMNS)
