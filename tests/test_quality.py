"""The split as an operator: exact partition, rule order, independence of layout."""

from __future__ import annotations

import json

import pytest
from conftest import TESTDATA
from helpers import ABSENT, VALID, event, raw_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from salestrata.operators import (
    Rule,
    classify,
    classify_sales,
    clean_rows,
    extract_event,
    reconcile_layers,
    reject_rows,
    rule_flags,
    sales_rules,
    split,
)
from salestrata.profiles import resolve_profile
from salestrata.catalog.events_feed import read_events, sales_lines
from salestrata.sources.jsonl import records_from_lines

SF = f"{TESTDATA}/sf0.01"
REASONS = {rule.reason for rule in sales_rules()}


def test_first_broken_rule_names_the_reason(spark):
    rows = spark.createDataFrame([(1,), (5,), (None,)], "n int")
    rules = [Rule("small", "n < 3"), Rule("isn't even", "n % 2 = 1")]
    reasons = {r.n: r.reason for r in classify(rows, rules).collect()}
    assert reasons == {1: "small", 5: "isn't even", None: None}
    clean, rejects = split(classify(rows, rules))
    assert (clean.count(), rejects.count()) == (1, 2)
    assert classify(rows, []).where("reason IS NULL").count() == 3


def test_unknown_settings_are_refused():
    with pytest.raises(ValueError):
        resolve_profile("other")
    with pytest.raises(ValueError):
        sales_rules(on_overflow="ignore")


def test_rule_flags_count_each_rule_alone(spark):
    raw = raw_rows(spark, [event(), event(event_id=ABSENT, quantity=0), event(quantity=0)])
    flags = {r.reason: r.n_broken for r in rule_flags(extract_event(raw), sales_rules()).collect()}
    assert flags["Missing event_id"] == 1
    assert flags["Non-positive quantity"] == 2
    assert flags["Negative total_amount"] == 0


_values = st.one_of(
    st.none(), st.booleans(), st.integers(-3, 3), st.floats(-2, 2, allow_nan=False),
    st.sampled_from(["two", "NaN", "", " 4 ", "1e2", "-0.4", "2026-01-02", "now", "2026-13-01"]),
    st.just([1]), st.just({"a": 1}), st.just(ABSENT))
_lines = st.lists(
    st.fixed_dictionaries({k: _values for k in ("event_id", "event_ts", "quantity", "total_amount")}),
    min_size=1, max_size=60)


@settings(max_examples=8, deadline=None)
@given(changes=_lines, profile=st.sampled_from(["documented", "literal"]))
def test_every_row_is_on_exactly_one_side(spark, changes, profile):
    texts = [event(**c) for c in changes] + [json.dumps(VALID)]
    classified = classify_sales(raw_rows(spark, texts), profile)
    clean = {r.source_filename for r in clean_rows(classified).collect()}
    rejects = {r.source_filename: r.reason for r in reject_rows(classified).collect()}
    assert clean | set(rejects) == {str(i) for i in range(len(texts))}
    assert not clean & set(rejects)
    assert set(rejects.values()) <= REASONS
    sides = clean_rows(classified), reject_rows(classified)
    counts = reconcile_layers(classified, *sides, sides[0]).first()
    assert counts.balanced and counts.raw_rows == len(texts)


def _lines_of(spark, partitions):
    return sales_lines(read_events(spark, SF)).repartition(partitions)


def test_result_does_not_depend_on_the_partitions(spark):
    def reasons(partitions):
        raw = records_from_lines(_lines_of(spark, partitions))
        return sorted(map(str, classify_sales(raw).groupBy("reason").count().collect()))
    assert reasons(1) == reasons(13)


def test_profiles_differ_by_the_null_ids_only(spark):
    raw = records_from_lines(_lines_of(spark, 4), "2026-01-01")
    sides = {p: {r.order_id for r in clean_rows(classify_sales(raw, p)).select("order_id").collect()}
             for p in ("documented", "literal")}
    assert sides["documented"] < sides["literal"]
    added = sides["literal"] - sides["documented"]
    null_ids = classify_sales(raw).where(
        "variant_get(raw, '$.event_id') IS NOT NULL AND event_id IS NULL")
    assert added == {r.order_id for r in null_ids.select("order_id").collect()}
    assert len(added) == 63
