"""Operators on DataFrames: record splitting, extraction, quality rules, reports."""

from salestrata.operators.quality import Rule, classify, rule_flags, sales_rules, split
from salestrata.operators.reconcile import reconcile_by_load, reconcile_layers
from salestrata.operators.records import parse_text, strip_outer_array
from salestrata.operators.staging import (
    classify_sales,
    clean_rows,
    extract_event,
    reject_rows,
    staged_rows,
)

__all__ = [
    "Rule",
    "classify",
    "classify_sales",
    "clean_rows",
    "extract_event",
    "parse_text",
    "reconcile_by_load",
    "reconcile_layers",
    "reject_rows",
    "rule_flags",
    "sales_rules",
    "split",
    "staged_rows",
    "strip_outer_array",
]
