"""Ordered quality rules: the first broken rule names the reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestrata.profiles import Profile, resolve_profile
from salestrata.schema import MONEY_TYPE

# The reject reasons, in the order the rules apply.
MISSING_EVENT_ID = "Missing event_id"
INVALID_EVENT_TS = "Invalid event_ts"
INVALID_QUANTITY = "Invalid quantity"
NON_POSITIVE_QUANTITY = "Non-positive quantity"
INVALID_TOTAL = "Invalid total_amount"
NEGATIVE_TOTAL = "Negative total_amount"
UNKNOWN_ERROR = "Unknown validation error"


@dataclass(frozen=True)
class Rule:
    """``broken`` is a SQL predicate; NULL counts as not broken."""

    reason: str
    broken: str


def sales_rules(profile: str | Profile = "documented", on_overflow: str = "fail") -> list[Rule]:
    """The six sales rules; ``on_overflow='reject'`` adds amounts that do not fit."""
    if on_overflow not in ("fail", "reject"):
        raise ValueError(f"on_overflow must be 'fail' or 'reject', not {on_overflow!r}")
    no_id = ("event_id IS NULL" if resolve_profile(profile).null_id_is_missing
             else "variant_get(raw, '$.event_id') IS NULL")
    rules = [
        Rule(MISSING_EVENT_ID, no_id),
        Rule(INVALID_EVENT_TS, "event_ts IS NULL"),
        Rule(INVALID_QUANTITY, "quantity IS NULL"),
        Rule(NON_POSITIVE_QUANTITY, "quantity <= 0"),
        Rule(INVALID_TOTAL, "total_amount IS NULL"),
        Rule(NEGATIVE_TOTAL, "total_amount < 0"),
    ]
    if on_overflow == "reject":
        rules += [
            Rule(UNKNOWN_ERROR, f"{money} IS NOT NULL AND try_cast({money} AS {MONEY_TYPE}) IS NULL")
            for money in ("total_amount", "unit_price")
        ]
    return rules


def first_broken(rules: Sequence[Rule]) -> Column:
    if not rules:
        return F.lit(None).cast("string")
    reason = F
    for rule in rules:
        reason = reason.when(F.expr(rule.broken), F.lit(rule.reason))
    return reason


def classify(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``reason``; NULL means the row keeps every rule."""
    return rows.withColumn("reason", first_broken(rules))


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, rejects): every row is in exactly one of the two."""
    return (classified.where(F.col("reason").isNull()),
            classified.where(F.col("reason").isNotNull()))


def rule_flags(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """How many rows break each rule taken on its own, one row per rule."""
    counts = rows.agg(*[F.count_if(F.expr(rule.broken)).alias(f"r{i}")
                        for i, rule in enumerate(rules)])
    pairs = F.array(*[F.struct(F.lit(rule.reason).alias("reason"), F.col(f"r{i}").alias("n_broken"))
                      for i, rule in enumerate(rules)])
    return counts.select(F.inline(pairs))
