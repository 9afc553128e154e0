"""RAW records to typed columns, and the clean and rejected side of the split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestrata.functions import json_text, safe_number, safe_timestamp
from salestrata.operators.quality import classify, sales_rules, split
from salestrata.profiles import Profile, resolve_profile
from salestrata.schema import (
    CLEAN_COLUMNS,
    EVENT_COLUMNS,
    LINEAGE_COLUMNS,
    MONEY_COLUMNS,
    MONEY_TYPE,
    REJECT_COLUMNS,
    STAGED_COLUMNS,
)


def _typed(key: str, profile: Profile) -> Column:
    text = json_text("raw", key)
    if EVENT_COLUMNS[key] == "timestamp_ntz":
        return safe_timestamp(text)
    if EVENT_COLUMNS[key] == MONEY_TYPE:
        return safe_number(text, profile.money_scale)
    if EVENT_COLUMNS[key].startswith("decimal"):
        return safe_number(text)
    return text


def extract_event(raw: DataFrame, profile: str | Profile = "documented",
                  keep: Sequence[str] = ()) -> DataFrame:
    """The fifteen keys as typed columns next to ``raw``, its lineage and ``keep``.

    Money is still in the wide type here: the rules look at the parsed number,
    and only rows that keep the rules are narrowed.
    """
    profile = resolve_profile(profile)
    return raw.select("raw", *[_typed(key, profile).alias(key) for key in EVENT_COLUMNS],
                      *LINEAGE_COLUMNS, *keep)


def classify_sales(raw: DataFrame, profile: str | Profile = "documented",
                   on_overflow: str = "fail", keep: Sequence[str] = ()) -> DataFrame:
    return classify(extract_event(raw, profile, keep), sales_rules(profile, on_overflow))


def _require_ansi(rows: DataFrame) -> None:
    # Without it a cast that overflows gives NULL, and the amount is lost.
    if rows.sparkSession.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("spark.sql.ansi.enabled must be on: amounts must not overflow to NULL")


def _narrowed(name: str) -> Column:
    return F.col(name).cast(MONEY_TYPE) if name in MONEY_COLUMNS else F.col(name)


def clean_rows(classified: DataFrame) -> DataFrame:
    """Rows without a reason.  An amount too large for its column is an error."""
    _require_ansi(classified)
    return (split(classified)[0]
            .select(*[_narrowed(name).alias(name) for name in CLEAN_COLUMNS]))


def reject_rows(classified: DataFrame) -> DataFrame:
    """Rows with a reason: the reason, the record as it came, its lineage."""
    return split(classified)[1].select(*REJECT_COLUMNS)


def staged_rows(classified: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Both sides in one frame, told apart by ``outcome``.

    Written once, partitioned by ``outcome``, it takes one scan of RAW where
    two inserts take two; the columns of the other side are NULL and cost
    nothing in Parquet.
    """
    _require_ansi(classified)
    is_clean = F.col("reason").isNull()
    columns = []
    for name in STAGED_COLUMNS:
        if name in EVENT_COLUMNS:
            columns.append(F.when(is_clean, _narrowed(name)).alias(name))
        elif name == "raw":
            columns.append(F.when(~is_clean, F.col("raw")).alias("raw"))
        else:
            columns.append(F.col(name))
    outcome = F.when(is_clean, "clean").otherwise("reject").alias("outcome")
    return classified.select(*columns, *keep, outcome)
