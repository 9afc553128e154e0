"""Counts and business reports.

All reports are partial aggregate, one small shuffle, final aggregate: a key
that holds a third of the rows is one row per task by the time it moves.  Every
order has the key as tie-break, so the order (and the tenth country) is fixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestrata.functions import sales_day


def _sales(name: str = "total_sales") -> Column:
    return F.count(F.lit(1)).alias(name)


def _units(name: str = "total_units") -> Column:
    # Clean quantities are positive, so none can exceed the bigint total: the
    # early cast overflows exactly when the total would, and sums plain longs.
    return F.sum(F.col("quantity").cast("bigint")).alias(name)


def _revenue(name: str = "total_revenue") -> Column:
    return F.sum("total_amount").cast("decimal(20,2)").alias(name)


def _by_day(fact: DataFrame, *measures: Column) -> DataFrame:
    days = fact.groupBy(sales_day(F.col("event_ts")).alias("day")).agg(*measures)
    return days.withColumn("day", F.col("day").cast("timestamp_ntz")).orderBy("day")


def _ranked(fact: DataFrame, key: str, measures: list[Column], rank_by: str) -> DataFrame:
    return (fact.groupBy(key).agg(*measures)
            .orderBy(F.desc(rank_by), F.asc_nulls_last(key)))


def row_count(table: DataFrame, name: str) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias(name))


def reject_reasons(rejects: DataFrame) -> DataFrame:
    return _ranked(rejects, "reason", [_sales("n")], "n")


def daily_summary(fact: DataFrame) -> DataFrame:
    return _by_day(fact, _sales("events"), _units("units"), _revenue("revenue"))


def daily_revenue(fact: DataFrame) -> DataFrame:
    return _by_day(fact, _sales(), _revenue())


def category_revenue(fact: DataFrame) -> DataFrame:
    return _ranked(fact, "category", [_sales(), _units(), _revenue()], "total_revenue")


def payment_methods(fact: DataFrame) -> DataFrame:
    return _ranked(fact, "payment_method", [_sales(), _revenue()], "total_sales")


def top_countries(fact: DataFrame, n: int = 10) -> DataFrame:
    return _ranked(fact, "country", [_sales(), _revenue()], "total_revenue").limit(n)


def marketing_channels(fact: DataFrame) -> DataFrame:
    return _ranked(fact, "marketing_channel", [_sales(), _revenue()], "total_revenue")
