"""The five business reports from one scan of the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestrata.functions import sales_day

# report name: the column it groups by
REPORT_KEYS = {
    "daily": "day",
    "category": "category",
    "payment_method": "payment_method",
    "country": "country",
    "marketing_channel": "marketing_channel",
}


def report_book(spark: SparkSession, fact: DataFrame) -> DataFrame:
    """(report, key, total_sales, total_units, total_revenue) of all reports.

    Run one by one the reports scan the fact table five times.  Here one scan
    is first summed up by all five keys at once, before and after the shuffle;
    the reports are then grouping sets over those sums.  Grouping the rows
    themselves five ways in one scan took twice as long.  The sums number at
    most the combinations of keys that occur, some ten thousand a day for the
    known categories, payment methods, countries and channels.
    """
    keys = list(REPORT_KEYS.values())
    # GROUPING() tells which report a row belongs to; a NULL key would not.
    report = " ".join(f"WHEN grouping({key}) = 0 THEN '{name}'"
                      for name, key in REPORT_KEYS.items())
    value = " ".join(f"WHEN grouping({key}) = 0 THEN CAST({key} AS STRING)" for key in keys)
    sums = fact.groupBy(sales_day(F.col("event_ts")).alias("day"), *keys[1:]).agg(
        F.count(F.lit(1)).alias("sales"),
        F.sum(F.col("quantity").cast("bigint")).alias("units"),
        F.sum("total_amount").alias("revenue"),
    )
    return spark.sql(
        f"""
        SELECT CASE {report} END AS report,
               CASE {value} END AS key,
               sum(sales) AS total_sales,
               sum(units) AS total_units,
               CAST(sum(revenue) AS DECIMAL(20,2)) AS total_revenue
        FROM {{sums}}
        GROUP BY GROUPING SETS ({', '.join(f'({key})' for key in keys)})
        """,
        sums=sums,
    )
