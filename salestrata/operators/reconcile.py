"""Row counts of the layers side by side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _with_verdict(counts: DataFrame) -> DataFrame:
    balanced = ((F.col("raw_rows") == F.col("clean_rows") + F.col("reject_rows"))
                & (F.col("fact_rows") == F.col("clean_rows")))
    return counts.withColumn("balanced", balanced)


def reconcile_layers(raw: DataFrame, clean: DataFrame, rejects: DataFrame,
                     fact: DataFrame) -> DataFrame:
    """Counts of four written tables.  Each is a count without columns, which
    Parquet answers from its footers."""
    layers = {"raw_rows": raw, "clean_rows": clean, "reject_rows": rejects, "fact_rows": fact}
    counts = [table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n")
              for name, table in layers.items()]
    side_by_side = reduce(DataFrame.unionAll, counts).agg(*[
        F.sum(F.when(F.col("layer") == name, F.col("n"))).alias(name) for name in layers])
    return _with_verdict(side_by_side)


def reconcile_by_load(raw: DataFrame, clean: DataFrame, rejects: DataFrame, fact: DataFrame,
                      log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The counts of each load in every table, whichever of them have it, and whether they agree.

    Totals can balance where a load is missing and another is there twice; these don't.
    ``log`` has the records that a load was said to hold (``n_records``); a load that no log
    speaks of is judged by its rows.  Only partition columns are read, and each table is counted
    by load before the small shuffle."""
    layers = {"raw_rows": raw, "clean_rows": clean, "reject_rows": rejects, "fact_rows": fact}
    counts = [table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(*keys, F.lit(name).alias("layer"), "n")
              for name, table in layers.items()]
    counts.append(log.groupBy(*keys).agg(F.sum("n_records").alias("n")).select(*keys, F.lit("log_rows").alias("layer"), "n"))
    side_by_side = reduce(DataFrame.unionAll, counts).groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(F.col("layer") == name, F.col("n"))), F.lit(0)).alias(name) for name in layers],
        F.sum(F.when(F.col("layer") == "log_rows", F.col("n"))).alias("log_rows"))
    judged = _with_verdict(side_by_side)
    agrees = F.coalesce(F.col("log_rows") == F.col("raw_rows"), F.lit(True))
    return judged.withColumn("balanced", F.col("balanced") & agrees)
