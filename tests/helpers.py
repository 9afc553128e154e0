from __future__ import annotations

import json

from salestrata.sources.jsonl import records_from_lines

# A valid event; a test changes what it is about.
VALID = {
    "event_id": "e-1", "event_ts": "2026-01-02T03:04:05.000006+00:00", "order_id": "o-1",
    "customer_id": 7, "session_id": "s-1", "product_id": 9, "category": "home",
    "quantity": 2, "unit_price": 12.50, "total_amount": 25.00, "currency": "USD",
    "payment_method": "card", "country": "PT", "device": "mobile", "marketing_channel": "email",
}
ABSENT = object()


def event(**changes) -> str:
    changed = {**VALID, **changes}
    return json.dumps({k: v for k, v in changed.items() if v is not ABSENT}, ensure_ascii=False)


def raw_rows(spark, texts):
    """RAW rows of the lines; each line's number is its file name."""
    lines = spark.createDataFrame([(t, str(i)) for i, t in enumerate(texts)],
                                  "value string, source_filename string")
    return records_from_lines(lines, "2026-01-01 00:00:00")


def explained(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def as_tuples(df):
    return [tuple(row) for row in df.collect()]
