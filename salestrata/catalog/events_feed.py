"""Sales feeds derived from the ``events`` table.

The tables at hand hold no sales, so the JSON lines the layers start from are
made from ``events``, one per row: every twentieth event carries one of eight
faults, the rest are valid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestrata.session import spread

# What every derived line says about its origin.
SOURCE_FILENAME = "raw/sales/dt=20260101/sales_20260101T000000Z_1.jsonl"
INGESTION_TS = "2026-01-01 00:00:00"

# Fixed values of the sales events.
PAYMENT_METHODS = ("card", "paypal", "apple_pay", "bank_transfer")
DEVICES = ("mobile", "desktop", "tablet")
CHANNELS = ("organic", "paid_search", "email", "social", "affiliate")


def iso_text(ts: str) -> str:
    """ISO text with six digits of a zone-free time.  ``date_format`` would take
    it through the session zone and move times inside a clock change."""
    text = f"cast({ts} as string)"
    return (f"replace(substr({text}, 1, 19), ' ', 'T') || '.' "
            f"|| rpad(substr({text}, 21), 6, '0')")


def _pick(values: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast(({index}) % {len(values)} as int) + 1)"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table, dealt out where it lies in a few large row groups: what is made of it goes
    on in the scan's tasks, up to the files of RAW and of the layers after it."""
    return spread(spark.read.parquet(f"{sf_dir}/events.parquet"), "event_id", "ts")


def sales_events(events: DataFrame) -> DataFrame:
    """The fifteen event columns, typed, with the fault number of the row."""
    keyed = events.selectExpr(
        "*", "cast(get_json_object(props, '$.k') as int) as k",
        "case when event_id % 20 = 0 then (event_id div 20) % 8 else -1 end as fault",
        "cast(value as decimal(10,2)) as price")
    return keyed.selectExpr(
        "fault",
        "'E' || event_id as event_id",
        "ts as event_ts",
        "'O' || event_id as order_id",
        "user_id as customer_id",
        "'S' || user_id as session_id",
        "k as product_id",
        "event_type as category",
        "1 + k % 5 as quantity",
        "price as unit_price",
        "cast(price * (1 + k % 5) as decimal(10,2)) as total_amount",
        "'USD' as currency",
        f"{_pick(PAYMENT_METHODS, 'event_id div 7')} as payment_method",
        "'C' || user_id % 13 as country",
        f"{_pick(DEVICES, 'event_id div 7')} as device",
        f"{_pick(CHANNELS, 'event_id div 3')} as marketing_channel",
    )


def sales_lines(events: DataFrame) -> DataFrame:
    """``(value, source_filename)``: one JSON line per event, faults included."""
    iso = f"{iso_text('event_ts')} || '+00:00'"
    # What each fault puts in place of the valid JSON value.
    members = [
        "case fault when 0 then '\"event_id\": null, ' when 7 then '' "
        "else '\"event_id\": \"' || event_id || '\", ' end",
        f"'\"event_ts\": \"' || if(fault = 1, 'not-a-timestamp', {iso}) || '\"'",
        "', \"order_id\": \"' || order_id || '\"'",
        "', \"customer_id\": ' || customer_id",
        "', \"session_id\": \"' || session_id || '\"'",
        "', \"product_id\": ' || product_id",
        "', \"category\": \"' || category || '\"'",
        "', \"quantity\": ' || case fault when 2 then '\"two\"' when 3 then '0' "
        "else cast(quantity as string) end",
        "', \"unit_price\": ' || unit_price",
        "', \"total_amount\": ' || case fault when 4 then '\"NaN\"' when 5 then 'null' "
        "when 6 then '-1.0' else cast(total_amount as string) end",
        "', \"currency\": \"' || currency || '\"'",
        "', \"payment_method\": \"' || payment_method || '\"'",
        "', \"country\": \"' || country || '\"'",
        "', \"device\": \"' || device || '\"'",
        "', \"marketing_channel\": \"' || marketing_channel || '\"'",
    ]
    line = F.concat(F.lit("{"), *[F.expr(member) for member in members], F.lit("}"))
    return sales_events(events).select(line.alias("value"),
                                       F.lit(SOURCE_FILENAME).alias("source_filename"))


# Line kinds of a landing file that is not clean JSON Lines; the
# text is a SQL expression over an event.
MESSY_LINES = (
    ("object", "'{\"event_id\": \"E' || event_id || '\"}'"),
    ("broken", "'{\"event_id\": \"E' || event_id"),
    ("blank", "repeat(' ', cast(event_id % 3 as int))"),
    ("array", "'[{\"event_id\": \"E' || event_id || '\"}, {\"event_id\": null}, 7]'"),
    ("repeated key", "'{\"event_id\": \"E' || event_id || '\", \"event_id\": \"again\"}'"),
    ("number", "cast(event_id as string)"),
    ("null", "'null'"),
    ("non-ascii", "'{\"event_id\": \"é-日本-' || event_id || '\"}'"),
    ("empty array", "'[]'"),
    ("two objects", "'{\"event_id\": \"E' || event_id || '\"} {\"event_id\": null}'"),
    ("trailing text", "'{\"event_id\": \"E' || event_id || '\"} x'"),
    ("trailing comma", "'{\"event_id\": \"E' || event_id || '\"},'"),
    ("two numbers", "event_id || ', 7'"),
    ("single quotes", "'{''event_id'': 1}'"),
    ("not a number", "'{\"event_id\": NaN}'"),
)


def messy_lines(events: DataFrame) -> DataFrame:
    """One line per event, of the kind its id picks; the kind is the file name."""
    n = len(MESSY_LINES)
    kinds = " ".join(f"when {i} then '{kind}'" for i, (kind, _) in enumerate(MESSY_LINES))
    texts = " ".join(f"when {i} then {text}" for i, (_, text) in enumerate(MESSY_LINES))
    return events.selectExpr(f"case event_id % {n} {texts} end as value",
                             f"case event_id % {n} {kinds} end as source_filename")


# Forms a time, a file name or a number may arrive in, as SQL over
# an event.  The SQL counterparts use the same texts.
TIME_FORMS = (
    "{iso} || '+00:00'",
    "{iso} || '-05:00'",
    "substr({iso}, 1, 19)",
    "substr({iso}, 1, 10)",
    "replace({iso}, 'T', ' ')",
    "' ' || {iso} || ' '",
    "'not-a-timestamp'",
    "'now'",
    "substr({iso}, 1, 4)",
    "substr({iso}, 1, 7)",
    "'1700' || substr({iso}, 21, 6)",
    "substr({iso}, 1, 4) || '-02-30'",
    "substr({iso}, 1, 11) || '25:00:00'",
    "''",
)
FILE_FORMS = (
    "'s3a://bucket/raw/sales/dt=20260101/' || event_id || '.jsonl'",
    "'file:///raw/sales/dt=20260101/a%20b+' || event_id || '.jsonl'",
    "'file:/raw/sales/%C3%A9%25' || event_id",
    "'hdfs://node:8020/raw//sales/' || event_id || ':1'",
)
NUMBER_FORMS = (
    "{price}",
    "'-' || {price}",
    "'+' || {price}",
    "' ' || {price} || ' '",
    "{price} || 'e1'",
    "'.' || {k}",
    "{k} || '.5'",
    "'-' || {k} || '.5'",
    "'$' || {price}",
    "'1,' || {price}",
    "'NaN'",
    "'Infinity'",
    "'two'",
    "''",
    "{price} || ' USD'",
)


def pick_form(forms: tuple[str, ...], **parts: str) -> str:
    """The form an event's id picks; valid in Spark and in DuckDB."""
    whens = " ".join(f"when {i} then {form.format(**parts)}" for i, form in enumerate(forms))
    return f"case event_id % {len(forms)} {whens} end"
