"""Column names and types of the three layers."""

from __future__ import annotations

# The fifteen event keys with the type of their staged column.
EVENT_COLUMNS = {
    "event_id": "string",
    "event_ts": "timestamp_ntz",
    "order_id": "string",
    "customer_id": "decimal(38,0)",
    "session_id": "string",
    "product_id": "decimal(38,0)",
    "category": "string",
    "quantity": "decimal(38,0)",
    "unit_price": "decimal(10,2)",
    "total_amount": "decimal(10,2)",
    "currency": "string",
    "payment_method": "string",
    "country": "string",
    "device": "string",
    "marketing_channel": "string",
}

LINEAGE_COLUMNS = {"source_filename": "string", "ingestion_ts": "timestamp_ntz"}

RAW_COLUMNS = {"ingestion_ts": "timestamp_ntz", "source_filename": "string", "raw": "variant"}
CLEAN_COLUMNS = {**EVENT_COLUMNS, **LINEAGE_COLUMNS}
REJECT_COLUMNS = {"reason": "string", "raw": "variant", **LINEAGE_COLUMNS}
FACT_COLUMNS = CLEAN_COLUMNS

# One staged dataset holds both sides of the split, told apart by ``outcome``.
STAGED_COLUMNS = {**EVENT_COLUMNS, "reason": "string", "raw": "variant", **LINEAGE_COLUMNS}

# One row per load and file.
LOG_COLUMNS = {"source_filename": "string", "n_lines": "bigint", "n_records": "bigint",
               "n_blank": "bigint", "n_bad": "bigint"}

# One row per line that was not taken in, as it came.
BAD_COLUMNS = {"source_filename": "string", "value": "string"}

MONEY_TYPE = "decimal(10,2)"
MONEY_COLUMNS = tuple(name for name, kind in EVENT_COLUMNS.items() if kind == MONEY_TYPE)


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())
