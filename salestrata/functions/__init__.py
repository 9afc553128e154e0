"""Column expressions: JSON access, safe casts, lineage."""

from salestrata.functions.casts import (
    is_timestamp_text,
    sales_day,
    safe_number,
    safe_timestamp,
)
from salestrata.functions.json_access import json_text, json_value
from salestrata.functions.lineage import store_path

__all__ = [
    "is_timestamp_text",
    "json_text",
    "json_value",
    "safe_number",
    "safe_timestamp",
    "sales_day",
    "store_path",
]
