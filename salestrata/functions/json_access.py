"""Access to the keys of a whole-record JSON column.

Each key is its own ``variant_get``.  Over a Parquet RAW table Spark then reads
only the requested paths; one cast of the whole record to a struct would read
the same paths but evaluates the struct again for every predicate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_value(record: str, key: str) -> Column:
    """The value under ``key`` as it is; a JSON null is a value, absent is NULL."""
    return F.expr(f"variant_get({record}, '$.{key}')")


def json_text(record: str, key: str) -> Column:
    """The value under ``key`` as text; a JSON null and an absent key are NULL."""
    return F.variant_get(record, f"$.{key}", "string")
