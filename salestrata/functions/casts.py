"""Casts that turn bad text into NULL, and the day of a sale."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text must start with a full calendar date to count as a time.
TIMESTAMP_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ].*)?$"


def is_timestamp_text(text: Column) -> Column:
    return F.regexp_like(F.trim(text), F.lit(TIMESTAMP_SHAPE))


def safe_timestamp(text: Column) -> Column:
    """Text to a zone-free time, NULL where it is none.

    A zone offset is dropped and the wall clock kept.  The shape check keeps
    out what a bare cast would accept: ``now``, a lone year, an epoch number.
    """
    return F.when(is_timestamp_text(text), text.try_cast("timestamp_ntz"))


def safe_number(text: Column, scale: int = 0) -> Column:
    """Text to an exact number rounded to ``scale`` digits, NULL where it is none.

    Never by way of double: ``NaN`` would become a number there.
    """
    return text.try_cast(f"decimal(38,{scale})")


def sales_day(event_ts: Column) -> Column:
    """The day of a zone-free time, as a date (group by it, it is four bytes)."""
    return event_ts.cast("date")
