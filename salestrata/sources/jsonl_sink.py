"""JSON Lines sink under a folder per load day."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame

# Times go out as ISO-8601 with microseconds and a zero offset.
_EVENT_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def write_jsonl(events: DataFrame, root: str, dt: str | None = None,
                max_records_per_file: int = 0) -> str:
    """Adds ``events`` as JSON Lines files under ``root/dt=YYYYMMDD``.

    One object per line, null keys written out, non-ASCII text kept.  ``dt`` is
    the UTC day of the write unless given.  Naming the folder here rather than
    partitioning by a constant column saves the sort before the write.
    """
    day = dt or datetime.now(timezone.utc).strftime("%Y%m%d")
    folder = f"{root.rstrip('/')}/dt={day}"
    (events.write.mode("append")
     .option("ignoreNullFields", "false")
     .option("timestampNTZFormat", _EVENT_TIME)
     .option("maxRecordsPerFile", max_records_per_file)
     .json(folder))
    return folder
