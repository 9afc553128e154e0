"""Sources and sinks: JSON Lines folders and the sales feed of the events table."""

from salestrata.sources.jsonl import ingest_jsonl, read_lines, records_from_lines
from salestrata.sources.jsonl_sink import write_jsonl

__all__ = ["ingest_jsonl", "read_lines", "records_from_lines", "write_jsonl"]
