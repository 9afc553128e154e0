"""Incremental loads with Structured Streaming."""

from salestrata.streaming.incremental import load_new_files

__all__ = ["load_new_files"]
