"""Lineage of a landed record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def store_path(file_uri: Column) -> Column:
    """Path of a file within its store: no scheme, no bucket, nothing URL-encoded.

    ``s3a://bucket/raw/sales/a%20b.jsonl`` becomes ``raw/sales/a b.jsonl``.  A
    plus sign is literal in a path, so it is kept out of the URL decoding.
    """
    path = F.regexp_replace(file_uri, r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?/", "")
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(path, F.lit("%")), decoded).otherwise(path)
