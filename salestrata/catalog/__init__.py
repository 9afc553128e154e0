"""Named results over the driver tables, each with its SQL counterpart."""

from salestrata.catalog.oracles import oracle_sql
from salestrata.catalog.results import entry_query, queries

__all__ = ["entry_query", "oracle_sql", "queries"]
