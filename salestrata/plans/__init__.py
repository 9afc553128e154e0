"""Multi-step jobs: the three layers as tables, and all reports from one scan."""

from salestrata.plans.layers import CatalogTables, FolderTables, SalesLayers
from salestrata.plans.report_book import report_book

__all__ = ["CatalogTables", "FolderTables", "SalesLayers", "report_book"]
