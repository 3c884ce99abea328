"""Retail sales analytics on Spark: warehouse build, reports and stream enrichment."""

from tillwise.tables import RetailTables

__all__ = ["RetailTables"]
