"""Catalog metadata analytics on Spark: listings, DDL rewriting, failure analysis and export as DataFrame jobs."""

__version__ = "0.1.0"
