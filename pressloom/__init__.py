"""Spark jobs over news article tables: ingest, enrich, aggregate, index, search, govern, monitor."""

__version__ = "0.1.0"
