"""Lakehouse data operators for PySpark: ingest, clean, merge, CDC, quality, policies, layout."""
