"""Scans, imports, sinks, fixed schemas and the Parquet catalogue store."""
