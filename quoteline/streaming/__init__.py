"""Incremental (Structured Streaming) import of per-day order-book files."""
