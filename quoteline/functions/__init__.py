"""Scalar column expressions and driver-side helpers (time grid, path names)."""
