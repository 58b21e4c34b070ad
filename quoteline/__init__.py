"""Order-event analytics on Spark DataFrames.

Operators are plain functions from DataFrames to a DataFrame built from Spark's own
expressions: event counts per fixed interval, buy/sell liquidity curves on a time grid,
typed import of order-book tables, and a Parquet catalogue of datasets, feature sets,
modules and their lineage.
"""

from .operators.event_count import event_count, time_range
from .operators.liquidity import (
    depth_by_price,
    fill_open_orders,
    grid_expand,
    liquidity_curve,
    live_orders,
    side_curve,
    side_orders,
)

__all__ = [
    "event_count",
    "time_range",
    "depth_by_price",
    "fill_open_orders",
    "grid_expand",
    "liquidity_curve",
    "live_orders",
    "side_curve",
    "side_orders",
]
