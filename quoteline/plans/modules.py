"""Built-in analysis modules.

A module is a plain function ``(spark, inputs, params) -> DataFrame``: ``inputs`` maps dataset
names to lazy DataFrames (in the order given), ``params`` is a dict.  It returns a lazy
DataFrame and never collects; the caller decides whether to show, save or discard it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.event_count import event_count
from ..operators.liquidity import liquidity_curve


def _first(inputs: Mapping[str, DataFrame]) -> DataFrame:
    if not inputs:
        raise ValueError("the module needs one input dataset")
    return next(iter(inputs.values()))


def _required(params: Mapping, *keys: str) -> list:
    missing = [k for k in keys if k not in params]
    if missing:
        raise ValueError(f"missing parameters {missing}")
    return [params[k] for k in keys]


def event_count_module(spark: SparkSession, inputs: Mapping[str, DataFrame], params: Mapping) -> DataFrame:
    """Rows per interval of the first input.  Parameters: ``start_time``, ``end_time`` (epoch
    ms or ``YYYY-mm-dd_HH:MM:SS.mmm``), ``interval`` (ms, may be fractional), optional
    ``time_column`` (default ``created``) and ``day_column`` (of a dataset saved by day)."""
    start, end, interval = _required(params, "start_time", "end_time", "interval")
    return event_count(_first(inputs), start, end, interval, time_col=params.get("time_column", "created"),
                       day_col=params.get("day_column"))


def liquidity_curve_module(spark: SparkSession, inputs: Mapping[str, DataFrame], params: Mapping) -> DataFrame:
    """Buy/sell liquidity curve of the first input (ORDERS).  Parameters: ``start_time``,
    ``end_time``, ``interval`` (whole ms)."""
    start, end, interval = _required(params, "start_time", "end_time", "interval")
    return liquidity_curve(_first(inputs), start, end, interval)


# Entry points of the built-in modules, by the names they are registered under.
BUILTIN_MODULES = {
    "EventCount": "quoteline.plans.modules:event_count_module",
    "Liquid": "quoteline.plans.modules:liquidity_curve_module",
}
