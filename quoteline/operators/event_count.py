"""Event count: number of rows whose time falls in each fixed interval of ``[start, end)``.

Plan: one scan with the range predicate stated on the stored column (row groups are skipped for integer
and TIMESTAMP columns; for TIMESTAMP_NTZ Spark's reader reads them all), a projection to the bucket start, and a partial + final hash aggregate on that single long key.  The shuffle
carries at most one row per bucket per map task, whatever the skew of the input, so the job
scales with the scan.  Empty buckets are absent (the result is sparse).

A table saved by day (:func:`quoteline.sources.sinks.save_by_day`) has its UTC day as a partition column; named as ``day_col``, it
gets a predicate derived from the range, so other days' files are not opened, whatever the type of the time column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timegrid import (
    MS_PER_DAY,
    bucket_start,
    bucket_start_sql,
    epoch_ms,
    epoch_ms_sql,
    time_literal,
    validate_window,
)


def time_range(df: DataFrame, start, end, time_col: str = "created", day_col: str | None = None) -> DataFrame:
    """rows with ``start <= t < end``; ``t`` is ``time_col`` in epoch milliseconds.

    The predicate is stated on the stored column (a timestamp literal for timestamp columns,
    exactly equivalent because the conversion truncates), so the scan can skip row groups where the
    column is an integer or a TIMESTAMP.  Imported tables hold integers.  ``day_col`` is a column of days since the
    epoch (UTC) that belong to ``time_col``; the days that the range does not touch are left out by it.
    """
    start_ms, end_ms, _ = validate_window(start, end, 1)
    dtype = df.schema[time_col].dataType
    col = F.col(time_col)
    if day_col is not None:
        df = df.where(F.col(day_col).between(start_ms // MS_PER_DAY, (end_ms - 1) // MS_PER_DAY))
    return df.where((col >= time_literal(start_ms, dtype)) & (col < time_literal(end_ms, dtype)))


def event_count(df: DataFrame, start, end, interval, time_col: str = "created", sort: bool = True,
                day_col: str | None = None) -> DataFrame:
    """Count rows per bucket ``start + k * interval`` over ``[start, end)``.

    ``interval`` is in milliseconds and may be fractional.  ``time_col`` may hold epoch
    milliseconds (long) or a timestamp.  Output: ``timestamp`` (bucket start, bigint) and
    ``count`` (bigint), ordered by ``timestamp`` unless ``sort=False``.  ``day_col`` as in :func:`time_range`.
    """
    start_ms, end_ms, iv = validate_window(start, end, interval)
    dtype = df.schema[time_col].dataType
    if isinstance(iv, int):  # exact integer arithmetic, one parsed expression
        bucket = F.expr(bucket_start_sql(epoch_ms_sql(time_col, dtype), start_ms, iv))
    else:  # the float rule of a fractional interval
        bucket = bucket_start(epoch_ms(F.col(time_col), dtype), start_ms, iv)
    out = (
        time_range(df.select(time_col, *([day_col] if day_col else [])), start_ms, end_ms, time_col, day_col)
        .select(bucket.alias("timestamp"))
        .groupBy("timestamp")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return out.orderBy("timestamp") if sort else out
