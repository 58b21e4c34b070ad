"""Time parameters and time-grid expressions (epoch milliseconds throughout).

All expressions are built-in Spark columns, so they stay inside whole-stage codegen.  None of
them depends on the session time zone: TIMESTAMP_NTZ values are counted from a zone-free epoch
with ``timestamp_diff``, and day boundaries are UTC days computed with integer arithmetic.
"""

from __future__ import annotations

import datetime as _dt
import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Units of the epoch-millisecond time axis.
MS_PER_SECOND = 1_000
MS_PER_DAY = 86_400_000

# Text layout of a time parameter; any one character may separate the seconds from
# the three millisecond digits.
SPARK_PARAM_LAYOUT = "yyyy-MM-dd_HH:mm:ss"
_PARAM_TEXT = re.compile(r"(\d{4})-(\d\d)-(\d\d)_(\d\d):(\d\d):(\d\d).(\d{3})", re.ASCII | re.DOTALL)

_INTEGER_TEXT = re.compile(r"-?\d+", re.ASCII)
_EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)

_INTEGRAL = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)


# ---------------------------------------------------------------------------------------------
# Driver-side parameters
# ---------------------------------------------------------------------------------------------

def parse_time(value) -> int:
    """A time parameter as epoch milliseconds (UTC).

    Accepts an integer number of milliseconds, a digit string, or text laid out as
    ``YYYY-mm-dd_HH:MM:SS?mmm``.  The result is ``seconds * 1000 + millis``, which stays
    right before 1970 (the digits are not appended as text).
    """
    if isinstance(value, bool):
        raise TypeError("a time parameter cannot be a bool")
    if isinstance(value, int):
        return value
    if isinstance(value, float):
        if not value.is_integer():
            raise ValueError(f"time parameter {value!r} is not a whole number of milliseconds")
        return int(value)
    if not isinstance(value, str):
        raise TypeError(f"cannot read a time from {type(value).__name__}")
    text = value.strip()
    if _INTEGER_TEXT.fullmatch(text):
        return int(text)
    match = _PARAM_TEXT.fullmatch(text)
    if not match:
        raise ValueError(f"time parameter {value!r} is not laid out as YYYY-mm-dd_HH:MM:SS.mmm")
    *fields, millis = (int(g) for g in match.groups())
    try:
        moment = _dt.datetime(*fields, tzinfo=_dt.timezone.utc)
    except ValueError as exc:
        raise ValueError(f"time parameter {value!r} names no moment: {exc}") from exc
    return (moment - _EPOCH) // _dt.timedelta(milliseconds=1) + millis


def parse_interval(interval, integral: bool = False) -> int | float:
    """A positive interval in milliseconds; whole values come back as ``int``."""
    if isinstance(interval, bool) or not isinstance(interval, (int, float, str)):
        raise TypeError("interval must be a number of milliseconds")
    iv = float(interval) if isinstance(interval, str) else interval
    if isinstance(iv, float):
        if not math.isfinite(iv):
            raise ValueError(f"interval must be finite, got {interval!r}")
        if iv.is_integer():
            iv = int(iv)
    if iv <= 0:
        raise ValueError(f"interval must be a positive number of milliseconds, got {interval!r}")
    if integral and not isinstance(iv, int):
        raise ValueError(f"interval must be a whole number of milliseconds here, got {interval!r}")
    return iv


def validate_window(start, end, interval, integral: bool = False) -> tuple[int, int, int | float]:
    """Parse and check ``(start, end, interval)``; the range is half-open ``[start, end)``."""
    start_ms, end_ms = parse_time(start), parse_time(end)
    iv = parse_interval(interval, integral=integral)
    if end_ms < start_ms:
        raise ValueError(f"end {end_ms} lies before start {start_ms}")
    return start_ms, end_ms, iv


# ---------------------------------------------------------------------------------------------
# Column expressions
# ---------------------------------------------------------------------------------------------

def floor_div(num: Column, den: int) -> Column:
    """Exact floor division of a long column by a positive integer (no double round trip)."""
    return F.call_function("div", num - F.pmod(num, F.lit(den)), F.lit(den))


def epoch_micros_ntz(ts: Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ column, read as UTC.

    Built from zone-free parts (the NTZ date and its time-of-day fields), because functions
    that take TIMESTAMP would first convert the value through the session zone, which shifts
    it by the DST offset outside UTC.
    """
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    secs = F.date_part(F.lit("SECOND"), ts)  # decimal(8,6): seconds with microseconds
    return (
        days * F.lit(86_400_000_000)
        + F.hour(ts).cast("long") * F.lit(3_600_000_000)
        + F.minute(ts).cast("long") * F.lit(60_000_000)
        + (secs * F.lit(1_000_000)).cast("long")
    )


def epoch_ms_ntz_sql(name: str) -> str:
    """SQL text of :func:`epoch_ms` for a TIMESTAMP_NTZ column ``name`` (zone-free): whole
    days, hours and minutes, plus the seconds with their fraction truncated to milliseconds.
    One parsed expression instead of many column calls, for wide projections."""
    return (
        f"(CAST(datediff(CAST({name} AS DATE), DATE'1970-01-01') AS BIGINT) * {MS_PER_DAY}"
        f" + CAST(hour({name}) AS BIGINT) * 3600000 + CAST(minute({name}) AS BIGINT) * 60000"
        f" + CAST(date_part('SECOND', {name}) * 1000 AS BIGINT))"
    )


def epoch_ms(col: Column, dtype: T.DataType) -> Column:
    """Epoch milliseconds of a time column.

    Integral columns are already milliseconds; timestamps are truncated to the millisecond
    (floor, like ``unix_millis``).
    """
    if isinstance(dtype, _INTEGRAL):
        return col.cast("long")
    if isinstance(dtype, T.TimestampNTZType):
        return floor_div(epoch_micros_ntz(col), 1000)
    if isinstance(dtype, T.TimestampType):
        return F.unix_millis(col)
    raise TypeError(f"cannot read epoch milliseconds from a {dtype.simpleString()} column")


def time_literal(ms: int, dtype: T.DataType) -> Column:
    """A literal of ``dtype`` at ``ms`` epoch milliseconds.

    Used to state a range predicate on the *stored* column so that the Parquet reader can skip row
    groups: it does for integers and TIMESTAMP (microseconds).  It does not for TIMESTAMP_NTZ, nor for
    INT96 files: there the filter is listed in the plan but every row group is read.  For timestamps,
    ``ts >= literal(ms)`` holds exactly when ``epoch_ms(ts) >= ms`` because the conversion truncates.
    """
    if isinstance(dtype, _INTEGRAL):
        # a long literal: Catalyst unwraps the widening cast of a narrower column for pushdown,
        # and folds bounds outside the column's range instead of overflowing
        return F.lit(int(ms)).cast("long")
    if isinstance(dtype, T.TimestampNTZType):
        seconds, millis = divmod(int(ms), MS_PER_SECOND)
        stamp = _dt.datetime(1970, 1, 1) + _dt.timedelta(seconds=seconds, milliseconds=millis)
        return F.lit(stamp.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit(int(ms) * 1000))
    raise TypeError(f"no time literal for a {dtype.simpleString()} column")


def bucket_start(t: Column, start: int, interval: int | float) -> Column:
    """Start of the fixed bucket holding ``t`` on a grid anchored at ``start``.

    Whole intervals use exact integer arithmetic.  A fractional interval follows the float
    rule ``int(start + floor((t - start) / interval) * interval)``.
    """
    if isinstance(interval, int):
        offset = t - F.lit(start)
        return F.lit(start) + (offset - F.pmod(offset, F.lit(interval)))
    k = F.floor((t - F.lit(start)).cast("double") / F.lit(float(interval)))
    return (F.lit(float(start)) + k * F.lit(float(interval))).cast("long")


def floor_to_grid(t: Column, start: int, interval: int) -> Column:
    """Last grid point at or before ``t``."""
    return t - F.pmod(t - F.lit(start), F.lit(interval))


# Grid and parameter expressions as SQL text, for wide projections written with selectExpr (one
# parse instead of many column calls).  Numbers are parenthesised so negatives stay safe.

def end_of_day_sql(t: str) -> str:
    """23:59:59.999 of the UTC day holding ``t`` (epoch milliseconds)."""
    return f"({t} - pmod({t}, {MS_PER_DAY}L) + {MS_PER_DAY - 1}L)"


def ceil_to_grid_sql(t: str, start: int, interval: int) -> str:
    """First grid point ``start + k * interval`` at or after ``t`` (any integer ``k``)."""
    return f"({t} + pmod(({start}L) - {t}, {interval}L))"


def floor_to_grid_sql(t: str, start: int, interval: int) -> str:
    """:func:`floor_to_grid` as SQL text."""
    return f"({t} - pmod({t} - ({start}L), {interval}L))"


def format_time_sql(ms: str) -> str:
    """Epoch milliseconds as ``YYYY-mm-dd_HH:MM:SS.mmm`` text (UTC), from integer parts only, so that no
    session-zone conversion (and no DST gap) is involved."""
    rem = f"pmod({ms}, {MS_PER_DAY}L)"
    day = f"CAST(({ms} - {rem}) DIV {MS_PER_DAY}L AS INT)"
    return (
        f"concat(CAST(date_add(DATE'1970-01-01', {day}) AS STRING), '_',"
        f" lpad(CAST({rem} DIV 3600000 AS STRING), 2, '0'), ':',"
        f" lpad(CAST(pmod({rem} DIV 60000, 60) AS STRING), 2, '0'), ':',"
        f" lpad(CAST(pmod({rem} DIV 1000, 60) AS STRING), 2, '0'), '.',"
        f" lpad(CAST(pmod({rem}, 1000) AS STRING), 3, '0'))"
    )


def parse_time_sql(text: str) -> str:
    """E1 as SQL text: ``YYYY-mm-dd_HH:MM:SS?mmm`` to epoch milliseconds (UTC, zone-free).  The last three
    characters must be digits; text that does not parse raises, as a bad parameter does."""
    head = f"to_timestamp_ntz(substr({text}, 1, length({text}) - 4), '{SPARK_PARAM_LAYOUT}')"
    millis = f"regexp_extract({text}, '.([0-9]{{3}})$', 1)"  # empty, and so an error, unless three digits
    return f"({epoch_ms_ntz_sql(head)} + CAST({millis} AS BIGINT))"


def epoch_ms_sql(name: str, dtype: T.DataType) -> str:
    """:func:`epoch_ms` as SQL text for the column ``name``."""
    q = f"`{name}`"
    if isinstance(dtype, _INTEGRAL):
        return f"CAST({q} AS BIGINT)"
    if isinstance(dtype, T.TimestampNTZType):
        return epoch_ms_ntz_sql(q)
    if isinstance(dtype, T.TimestampType):
        return f"unix_millis({q})"
    raise TypeError(f"cannot read epoch milliseconds from a {dtype.simpleString()} column")


def bucket_start_sql(t: str, start: int, interval: int) -> str:
    """:func:`bucket_start` as SQL text, for a whole ``interval``."""
    return f"(({start}L) + (({t} - ({start}L)) - pmod({t} - ({start}L), {interval}L)))"
