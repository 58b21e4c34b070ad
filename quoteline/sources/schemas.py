"""Fixed schemas of the order-book tables, plus ``conform``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fields(names: str, longs: set[str]) -> T.StructType:
    return T.StructType(
        [T.StructField(n, T.LongType() if n in longs else T.IntegerType(), True) for n in names.split()]
    )


# Column order of the three imported tables; time columns are epoch-ms longs,
# every other column an int, all nullable.  TRADES has quantity before price.
ORDERS_SCHEMA = _fields("id ref ob_id created destroyed side price quantity is_round past_id new_id p_id",
                        {"created", "destroyed"})
CANCELS_SCHEMA = _fields("id past_id new_id ob_id timestamp side price quantity", {"timestamp"})
TRADES_SCHEMA = _fields("id ref o_id ob_id timestamp side quantity price p_id cp_id", {"timestamp"})

TABLE_SCHEMAS = {"ORDERS": ORDERS_SCHEMA, "CANCELS": CANCELS_SCHEMA, "TRADES": TRADES_SCHEMA}
# Time column of each table: imported files are sorted by it within each task.
TIME_COLUMNS = {"ORDERS": "created", "CANCELS": "timestamp", "TRADES": "timestamp"}


class SchemaError(ValueError):
    """Input columns missing or not castable to a fixed schema."""


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in its order, cast to its types.

    Matching is case-insensitive, as Spark's resolver is by default; a missing column is an
    error.  Casts run under the session's ANSI setting, so a narrowing overflow raises
    instead of wrapping.
    """
    present = {f.name.lower(): f.name for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name.lower() not in present]
    if missing:
        raise SchemaError(f"missing columns {missing}; input has {df.columns}")
    return df.select([F.col(present[f.name.lower()]).cast(f.dataType).alias(f.name) for f in schema.fields])


def require_columns(df: DataFrame, *names: str) -> None:
    have = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in have]
    if missing:
        raise SchemaError(f"missing columns {missing}; input has {df.columns}")
