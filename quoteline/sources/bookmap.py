"""Order-book and catalogue tables derived from the star-schema test tables.

The given test data has no order book, so ORDERS, CANCELS and TRADES are derived from
``lineitem`` joined with ``orders``, and the catalogue tables from ``part``, ``region`` and
``lineitem``.  Everything is a lazy DataFrame: predicates on ``l_returnflag`` reach the Parquet
scan, only the needed columns are read, and the join is left to Catalyst/AQE (sort-merge on
``orderkey`` at scale, with skew splitting if one order key is hot).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timegrid import epoch_ms_ntz_sql
from .schemas import CANCELS_SCHEMA, ORDERS_SCHEMA, TRADES_SCHEMA, conform

# Fixed values of the mapping: one hour per line number, one day per unit of quantity, and
# the side code per return flag (A buys, R sells, anything else is neither side).
HOUR_MS = 3_600_000
DAY_MS = 86_400_000
SIDE_OF_FLAG = {"A": 66, "R": 83}
OTHER_SIDE = 78
PRICE_LEVELS = 20
MODULE_SLOTS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table as a DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str, flags: tuple[str, ...] = (), until: int | None = None) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"
    )
    if flags:
        li = li.where(F.col("l_returnflag").isin(*flags))
    # The order date is converted on the orders side, before the join: predicates that later
    # reach the join condition then refer to one column instead of repeating the conversion.
    od = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", f"{epoch_ms_ntz_sql('o_orderdate')} AS o_orderdate_ms"
    )
    if until is not None:  # an order line is created after its order: bound the join's input
        od = od.where(f"o_orderdate_ms <= {int(until)}L")
    return li.join(od, li["l_orderkey"] == od["o_orderkey"])


# Column expressions of the mapping, as SQL text (each projection is parsed once).
_BASE = f"(o_orderdate_ms + CAST(l_linenumber AS BIGINT) * {HOUR_MS})"
_COMMON = {
    "id": "CAST(l_orderkey * 8 + l_linenumber AS INT)",
    "side": (f"CASE l_returnflag WHEN 'A' THEN {SIDE_OF_FLAG['A']} WHEN 'R' THEN {SIDE_OF_FLAG['R']} "
             f"ELSE {OTHER_SIDE} END"),
    "price": f"CAST(l_partkey % {PRICE_LEVELS} AS INT)",
    "quantity": "CAST(l_quantity AS INT)",
    "ob_id": "CAST(l_partkey AS INT)",
    "past_id": "CAST(NULL AS INT)",
    "new_id": "CAST(NULL AS INT)",
}


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def orders_raw(spark: SparkSession, sf_dir: str, flags: tuple[str, ...] = (), until: int | None = None) -> DataFrame:
    """ORDERS rows before ``conform``."""
    c = _COMMON
    return _select(_lines(spark, sf_dir, flags, until), {
        "id": c["id"],
        "ref": "l_suppkey",
        "ob_id": c["ob_id"],
        "created": _BASE,
        "destroyed": (f"CASE WHEN l_linenumber = 1 AND l_returnflag = 'A' THEN CAST(0 AS BIGINT) "
                      f"ELSE {_BASE} + CAST(l_quantity AS BIGINT) * {DAY_MS} END"),
        "side": c["side"],
        "price": c["price"],
        "quantity": c["quantity"],
        "is_round": f"CASE WHEN {c['quantity']} % 10 = 0 THEN 1 ELSE 0 END",
        "past_id": c["past_id"],
        "new_id": c["new_id"],
        "p_id": "o_custkey",
    })


def book_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORDERS with the fixed schema."""
    return conform(orders_raw(spark, sf_dir), ORDERS_SCHEMA)


def curve_orders(spark: SparkSession, sf_dir: str, end: int) -> DataFrame:
    """ORDERS that a curve up to ``end`` can use: the two sides (a filter that reaches the scan of
    ``lineitem``) and orders dated up to ``end`` (before the join)."""
    return conform(orders_raw(spark, sf_dir, tuple(SIDE_OF_FLAG), end), ORDERS_SCHEMA)


def book_cancels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CANCELS with the fixed schema: the lines with return flag R."""
    c = _COMMON
    return conform(_select(_lines(spark, sf_dir, flags=("R",)), {
        "id": c["id"], "past_id": c["past_id"], "new_id": c["new_id"], "ob_id": c["ob_id"],
        "timestamp": epoch_ms_ntz_sql("l_shipdate"),
        "side": c["side"], "price": c["price"], "quantity": c["quantity"],
    }), CANCELS_SCHEMA)


def book_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TRADES with the fixed schema: the lines with return flag A."""
    c = _COMMON
    return conform(_select(_lines(spark, sf_dir, flags=("A",)), {
        "id": c["id"], "ref": "l_suppkey", "o_id": "l_orderkey", "ob_id": c["ob_id"],
        "timestamp": epoch_ms_ntz_sql("l_shipdate"),
        "side": c["side"], "quantity": c["quantity"], "price": c["price"],
        "p_id": "o_custkey", "cp_id": "l_suppkey",
    }), TRADES_SCHEMA)


# ---------------------------------------------------------------------------------------------
# Catalogue tables
# ---------------------------------------------------------------------------------------------

def catalog_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``datasets``: one per part; the name carries the key because part names repeat."""
    slot = F.col("p_size") % MODULE_SLOTS
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string")).alias("name"),
        F.when(slot != 0, slot).alias("module_id"),
    )


def catalog_analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``analyses``: one module per region."""
    return table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))


def catalog_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineage``: distinct (part, supplier) pairs of ``lineitem`` with different keys."""
    return (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_partkey").alias("left_fs_id"), F.col("l_suppkey").alias("right_ds_id"))
        .where(F.col("left_fs_id") != F.col("right_ds_id"))
        .distinct()
    )
