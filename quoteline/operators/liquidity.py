"""Liquidity curve: live quantity per price at every point of a time grid, buy and sell side.

Semantics (epoch milliseconds): grid points are ``t = start + k * interval`` with
``start <= t < end``.  An order is live at ``t`` when ``created <= t < destroyed``; an order with
``destroyed == 0`` is open and ends at 23:59:59.999 of its UTC creation day.  Side 66 is buy,
83 is sell, any other code belongs to neither.  The curve at ``t`` lists ``(price, quantity)``
per price with at least one live order, price ascending, quantity summed (not cumulative).
The two-sided curve keeps only grid points where both sides are non-empty.

Plan at scale (``depth_by_price``): the naive plan explodes each order to every grid point it
covers, so its shuffle grows with ``orders * lifetime / interval``.  Here each order emits two
change events instead (``+q`` at its first grid point, ``-q`` after its last); the events are
pre-aggregated by ``(side, price, t)`` map-side, so the shuffle holds at most one row per grid
point per price level per map task, however many orders share a price.  Running sums per price
level give the depth at each change point, and only the runs between change points are
expanded.  The running sums are split by time chunk (a prefix sum over per-chunk totals seeds
each chunk), so a hot price level is spread over many window tasks of bounded size.  Expansion
is done in blocks, spread over tasks for long grids, so no single array or task grows with the
grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timegrid import (
    ceil_to_grid_sql,
    end_of_day_sql,
    floor_to_grid,
    floor_to_grid_sql,
    validate_window,
)
from ..session import cut_lineage
from ..sources.schemas import require_columns

# Side codes (ASCII 'B' and 'S'); other codes are on neither side.
BUY = 66
SELL = 83
SIDES = {"buy": BUY, "sell": SELL}

# Grid points expanded per generated array; bounds the size of any one array in a task.
GRID_BLOCK = 4096
# Grid points per window partition of one price level; bounds the rows any one window task
# sorts, however many orders share the level.
CHUNK_POINTS = 65536

BOOK_COLUMNS = ("created", "destroyed", "side", "price", "quantity")


# ---------------------------------------------------------------------------------------------
# Row-level steps
# ---------------------------------------------------------------------------------------------

def _resolved_destroyed() -> str:
    return f"CASE WHEN destroyed = 0 THEN {end_of_day_sql('created')} ELSE destroyed END"


def fill_open_orders(df: DataFrame) -> DataFrame:
    """``destroyed == 0`` becomes 23:59:59.999 of the creation day (UTC)."""
    return df.withColumn("destroyed", F.expr(_resolved_destroyed()))


def live_orders(df: DataFrame, start, end) -> DataFrame:
    """P4 then F2: orders with ``created <= end`` and (resolved) ``destroyed > start``.

    A superset predicate on the stored columns comes first so that Parquet row groups are
    skipped at the scan; the exact test follows the resolution of open orders.
    """
    start_ms, end_ms, _ = validate_window(start, end, 1)
    stored = df.where(f"created <= ({end_ms}L) AND (destroyed > ({start_ms}L) OR destroyed = 0)")
    return fill_open_orders(stored).where(f"destroyed > ({start_ms}L)")


def side_orders(df: DataFrame, side: int | str) -> DataFrame:
    """orders of one side (66 / ``'buy'`` or 83 / ``'sell'``)."""
    code = SIDES[side] if isinstance(side, str) else int(side)
    return df.where(F.col("side") == F.lit(code))


def with_grid_bounds(df: DataFrame, start: int, end: int, interval: int, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Adds ``lo`` / ``hi``: first and last grid point in ``[start, end)`` where the order is
    live; rows without any such point are dropped.  All-integer (E3)."""
    first = f"greatest(({start}L), {ceil_to_grid_sql('created', start, interval)}) AS `{lo}`"
    last = f"{floor_to_grid_sql(f'(least(destroyed, ({end}L)) - 1)', start, interval)} AS `{hi}`"
    return df.selectExpr("*", first, last).where(f"`{lo}` <= `{hi}`")


def explode_grid(df: DataFrame, lo: str, hi: str, interval: int, out: str = "timestamp",
                 spread: str | None = None) -> DataFrame:
    """One row per grid point from ``lo`` to ``hi`` (inclusive, step ``interval``; ``lo <= hi``).

    Two generators: first the blocks of :data:`GRID_BLOCK` points, then the points of each
    block, so a long run never becomes one huge array.  With ``spread`` the block rows are
    dealt to all tasks before the second generator, so one long run is expanded by many of them:
    ``"hash"`` deals by all columns (for runs that are distinct), ``"round"`` in turn (also for
    equal rows, which a hash would send to one task).
    """
    span = interval * GRID_BLOCK
    blocked = df.selectExpr(
        "*", f"explode(sequence(0L, ({hi} - {lo} - pmod({hi} - {lo}, {span}L)) DIV {span}L)) AS _blk"
    ).selectExpr("*", f"{lo} + _blk * {span}L AS _blk_lo")
    if spread:
        # a number given here is kept: joining partitions by their bytes would undo the dealing, as a
        # block row becomes up to GRID_BLOCK rows
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        blocked = blocked.repartition(n, *(blocked.columns if spread == "hash" else ()))
    points = f"explode(sequence(_blk_lo, least({hi}, _blk_lo + {span - interval}L), {interval}L)) AS {out}"
    keep = [f"`{c}`" for c in df.columns]
    return blocked.selectExpr(*keep, points)


# ---------------------------------------------------------------------------------------------
# Operators
# ---------------------------------------------------------------------------------------------

def book_orders(df: DataFrame, start, end) -> DataFrame:
    """The live buy and sell orders of the range: P1, P4, F2 and F3 in one pass."""
    require_columns(df, *BOOK_COLUMNS)
    live = live_orders(df.select(*BOOK_COLUMNS), start, end)
    return live.where(F.col("side").isin(BUY, SELL))


def grid_expand(df: DataFrame, start, end, interval) -> DataFrame:
    """G1: one row per (order, grid point where it is live); keeps the order's columns and adds
    ``timestamp``.  Open orders are resolved first; all side codes are kept.

    The orders' blocks of grid points are dealt in turn before they are expanded, so a task makes about the
    same number of rows whether the points belong to one order or to many, equal orders included."""
    start_ms, end_ms, iv = validate_window(start, end, interval, integral=True)
    live = live_orders(df, start_ms, end_ms)
    bounded = with_grid_bounds(live, start_ms, end_ms, iv, lo="_grid_lo", hi="_grid_hi")
    return explode_grid(bounded, "_grid_lo", "_grid_hi", iv, spread="round").drop("_grid_lo", "_grid_hi")


def depth_by_price(df: DataFrame, start, end, interval, chunk_points: int = CHUNK_POINTS) -> DataFrame:
    """A2: live quantity per ``(timestamp, side, price)``; buy and sell sides only.

    Output columns ``timestamp`` (bigint), ``side`` (int), ``price`` (int), ``quantity``
    (bigint; null only when every live order at that price has a null quantity).

    Each price level's timeline is cut into chunks of ``chunk_points`` grid points.  The running
    sums are taken per (level, chunk), seeded with the state carried in from earlier chunks (a
    prefix sum over per-chunk totals), so no window partition holds more than
    ``chunk_points + 1`` rows, however hot the level.  Stretches of chunks without any change
    become single runs.
    """
    start_ms, end_ms, iv = validate_window(start, end, interval, integral=True)
    if chunk_points < 1:
        raise ValueError("chunk_points must be positive")
    orders = with_grid_bounds(book_orders(df, start_ms, end_ms), start_ms, end_ms, iv)

    # change events, pre-aggregated map-side: one row per (level, grid point) per map task.
    # Written as SQL text: one parsed projection instead of dozens of column calls.
    span = iv * chunk_points
    # explode of a plain array plus an ordinary filter (no lambda, which would fall back to
    # interpreted evaluation): scan to partial aggregate stays one whole-stage-codegen stage
    events = orders.selectExpr(
        "side", "price",
        "explode(array("
        "named_struct('t', lo, 'dq', CAST(quantity AS BIGINT), 'dn', 1L,"
        " 'dv', IF(quantity IS NULL, 0L, 1L)),"
        f"named_struct('t', hi + {iv}L, 'dq', -CAST(quantity AS BIGINT), 'dn', -1L,"
        " 'dv', IF(quantity IS NULL, 0L, -1L)))) AS e",
    ).selectExpr("side", "price", "e.t AS t", "e.dq AS dq", "e.dn AS dn", "e.dv AS dv").where(f"t < ({end_ms}L)")
    steps = (
        events.groupBy("side", "price", "t")
        .agg(F.expr("sum(dq) AS dq"), F.expr("sum(dn) AS dn"), F.expr("sum(dv) AS dv"))
        .selectExpr("side", "price", "t", "dq", "dn", "dv",
                    f"(t - ({start_ms}L) - pmod(t - ({start_ms}L), {span}L)) DIV {span}L AS chunk")
    )

    def chunk_start(c: Column) -> Column:
        return F.lit(start_ms) + c * F.lit(span)

    n_chunks = max(1, -(-(end_ms - start_ms) // span))
    within = steps
    gaps = None
    if n_chunks > 1:
        # state carried into each chunk: prefix sums over per-chunk totals (levels x chunks rows)
        totals = steps.groupBy("side", "price", "chunk").agg(
            F.sum("dq").alias("tq"), F.sum("dn").alias("tn"), F.sum("dv").alias("tv")
        )
        by_chunk = Window.partitionBy("side", "price").orderBy("chunk")
        before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
        upto = by_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        zero = F.lit(0).cast("long")
        carry = totals.select(
            "side", "price", "chunk",
            F.coalesce(F.sum("tq").over(before), zero).alias("cq"),
            F.coalesce(F.sum("tn").over(before), zero).alias("cn"),
            F.coalesce(F.sum("tv").over(before), zero).alias("cv"),
            F.sum("tq").over(upto).alias("eq"),
            F.sum("tn").over(upto).alias("en"),
            F.sum("tv").over(upto).alias("ev"),
            F.lead("chunk").over(by_chunk).alias("next_chunk"),
        )
        # a seed row at each chunk start carries the incoming state into the chunk's window
        seeds = carry.where(F.col("cn") > 0).select(
            "side", "price", "chunk", chunk_start(F.col("chunk")).alias("t"),
            F.col("cq").alias("dq"), F.col("cn").alias("dn"), F.col("cv").alias("dv"),
        )
        within = within.unionByName(seeds)
        # chunks with no change at all inside a live stretch: one run from the next chunk's start
        gap_lo = chunk_start(F.col("chunk") + 1)
        gap_end = F.least(chunk_start(F.coalesce(F.col("next_chunk"), F.lit(n_chunks))), F.lit(end_ms))
        gaps = carry.where((F.col("en") > 0) & (gap_lo < gap_end)).select(
            "side", "price", gap_lo.alias("lo"), F.col("eq").alias("qty"), F.col("en").alias("n_live"),
            F.col("ev").alias("n_valued"), floor_to_grid(gap_end - 1, start_ms, iv).alias("hi"),
        )

    level = "PARTITION BY side, price, chunk ORDER BY t"
    running = f"OVER ({level} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    runs = within.selectExpr(
        "side", "price", "t AS lo",
        f"sum(dq) {running} AS qty",
        f"sum(dn) {running} AS n_live",
        f"sum(dv) {running} AS n_valued",
        f"coalesce(lead(t) OVER ({level}), least(({start_ms}L) + (chunk + 1) * {span}L, ({end_ms}L))) AS next_t",
    ).where("n_live > 0").selectExpr(
        "side", "price", "lo", "qty", "n_live", "n_valued",
        f"next_t - 1 - pmod(next_t - 1 - ({start_ms}L), {iv}L) AS hi",
    )
    if gaps is not None:
        runs = runs.unionByName(gaps)

    spread = "hash" if (end_ms - start_ms) // iv > 4 * GRID_BLOCK else None
    expanded = explode_grid(runs.where(F.col("lo") <= F.col("hi")), "lo", "hi", iv, spread=spread)
    return expanded.select(
        "timestamp", "side", "price", F.when(F.col("n_valued") > 0, F.col("qty")).alias("quantity")
    )


def _levels(side: Column | None = None) -> Column:
    # sort_array (no comparator lambda, so no interpreted fallback); collect_list drops nulls,
    # so every element is a (price, quantity) struct and the order is price, then quantity
    level = F.struct(F.col("price"), F.col("quantity"))
    return F.sort_array(F.collect_list(level if side is None else F.when(side, level)))


def side_curve(depth: DataFrame, side: int | str) -> DataFrame:
    """A3 + O2 for one side: ``timestamp``, ``curve_<side>`` = array of (price, quantity),
    price ascending, for every grid point where the side has a live order."""
    code = SIDES[side] if isinstance(side, str) else int(side)
    name = {BUY: "curve_buy", SELL: "curve_sell"}.get(code, f"curve_{code}")
    return side_orders(depth, code).groupBy("timestamp").agg(_levels().alias(name))


def liquidity_curve(df: DataFrame, start, end, interval, sort: bool = True, checkpoint: bool = False) -> DataFrame:
    """The two-sided curve: ``timestamp``, ``curve_buy``, ``curve_sell`` (J1 semantics).

    One aggregation over the depth builds both sides at once; requiring both arrays to be
    non-empty gives exactly the inner join of the two one-sided curves on ``timestamp``
    without scanning and expanding the input twice.  ``checkpoint=True`` materialises the depth
    in the shared checkpoint folder first, so a lost executor in the curve stages never sends
    the job back to the scan.
    """
    depth = depth_by_price(df, start, end, interval)
    if checkpoint:
        depth = cut_lineage(depth)
    side = F.col("side")
    out = (
        depth.groupBy("timestamp")
        .agg(_levels(side == F.lit(BUY)).alias("curve_buy"), _levels(side == F.lit(SELL)).alias("curve_sell"))
        .where((F.size("curve_buy") > 0) & (F.size("curve_sell") > 0))
    )
    return out.orderBy("timestamp") if sort else out


def curve_text(curve: Column) -> Column:
    """A curve array as text ``price:quantity,...`` (for display and SQL comparison)."""
    return F.array_join(
        F.transform(curve, lambda x: F.concat(x["price"].cast("string"), F.lit(":"), x["quantity"].cast("string"))),
        ",",
    )
