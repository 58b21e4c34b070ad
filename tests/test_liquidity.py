from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quoteline.operators import liquidity as liq

BOOK = "created long, destroyed long, side int, price int, quantity int"

# start 1000, end 1300, interval 100 (grid 1000, 1100, 1200)
EXAMPLE = [
    (1000, 1250, 66, 10, 5),   # on the grid
    (1050, 1250, 66, 10, 7),   # off the grid
    (850, 1150, 83, 12, 3),    # before start, off the grid
    (800, 1250, 83, 11, 4),    # before start, on the grid
    (1100, 0, 66, 9, 2),       # open order
    (1300, 1500, 83, 11, 9),   # created at end
    (900, 1000, 66, 10, 8),    # destroyed at start
    (1000, 1250, 78, 10, 6),   # other side code
]


def _depth_naive(df, start, end, iv):
    """Depth the direct way: every order expanded to its grid points, then summed."""
    orders = liq.with_grid_bounds(liq.book_orders(df, start, end), start, end, iv)
    return liq.explode_grid(orders, "lo", "hi", iv).groupBy("timestamp", "side", "price").agg(
        F.sum(F.col("quantity").cast("long")).alias("quantity"))


def _curve_rows(df):
    return [
        (r["timestamp"], [(x["price"], x["quantity"]) for x in r["curve_buy"]],
         [(x["price"], x["quantity"]) for x in r["curve_sell"]])
        for r in df.collect()
    ]


def test_worked_example(spark):
    df = spark.createDataFrame(EXAMPLE, BOOK)
    got = _curve_rows(liq.liquidity_curve(df, 1000, 1300, 100))
    assert got == [
        (1000, [(10, 5)], [(11, 4), (12, 3)]),
        (1100, [(9, 2), (10, 12)], [(11, 4), (12, 3)]),
        (1200, [(9, 2), (10, 12)], [(11, 4)]),
    ]


def test_checkpointed_curve_is_equal(spark):
    df = spark.createDataFrame(EXAMPLE, BOOK)
    plain = _curve_rows(liq.liquidity_curve(df, 1000, 1300, 100))
    cut = liq.liquidity_curve(df, 1000, 1300, 100, checkpoint=True)
    assert "LogicalRDD" in cut._jdf.queryExecution().optimizedPlan().toString()
    assert _curve_rows(cut) == plain


def test_curve_types(spark):
    df = spark.createDataFrame(EXAMPLE, BOOK)
    out = liq.liquidity_curve(df, 1000, 1300, 100)
    assert out.schema["curve_buy"].dataType.elementType.simpleString() == "struct<price:int,quantity:bigint>"
    assert out.columns == ["timestamp", "curve_buy", "curve_sell"]


def test_one_sided_points_dropped_from_two_sided_curve(spark):
    df = spark.createDataFrame([(1000, 1100, 66, 1, 1), (1000, 1300, 83, 2, 1)], BOOK)
    got = _curve_rows(liq.liquidity_curve(df, 1000, 1300, 100))
    assert [t for t, _, _ in got] == [1000]
    sell = liq.side_curve(liq.depth_by_price(df, 1000, 1300, 100), "sell")
    assert sorted(r["timestamp"] for r in sell.collect()) == [1000, 1100, 1200]


def test_open_order_ends_at_end_of_utc_day(spark):
    day = 86400000
    df = spark.createDataFrame([(3 * day + 10, 0, 66, 1, 1)], BOOK)
    filled = liq.fill_open_orders(df).collect()[0]
    assert filled["destroyed"] == 4 * day - 1
    grid = liq.grid_expand(df, 3 * day, 5 * day, day // 4)
    assert sorted(r["timestamp"] for r in grid.collect()) == [3 * day + k * day // 4 for k in (1, 2, 3)]


def test_live_filter_resolves_open_orders_first(spark):
    df = spark.createDataFrame([(500, 0, 66, 1, 1), (500, 900, 66, 1, 1), (2000, 3000, 83, 1, 1)], BOOK)
    got = liq.live_orders(df, 1000, 1500).collect()
    assert [(r["created"], r["destroyed"]) for r in got] == [(500, 86399999)]


def test_quantity_nulls_and_zero(spark):
    df = spark.createDataFrame(
        [(1000, 1200, 66, 5, None), (1000, 1100, 66, 5, 3), (1000, 1200, 66, 6, 0), (1000, 1200, 83, 7, None)], BOOK
    )
    got = {(r["timestamp"], r["side"], r["price"]): r["quantity"]
           for r in liq.depth_by_price(df, 1000, 1300, 100).collect()}
    assert got == {(1000, 66, 5): 3, (1100, 66, 5): None, (1000, 66, 6): 0, (1100, 66, 6): 0,
                   (1000, 83, 7): None, (1100, 83, 7): None}


def brute_depth(rows, start, end, iv):
    """Straight from the definition: every grid point, every order."""
    out = defaultdict(lambda: [0, 0])
    for created, destroyed, side, price, qty in rows:
        if created is None or destroyed is None or side not in (66, 83):
            continue
        if destroyed == 0:
            destroyed = created - created % 86400000 + 86399999
        if not (created <= end and destroyed > start):
            continue
        for t in range(start, end, iv):
            if created <= t < destroyed:
                acc = out[(t, side, price)]
                acc[0] += 1
                if qty is not None:
                    acc[1] += qty
    return {k: v[1] for k, v in out.items()}


order = st.tuples(
    st.one_of(st.none(), st.integers(-300, 2600)),
    st.one_of(st.none(), st.just(0), st.integers(-300, 3000)),
    st.sampled_from([66, 83, 78]),
    st.integers(0, 4),
    st.integers(0, 50),
).map(lambda o: (o[0], (o[0] + abs(o[1]) if (o[1] and o[0] is not None) else o[1]), o[2], o[3], o[4]))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.too_slow, HealthCheck.function_scoped_fixture])
@given(rows=st.lists(order, max_size=30), start=st.integers(-200, 500), span=st.integers(0, 2500),
       iv=st.integers(1, 400))
def test_depth_equals_brute_force(spark, rows, start, span, iv):
    end = start + span
    df = spark.createDataFrame(rows, BOOK)
    got = {(r["timestamp"], r["side"], r["price"]): r["quantity"]
           for r in liq.depth_by_price(df, start, end, iv).collect()}
    assert got == brute_depth(rows, start, end, iv)
    for chunk in (1, 3):
        chunked = {(r["timestamp"], r["side"], r["price"]): r["quantity"]
                   for r in liq.depth_by_price(df, start, end, iv, chunk_points=chunk).collect()}
        assert chunked == got, chunk
    naive = {(r["timestamp"], r["side"], r["price"]): r["quantity"]
             for r in _depth_naive(df, start, end, iv).collect()}
    assert naive == got


def test_long_runs_expand_across_blocks(spark):
    iv = 1
    n = liq.GRID_BLOCK * 2 + 17
    df = spark.createDataFrame([(0, n, 66, 1, 2), (5, n - 3, 83, 1, 1)], BOOK)
    depth = liq.depth_by_price(df, 0, n, iv)
    counts = {r["side"]: r["n"] for r in depth.groupBy("side").agg(F.count("*").alias("n")).collect()}
    assert counts == {66: n, 83: n - 8}
    grid = liq.grid_expand(df, 0, n, iv)
    assert grid.count() == n + n - 8


def test_hot_level_long_grid_is_split(spark):
    # one price level holds almost all orders; long-lived orders leave change-free stretches
    rows = [(k * 7, k * 7 + 5000, 66, 1, 1) for k in range(300)] + [(0, 20000, 83, 2, 3), (15000, 0, 66, 3, 4)]
    df = spark.createDataFrame(rows, BOOK)
    expect = brute_depth(rows, 0, 20000, 10)
    for chunk in (3, 64, liq.CHUNK_POINTS):
        got = {(r["timestamp"], r["side"], r["price"]): r["quantity"]
               for r in liq.depth_by_price(df, 0, 20000, 10, chunk_points=chunk).collect()}
        assert got == expect, chunk


def test_spread_expansion_matches(spark):
    n = liq.GRID_BLOCK * 5 + 3
    df = spark.createDataFrame([(0, n, 66, 1, 2)], BOOK)
    depth = liq.depth_by_price(df, 0, n, 1)
    assert depth.count() == n
    assert depth.agg({"timestamp": "max"}).collect()[0][0] == n - 1


def test_plan_stays_in_the_jvm(spark):
    df = spark.createDataFrame(EXAMPLE, BOOK)
    plan = liq.liquidity_curve(df, 1000, 1300, 100)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_boundaries(spark):
    # grid 1000, 1100, 1200 (end 1300)
    rows = [
        (1000, 1100, 66, 1, 1),   # created = start, destroyed on a grid point: live at 1000 only
        (1100, 1200, 66, 2, 1),   # created on the grid: live at 1100 only
        (1300, 1400, 66, 3, 1),   # created = end: never on the grid
        (1299, 1400, 66, 4, 1),   # created just before end: no grid point left
        (999, 1000, 66, 5, 1),    # destroyed = start: gone at 1000
        (1200, 1201, 66, 6, 1),   # short life on the last point
    ]
    df = spark.createDataFrame(rows, BOOK)
    got = sorted((r["timestamp"], r["price"]) for r in liq.depth_by_price(df, 1000, 1300, 100).collect())
    assert got == [(1000, 1), (1100, 2), (1200, 6)]
    assert sorted((r["timestamp"], r["price"]) for r in liq.grid_expand(df, 1000, 1300, 100).collect()) == got


def test_negative_epoch(spark):
    rows = [(-250, -50, 66, 1, 2), (-150, 0, 83, 2, 3)]   # the open order ends at -1 (end of 1969-12-31)
    df = spark.createDataFrame(rows, BOOK)
    got = {(r["timestamp"], r["side"], r["price"]): r["quantity"]
           for r in liq.depth_by_price(df, -300, 100, 100).collect()}
    assert got == brute_depth(rows, -300, 100, 100) == {(-200, 66, 1): 2, (-100, 66, 1): 2, (-100, 83, 2): 3}


def test_event_generator_stays_in_generated_code(spark, workdir):
    import re

    spark.createDataFrame(EXAMPLE, BOOK).write.parquet(f"{workdir}/book")
    df = liq.liquidity_curve(spark.read.parquet(f"{workdir}/book"), 1000, 1300, 100)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"\*\(\d+\) Generate explode\(array\(", plan), plan
    assert re.search(r"\*\(\d+\) Generate explode\(sequence\(", plan), plan


def test_grid_expand_keeps_caller_columns(spark):
    df = spark.createDataFrame([(1000, 1250, 66, 10, 5, "x", 7, 8)], BOOK + ", note string, lo int, hi int")
    out = liq.grid_expand(df, 1000, 1300, 100)
    assert out.columns == ["created", "destroyed", "side", "price", "quantity", "note", "lo", "hi", "timestamp"]
    assert sorted((r["timestamp"], r["lo"], r["hi"]) for r in out.collect()) == [(1000, 7, 8), (1100, 7, 8), (1200, 7, 8)]


def _rows_by_task(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


@pytest.mark.parametrize("orders, points", [(1, 300_000), (20_000, 20)])
def test_grid_points_are_dealt_over_all_tasks(spark, orders, points):
    """One order over the whole grid, or many equal orders of one task: no task expands twice its share."""
    book = spark.range(orders).coalesce(1).selectExpr(
        "0L AS created", f"{points}L AS destroyed", "66 AS side", "10 AS price", "1 AS quantity")
    got = liq.grid_expand(book, 0, points, 1)
    tasks = _rows_by_task(got)
    assert sum(tasks) == orders * points
    assert max(tasks) < 2 * sum(tasks) / int(spark.conf.get("spark.sql.shuffle.partitions"))
