"""The driver contract, checked on the smallest scale against the DuckDB oracles."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(E._QUERIES) == set(E._ORACLES)
    if not E._LLM:
        assert set(q) == set(E._QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["timestamp", "curve_buy", "curve_sell"]
    assert df.count() >= 0


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("name", [
    "event_count", "import_orders", "import_identifiers", "parent_names", "parse_time_param",
    "filter_live_orders", "grid_expand", "depth_by_price", "liquidity_curve", "search_datasets",
    "dataset_parents", "resolve_inputs", "current_datasets", "run_event_count", "missing_inputs",
    "import_cancels_roundtrip", "import_trades_roundtrip", "import_partitioned_roundtrip", "stream_import_roundtrip",
    "depth_long", "catalog_features", "catalog_after_drops", "event_count_order", "liquidity_curve_order",
    "event_count_by_day", "grid_expand_one_order", "dataset_parent_pages", "catalog_snapshot_tail", "catalog_two_writers",
    "catalog_row_stamps", "orphan_folders", "import_many_sources",
])
def test_query_matches_oracle(spark, name):
    con = duck(SF)
    assert compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)


@pytest.mark.parametrize("quantity, dtype", [(1000.0, "bigint"), (2.0e9, "decimal(38,0)")])
def test_level_sums_beyond_a_bigint(spark, workdir, quantity, dtype):
    spark.sql(f"""SELECT 1L AS l_orderkey, 7L AS l_partkey, 1L AS l_suppkey, 1 AS l_linenumber, {quantity}D AS l_quantity,
                         'A' AS l_returnflag, TIMESTAMP_NTZ'1995-01-02 00:00:00' AS l_shipdate""").write.parquet(f"{workdir}/lineitem.parquet")
    spark.sql("SELECT 1L AS o_orderkey, 1L AS o_custkey, TIMESTAMP_NTZ'1995-01-01 00:00:00' AS o_orderdate"
              ).write.parquet(f"{workdir}/orders.parquet")
    df = E.q_grid_expand_one_order(spark, workdir)
    points = range(E.CURVE_START, E.CURVE_END, E.LONG_INTERVAL)
    q = int(quantity)
    assert dict(df.dtypes)["checksum"] == dtype
    assert [tuple(map(int, r)) for r in df.collect()] == [
        (66, 7, len(points), points[0], points[-1], q * len(points), sum(q * (t % 1000003) for t in points))]


FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF", "MapInArrow",
             "FlatMapGroupsInArrow", "FlatMapCoGroupsInArrow", "FlatMapCoGroupsInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_no_python_or_cartesian_nodes_in_any_plan(spark):
    for name, fn in E._QUERIES.items():
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        bad = [f for f in FORBIDDEN if f in plan]
        assert not bad, (name, bad)
