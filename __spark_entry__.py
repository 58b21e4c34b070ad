"""

Every query reads the given tables (or data Spark derives from them) in full.  Each oracle is
an independent DuckDB formulation of the same result over the same Parquet tables: range joins
instead of generated grids, ``string_agg`` instead of array sorting, ``row_number`` instead of
``max`` over structs, ``epoch_us(..) // 1000`` for millisecond truncation.
"""

from __future__ import annotations

import datetime
import importlib.util
import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the package sits next to this file; make it importable from any working directory
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from quoteline.functions.paths import base_name_col, dataset_name_col, identifier_col  # noqa: E402
from quoteline.functions.timegrid import (  # noqa: E402
    epoch_ms,
    epoch_ms_ntz_sql,
    format_time_sql,
    parse_time_sql,
)
from quoteline.operators import catalog as cat  # noqa: E402
from quoteline.operators import liquidity as liq  # noqa: E402
from quoteline.operators.event_count import event_count, time_range  # noqa: E402
from quoteline.operators.ordering import with_positions  # noqa: E402
from quoteline.plans.runner import register_builtin_modules, run_analysis, sql_over  # noqa: E402
from quoteline.session import cut_lineage, scratch_path  # noqa: E402
from quoteline.sources import bookmap  # noqa: E402
from quoteline.sources.importing import import_dataset  # noqa: E402
from quoteline.sources.registry import Catalog  # noqa: E402
from quoteline.sources.sinks import orphan_folders, save_by_day, save_dataset, save_features  # noqa: E402
from quoteline.streaming.ingest import ingest_table  # noqa: E402

# Fixed query parameters (epoch ms).  Event count: 2024-01-01 00:00:00.500 to 2024-01-21, hourly.
EVENTS_START, EVENTS_END, EVENTS_INTERVAL = 1704067200500, 1705795200000, 3600000
# Curve: 1996-01-01 to 1996-03-01, every six hours.
CURVE_START, CURVE_END, CURVE_INTERVAL = 820454400000, 825638400000, 21600000
LONG_INTERVAL = 75000  # over the same range: 69,120 grid points
FEATURE_PARAMS = {"start_time": EVENTS_START, "end_time": EVENTS_END, "interval": EVENTS_INTERVAL, "time_column": "ts"}
SEARCH_PATTERN = "RED"
MODULE_PATTERN = "a"
PARENTS_A_PAGE = 8  # most parts have more suppliers than that
N_SOURCES = 300
FLAGSHIP_DIR = "/root/testdata/sf0.001"


# ---------------------------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------------------------

def _events(spark, d):
    return bookmap.table(spark, d, "events")


def q_event_count(spark: SparkSession, d: str) -> DataFrame:
    return event_count(_events(spark, d), EVENTS_START, EVENTS_END, EVENTS_INTERVAL, time_col="ts")


def q_scan_orders(spark, d):
    return bookmap.book_orders(spark, d).select(*liq.BOOK_COLUMNS)


def q_import_orders(spark, d):
    return bookmap.book_orders(spark, d)


def q_import_cancels(spark, d):
    return bookmap.book_cancels(spark, d)


def q_import_trades(spark, d):
    return bookmap.book_trades(spark, d)


def q_import_identifiers(spark, d):
    ident = identifier_col(F.col("url"))
    return bookmap.table(spark, d, "pages").select(
        "page_id", ident.alias("identifier"), dataset_name_col(ident, "ORDERS").alias("dataset_name")
    )


def q_parent_names(spark, d):
    return bookmap.table(spark, d, "pages").select("page_id", base_name_col(F.col("url")).alias("name"))


def q_parse_time_param(spark, d):
    # every event time written as a time parameter, then read back
    ev = _events(spark, d)
    text = ev.selectExpr("event_id", f"{format_time_sql(epoch_ms_ntz_sql('ts'))} AS param")
    return text.selectExpr("event_id", "param", f"{parse_time_sql('param')} AS epoch_ms")


def q_filter_time_range(spark, d):
    return time_range(bookmap.book_orders(spark, d).select("id", "created"), CURVE_START, CURVE_END)


def q_sql_time_range(spark, d):
    # F1 written as the module author's SQL over a DataFrame, parameters bound by Spark
    return sql_over(
        spark, {"ORDERS": bookmap.book_orders(spark, d)},
        "SELECT id, created FROM {ORDERS} WHERE created >= :start AND created < :end",
        {"start": CURVE_START, "end": CURVE_END},
    )


def q_filter_live_orders(spark, d):
    return liq.live_orders(q_scan_orders(spark, d), CURVE_START, CURVE_END)


def q_filter_side_buy(spark, d):
    return liq.side_orders(q_scan_orders(spark, d), "buy")


def q_filter_side_sell(spark, d):
    return liq.side_orders(q_scan_orders(spark, d), "sell")


def q_fill_open_orders(spark, d):
    return liq.fill_open_orders(bookmap.book_orders(spark, d).select("id", "created", "destroyed"))


def q_grid_expand(spark, d):
    return liq.grid_expand(q_scan_orders(spark, d), CURVE_START, CURVE_END, CURVE_INTERVAL).select(
        "created", "side", "price", "quantity", "timestamp"
    )


def q_grid_expand_long(spark, d):
    # more than 65,536 grid points; every expanded row is counted and summed by price level
    return _level_sums(liq.grid_expand(q_scan_orders(spark, d), CURVE_START, CURVE_END, LONG_INTERVAL))


def q_depth_by_price(spark, d):
    return liq.depth_by_price(bookmap.curve_orders(spark, d, CURVE_END), CURVE_START, CURVE_END, CURVE_INTERVAL)


def q_depth_long(spark, d):
    # more than 65,536 grid points: several chunks a price level
    return _level_sums(liq.depth_by_price(bookmap.curve_orders(spark, d, CURVE_END), CURVE_START, CURVE_END, LONG_INTERVAL))


def _level_sums(rows):
    """Count, time range and sums of each price level.  The checksum is summed in two parts, so no sum on the way is
    beyond a bigint; it is a bigint, as in the SQL, unless a level's exact sum is beyond one (the SQL then has no
    value): then the column is a decimal(38,0)."""
    term, low_bits = F.col("quantity") * F.pmod(F.col("timestamp").cast("bigint"), F.lit(1000003)), 24
    parts = rows.groupBy("side", "price").agg(
        F.count(F.lit(1)).alias("n_points"), F.min("timestamp").alias("first_ms"), F.max("timestamp").alias("last_ms"),
        F.sum("quantity").alias("quantity"), F.sum(F.shiftright(term, low_bits)).alias("high"),
        F.sum(term.bitwiseAND(F.lit((1 << low_bits) - 1))).alias("low"))
    exact = F.expr(f"CAST(CAST(high AS DECIMAL(38,0)) * {1 << low_bits} + low AS DECIMAL(38,0))")
    sums = cut_lineage(parts.withColumn("checksum", exact).drop("high", "low"))  # a row a price level
    if sums.where(~F.col("checksum").between(-(1 << 63), (1 << 63) - 1)).isEmpty():
        sums = sums.withColumn("checksum", F.col("checksum").cast("bigint"))
    return sums


def _side_curve_text(spark, d, side):
    depth = q_depth_by_price(spark, d)
    curve = liq.side_curve(depth, side)
    name = f"curve_{side}"
    return curve.select("timestamp", liq.curve_text(F.col(name)).alias(name))


def q_curve_buy(spark, d):
    return _side_curve_text(spark, d, "buy")


def q_curve_sell(spark, d):
    return _side_curve_text(spark, d, "sell")


def q_liquidity_curve(spark, d):
    curve = liq.liquidity_curve(bookmap.curve_orders(spark, d, CURVE_END), CURVE_START, CURVE_END, CURVE_INTERVAL)
    return curve.select(
        "timestamp",
        liq.curve_text(F.col("curve_buy")).alias("curve_buy"),
        liq.curve_text(F.col("curve_sell")).alias("curve_sell"),
    )


def _catalog(spark, d):
    return (bookmap.catalog_datasets(spark, d), bookmap.catalog_analyses(spark, d), bookmap.catalog_lineage(spark, d))


def q_search_datasets(spark, d):
    datasets, analyses, lineage = _catalog(spark, d)
    return cat.search_datasets(datasets, analyses, lineage, SEARCH_PATTERN)


def q_dataset_listing(spark, d):
    datasets, analyses, lineage = _catalog(spark, d)
    listing = cat.dataset_listing(datasets, analyses, lineage, SEARCH_PATTERN)
    return listing.select("id", "name", "module_name", F.array_join("parent_names", "|").alias("parents"))


def q_search_modules(spark, d):
    return cat.search_modules(bookmap.catalog_analyses(spark, d), MODULE_PATTERN).select("id", "name")


def _datasets_lineage(spark, d):
    return bookmap.catalog_datasets(spark, d), bookmap.catalog_lineage(spark, d)


def q_dataset_parents(spark, d):
    datasets, lineage = _datasets_lineage(spark, d)
    return cat.dataset_parents(datasets, lineage).select(
        "id", "name", F.array_join("parent_names", "|").alias("parents"), "n_parents"
    )


def q_dataset_parent_edges(spark, d):
    datasets, lineage = _datasets_lineage(spark, d)
    return cat.parent_edges(datasets, lineage)


def q_dataset_derived(spark, d):
    datasets, lineage = _datasets_lineage(spark, d)
    return cat.dataset_derived(datasets, lineage)


def q_resolve_inputs(spark, d):
    # The requested inputs are the datasets of every part that appears in an order line.
    datasets = bookmap.catalog_datasets(spark, d)
    # distinct first: a partial aggregate collapses a hot part key map-side, before the semi join
    used = bookmap.table(spark, d, "lineitem").select(F.col("l_partkey").alias("id")).distinct()
    wanted = datasets.join(used, "id", "left_semi").select("name")
    return cat.resolve_inputs(datasets.select("name", "id"), wanted)


def _asked_names(spark, d):
    """Requested names, many of them repeated and some unknown: one for each order line by part, and one for
    each by supplier that no part has."""
    lines = bookmap.table(spark, d, "lineitem")
    names = bookmap.catalog_datasets(spark, d).select("id", "name")
    known = lines.select(F.col("l_partkey").alias("id")).join(names, "id").select("name")
    return known.unionByName(lines.select(F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("name")))


def q_missing_inputs(spark, d):
    return cat.missing_inputs(bookmap.catalog_datasets(spark, d), _asked_names(spark, d))


def q_resolve_known_inputs(spark, d):
    datasets = bookmap.catalog_datasets(spark, d).select("name", "id")
    return cat.resolve_inputs(datasets, _asked_names(spark, d), check=False)


def _action_log(spark, d, key: Column):
    ev = _events(spark, d)
    return ev.select(
        key.alias("key"), "ts", "event_id", "event_type", (F.col("event_type") == "error").alias("is_drop")
    )


def _current(log):
    state = cat.latest_state(log, "key", ["ts", "event_id"], F.col("is_drop"), ["ts", "event_id", "event_type"])
    return state.select(
        "key",
        epoch_ms(F.col("ts"), T.TimestampNTZType()).alias("last_ts"),
        F.col("event_id").alias("last_event_id"),
        F.col("event_type").alias("action"),
    )


def q_current_datasets(spark, d):
    # events as a catalogue action log: key = user, an 'error' event drops the key
    return _current(_action_log(spark, d, F.col("user_id").cast("string")))


def q_current_modules(spark, d):
    return _current(_action_log(spark, d, F.col("props")))


# ---- sinks, import and run-by-name: write to a new folder under spark.checkpoint.dir -------

def _fresh_catalog(spark, label):
    root = scratch_path(spark, label)
    return root, Catalog(spark, f"{root}/catalog")


def q_save_dataset_roundtrip(spark, d):
    root, catalog = _fresh_catalog(spark, "save-dataset")
    path = save_dataset(catalog, bookmap.book_orders(spark, d), f"{root}/files", "orders", f"{d}/book.src")
    assert catalog.dataset("book_ORDERS")["filepath"] == path
    return spark.read.parquet(path)


def q_save_features_roundtrip(spark, d):
    root, catalog = _fresh_catalog(spark, "save-features")
    register_builtin_modules(catalog)
    catalog.create_dataset("events", f"{d}/events.parquet", "", fileformat="parquet")
    params = {"start_time": EVENTS_START, "end_time": EVENTS_END, "interval": EVENTS_INTERVAL, "time_column": "ts"}
    counts = event_count(_events(spark, d), EVENTS_START, EVENTS_END, EVENTS_INTERVAL, time_col="ts", sort=False)
    path = save_features(catalog, counts, f"{root}/features", "events_hourly", "EventCount", params, ["events"])
    return spark.read.parquet(path)


def q_import_book_roundtrip(spark, d):
    # The three tables are laid out as a source of per-period files, then imported.
    root, catalog = _fresh_catalog(spark, "import")
    source = f"{root}/incoming/book.src"
    month = F.date_format(F.timestamp_millis(F.col("created")), "yyyy-MM")
    bookmap.book_orders(spark, d).withColumn("month", month).write.partitionBy("month").parquet(f"{source}/ORDERS")
    bookmap.book_cancels(spark, d).write.parquet(f"{source}/CANCELS")
    bookmap.book_trades(spark, d).write.parquet(f"{source}/TRADES")
    written = import_dataset(spark, catalog, [source], f"{root}/files")
    return spark.read.parquet(written["book_ORDERS"])


def _import_one(spark, d, frame, table):
    root, catalog = _fresh_catalog(spark, f"import-{table.lower()}")
    source = f"{root}/incoming/book.src"
    frame.write.parquet(f"{source}/{table}")
    import_dataset(spark, catalog, [source], tables=[table], layout="by_source")
    return spark.read.parquet(catalog.dataset(f"book_{table}")["filepath"])


def q_import_cancels_roundtrip(spark, d):
    return _import_one(spark, d, bookmap.book_cancels(spark, d), "CANCELS")


def q_import_trades_roundtrip(spark, d):
    return _import_one(spark, d, bookmap.book_trades(spark, d), "TRADES")


def q_import_partitioned_roundtrip(spark, d):
    # two sources in one job a table, dealt evenly over tasks; read back by the recorded paths
    root, catalog = _fresh_catalog(spark, "import-many")
    orders = bookmap.book_orders(spark, d)
    buys, rest = f"{root}/incoming/buys.src", f"{root}/incoming/rest.src"
    orders.where("side = 66").write.parquet(f"{buys}/ORDERS")
    orders.where("side <> 66").write.parquet(f"{rest}/ORDERS")
    import_dataset(spark, catalog, [buys, rest], tables=["ORDERS"], partitions=4)
    rows = catalog.known(["buys_ORDERS", "rest_ORDERS"]).inputs(["buys_ORDERS", "rest_ORDERS"])
    parts = [spark.read.parquet(r["filepath"]).withColumn("identifier", F.lit(r["identifier"])) for r in rows.values()]
    return parts[0].unionByName(parts[1])


def _part_catalog(spark, d):
    """A catalogue of every part and of the regions as modules, with one saved feature set whose parents are
    the first and the last part by name."""
    root, catalog = _fresh_catalog(spark, "part-catalog")
    register_builtin_modules(catalog)
    regions = [r["name"] for r in bookmap.catalog_analyses(spark, d).collect()]
    catalog.register_modules([dict(name=n, entrypoint="quoteline.plans.modules:event_count_module") for n in regions])
    parts = bookmap.catalog_datasets(spark, d)
    catalog.record_datasets(parts.select("name", F.concat(F.lit("part/"), F.col("id").cast("string")).alias("filepath")))
    ends = parts.agg(F.min("name").alias("first"), F.max("name").alias("last")).first()
    counts = event_count(_events(spark, d), EVENTS_START, EVENTS_END, EVENTS_INTERVAL, time_col="ts", sort=False)
    save_features(catalog, counts, f"{root}/features", "events_hourly", "EventCount", FEATURE_PARAMS, list(ends))
    return catalog, ends, regions


def q_catalog_features(spark, d):
    # the recorded rows: name, module, parameters and parents
    catalog, _, _ = _part_catalog(spark, d)
    listing = catalog.list_datasets()
    return listing.select("name", "module_name", "module_parameters", F.array_join("parent_names", "|").alias("parents"))


def q_catalog_after_drops(spark, d):
    # one dataset and one module dropped (C7, C8): what is left, and the lineage without the dropped parent
    return _after_drops(*_part_catalog(spark, d))


def _after_drops(catalog, ends, regions):
    catalog.drop_dataset(ends["first"])
    catalog.drop_module(min(regions))
    datasets = catalog.list_datasets().select(F.lit("dataset").alias("kind"), "name", F.array_join("parent_names", "|").alias("parents"))
    return datasets.unionByName(catalog.analyses().select(F.lit("module").alias("kind"), "name", F.lit(None).cast("string").alias("parents")))


def q_event_count_order(spark, d):
    # the sorted result with each row's place in it (O1)
    return with_positions(q_event_count(spark, d))


def q_liquidity_curve_order(spark, d):
    # the sorted curve: place and number of price levels of each grid point (O3)
    curve = liq.liquidity_curve(bookmap.curve_orders(spark, d, CURVE_END), CURVE_START, CURVE_END, CURVE_INTERVAL)
    return with_positions(curve).select("position", "timestamp", F.size("curve_buy").alias("n_buy"), F.size("curve_sell").alias("n_sell"))


def q_grid_expand_one_order(spark, d):
    # one order over the whole long grid, made of all order lines (first creation, quantities summed): its points
    # are dealt over all tasks block by block
    one = bookmap.book_orders(spark, d).agg(
        F.min("created").alias("created"), F.lit(CURVE_END).cast("long").alias("destroyed"), F.lit(liq.BUY).alias("side"),
        F.max("price").alias("price"), F.sum("quantity").alias("quantity"))
    return _level_sums(liq.grid_expand(one, CURVE_START, CURVE_END, LONG_INTERVAL))


def q_dataset_parent_pages(spark, d):
    datasets, lineage = _datasets_lineage(spark, d)
    pages = cat.parent_pages(datasets, lineage, PARENTS_A_PAGE)
    return pages.select("id", "page", F.array_join("parent_names", "|").alias("parents"), "n_parents")


def q_import_many_sources(spark, d):
    # every order line in one of some hundred sources by customer, all buys in one large source; read back by the paths recorded
    root, catalog = _fresh_catalog(spark, "import-sources")
    source = F.when(F.col("side") == liq.BUY, "hot").otherwise(F.concat(F.lit("c"), (F.col("p_id") % N_SOURCES).cast("string")))
    bookmap.book_orders(spark, d).withColumn("src", source).hint("rebalance", "src").write.partitionBy("src").parquet(f"{root}/laid")
    # the sources' own folders: <identifier>.src/ORDERS
    place = spark._jvm.org.apache.hadoop.fs.Path
    fs = place(root).getFileSystem(spark._jsc.hadoopConfiguration())
    sources = []
    for status in fs.listStatus(place(f"{root}/laid")):
        name = status.getPath().getName()
        if name.startswith("src="):
            sources.append(f"{root}/incoming/{name[4:]}.src")
            fs.mkdirs(place(sources[-1]))
            fs.rename(status.getPath(), place(f"{sources[-1]}/ORDERS"))
    import_dataset(spark, catalog, sources, tables=["ORDERS"], partitions=16)
    paths = [r["filepath"] for r in catalog.datasets().select("filepath").collect()]  # one for each source given
    return spark.read.option("basePath", os.path.dirname(paths[0])).parquet(*paths)


def q_event_count_by_day(spark, d):
    # events saved by day, then counted by the module's name: only the days of the range are read
    root, catalog = _fresh_catalog(spark, "events-by-day")
    register_builtin_modules(catalog)
    save_by_day(catalog, _events(spark, d).select("event_id", "ts"), f"{root}/files", "events", f"{root}/log.src", "ts")
    params = {"start_time": EVENTS_START, "end_time": EVENTS_END, "interval": EVENTS_INTERVAL, "time_column": "ts", "day_column": "day"}
    return run_analysis(spark, catalog, "EventCount", params, ["log_EVENTS"])


def q_catalog_snapshot_tail(spark, d):
    # catalog_after_drops read from a snapshot and the log after it
    catalog, ends, regions = _part_catalog(spark, d)
    catalog.snapshot()
    return _after_drops(catalog, ends, regions)


def q_catalog_two_writers(spark, d):
    # two writers check the names of all parts while they are free; the second to record is refused, the first one's rows stay
    root, first = _fresh_catalog(spark, "two-writers")
    second = Catalog(spark, first.root)
    names = bookmap.catalog_datasets(spark, d).select("name")
    second.check_new_datasets(names)
    first.record_datasets(names.withColumn("filepath", F.lit("first")))
    try:
        second.record_datasets(names.withColumn("filepath", F.lit("second")))
        refused = False
    except cat.CatalogError:
        refused = True
    rows = first.log("datasets").groupBy("name").agg(F.count(F.lit(1)).alias("n_rows"), F.min("filepath").alias("filepath"))
    return rows.withColumn("refused", F.lit(refused))


def q_catalog_row_stamps(spark, d):
    # time and id of recorded rows, as far as they are determined: written within this run, every id once
    began = datetime.datetime.now()
    catalog, _, _ = _part_catalog(spark, d)
    rows = catalog.datasets().select("name", "id", "created").unionByName(catalog.analyses().select("name", "id", "created"))
    shared = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    within = F.col("created").between(F.lit(began), F.lit(datetime.datetime.now()))
    return rows.join(shared, "id").select("name", within.alias("in_run"), (F.col("n") == 1).alias("own_id"))


def q_orphan_folders(spark, d):
    # orders saved by side, two of them recorded and one left by a run that died: listed, then saved again over it
    root, catalog = _fresh_catalog(spark, "orphans")
    orders = bookmap.book_orders(spark, d)
    for name, side in (("buys", liq.BUY), ("sells", liq.SELL)):
        save_dataset(catalog, orders.where(F.col("side") == side), f"{root}/files", "orders", f"/in/{name}.src")
    rest = orders.where(~F.col("side").isin(liq.BUY, liq.SELL))
    rest.write.parquet(f"{root}/files/rest/rest_ORDERS.parquet")  # written, never recorded
    lost = orphan_folders(catalog, f"{root}/files").select(F.regexp_extract("folder", "[^/]*$", 0).alias("folder"))
    listed = cut_lineage(lost)  # as it is now
    path = save_dataset(catalog, rest, f"{root}/files", "orders", "/in/rest.src", over_orphan=True)
    left = orphan_folders(catalog, f"{root}/files")
    return (listed.select(F.lit("lost").alias("what"), "folder", F.lit(None).cast("long").alias("n"))
            .unionByName(spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit("saved").alias("what"), F.lit("rest_ORDERS").alias("folder"), "n"))
            .unionByName(left.agg(F.count(F.lit(1)).alias("n")).select(F.lit("still lost").alias("what"), F.lit("").alias("folder"), "n")))


def q_stream_import_roundtrip(spark, d):
    # per-period ORDERS files of two sources picked up by the incremental (streaming) import
    root = scratch_path(spark, "stream-import")
    orders = bookmap.book_orders(spark, d)
    month = F.date_format(F.timestamp_millis(F.col("created")), "yyyy-MM")
    flagged = orders.withColumn("month", month).hint("rebalance", "month")  # a month's rows in few files
    flagged.where(F.col("side") == 66).write.partitionBy("month").parquet(f"{root}/incoming/buys.src/ORDERS")
    flagged.where(F.col("side") != 66).write.partitionBy("month").parquet(f"{root}/incoming/rest.src/ORDERS")
    orders.where(F.col("side").isNull()).write.parquet(f"{root}/incoming/rest.src/ORDERS/nulls")
    query = ingest_table(spark, f"{root}/incoming/*.src", "orders", f"{root}/ORDERS", by_identifier=True)
    query.awaitTermination()
    return spark.read.parquet(f"{root}/ORDERS").drop("identifier", "batch")


def q_run_event_count(spark, d):
    _, catalog = _fresh_catalog(spark, "run-event-count")
    register_builtin_modules(catalog)
    catalog.create_dataset("events", f"{d}/events.parquet", "", fileformat="parquet")
    params = {"start_time": EVENTS_START, "end_time": EVENTS_END, "interval": EVENTS_INTERVAL, "time_column": "ts"}
    return run_analysis(spark, catalog, "EventCount", params, ["events"])


def q_run_liquidity_curve(spark, d):
    root, catalog = _fresh_catalog(spark, "run-liquidity")
    register_builtin_modules(catalog)
    save_dataset(catalog, bookmap.book_orders(spark, d), f"{root}/files", "orders", f"{d}/book.src")
    params = {"start_time": CURVE_START, "end_time": CURVE_END, "interval": CURVE_INTERVAL}
    curve = run_analysis(spark, catalog, "Liquid", params, ["book_ORDERS"])
    return curve.select(
        "timestamp",
        liq.curve_text(F.col("curve_buy")).alias("curve_buy"),
        liq.curve_text(F.col("curve_sell")).alias("curve_sell"),
    )


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "event_count": q_event_count,
    "scan_orders": q_scan_orders,
    "import_orders": q_import_orders,
    "import_cancels": q_import_cancels,
    "import_trades": q_import_trades,
    "import_identifiers": q_import_identifiers,
    "parent_names": q_parent_names,
    "parse_time_param": q_parse_time_param,
    "filter_time_range": q_filter_time_range,
    "sql_time_range": q_sql_time_range,
    "filter_live_orders": q_filter_live_orders,
    "filter_side_buy": q_filter_side_buy,
    "filter_side_sell": q_filter_side_sell,
    "fill_open_orders": q_fill_open_orders,
    "grid_expand": q_grid_expand,
    "depth_by_price": q_depth_by_price,
    "curve_buy": q_curve_buy,
    "curve_sell": q_curve_sell,
    "liquidity_curve": q_liquidity_curve,
    "search_datasets": q_search_datasets,
    "dataset_listing": q_dataset_listing,
    "search_modules": q_search_modules,
    "dataset_parents": q_dataset_parents,
    "dataset_parent_edges": q_dataset_parent_edges,
    "dataset_derived": q_dataset_derived,
    "resolve_inputs": q_resolve_inputs,
    "current_datasets": q_current_datasets,
    "current_modules": q_current_modules,
    "save_dataset_roundtrip": q_save_dataset_roundtrip,
    "save_features_roundtrip": q_save_features_roundtrip,
    "import_book_roundtrip": q_import_book_roundtrip,
    "stream_import_roundtrip": q_stream_import_roundtrip,
    "import_cancels_roundtrip": q_import_cancels_roundtrip,
    "import_trades_roundtrip": q_import_trades_roundtrip,
    "import_partitioned_roundtrip": q_import_partitioned_roundtrip,
    "grid_expand_long": q_grid_expand_long,
    "depth_long": q_depth_long,
    "missing_inputs": q_missing_inputs,
    "resolve_known_inputs": q_resolve_known_inputs,
    "catalog_features": q_catalog_features,
    "catalog_after_drops": q_catalog_after_drops,
    "run_event_count": q_run_event_count,
    "run_liquidity_curve": q_run_liquidity_curve,
    "event_count_order": q_event_count_order,
    "liquidity_curve_order": q_liquidity_curve_order,
    "event_count_by_day": q_event_count_by_day,
    "grid_expand_one_order": q_grid_expand_one_order,
    "dataset_parent_pages": q_dataset_parent_pages,
    "import_many_sources": q_import_many_sources,
    "catalog_snapshot_tail": q_catalog_snapshot_tail,
    "catalog_two_writers": q_catalog_two_writers,
    "catalog_row_stamps": q_catalog_row_stamps,
    "orphan_folders": q_orphan_folders,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the two-sided liquidity curve on sf0.001 (arrays of (price, quantity))."""
    return liq.liquidity_curve(bookmap.book_orders(spark, FLAGSHIP_DIR), CURVE_START, CURVE_END, CURVE_INTERVAL)


# The training-data operators and the pipeline over them are optional: without their files, or without the libraries
# that they need, the queries above stand alone.  An import error inside those files is not hidden.
_LLM = all(os.path.exists(os.path.join(_HERE, p)) for p in ("quoteline/llm/queries.py", "corpus_pipeline.py")) and all(
    importlib.util.find_spec(m) for m in ("numpy", "pyarrow", "xxhash"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(_QUERIES)
    if _LLM:
        import corpus_pipeline
        from quoteline.llm import queries as llm

        found |= llm.QUERIES
        found["pipeline"] = corpus_pipeline.run
    return found


# ---------------------------------------------------------------------------------------------
# DuckDB side
# ---------------------------------------------------------------------------------------------

_LINES = """
lines AS (
  SELECT l.*, o.o_custkey, epoch_us(o.o_orderdate) // 1000 + l.l_linenumber * 3600000 AS base
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

_BOOK = _LINES + """,
book AS (
  SELECT CAST(l_orderkey * 8 + l_linenumber AS INTEGER) AS id,
         CAST(l_suppkey AS INTEGER) AS ref,
         CAST(l_partkey AS INTEGER) AS ob_id,
         base AS created,
         CASE WHEN l_linenumber = 1 AND l_returnflag = 'A' THEN CAST(0 AS BIGINT)
              ELSE base + CAST(l_quantity AS BIGINT) * 86400000 END AS destroyed,
         CASE l_returnflag WHEN 'A' THEN 66 WHEN 'R' THEN 83 ELSE 78 END AS side,
         CAST(l_partkey % 20 AS INTEGER) AS price,
         CAST(l_quantity AS INTEGER) AS quantity,
         CASE WHEN CAST(l_quantity AS INTEGER) % 10 = 0 THEN 1 ELSE 0 END AS is_round,
         CAST(NULL AS INTEGER) AS past_id,
         CAST(NULL AS INTEGER) AS new_id,
         CAST(o_custkey AS INTEGER) AS p_id
  FROM lines
)"""

# Open orders end at the last millisecond of their UTC day; computed with date arithmetic here.
_RESOLVED = _BOOK + """,
resolved AS (
  SELECT id, created, side, price, quantity,
         CASE WHEN destroyed = 0
              THEN epoch_us(date_trunc('day', make_timestamp(created * 1000)) + INTERVAL 1 DAY) // 1000 - 1
              ELSE destroyed END AS destroyed
  FROM book
)"""

_GRID = f"""
grid AS (SELECT g AS t FROM range({CURVE_START}, {CURVE_END}, {CURVE_INTERVAL}) r(g))"""

# Depth as a range join of live orders with the grid (no generated per-order sequences).
_DEPTH = _RESOLVED + "," + _GRID + f""",
depth AS (
  SELECT g.t AS "timestamp", r.side, r.price, CAST(sum(r.quantity) AS BIGINT) AS quantity
  FROM resolved r JOIN grid g ON r.created <= g.t AND g.t < r.destroyed
  WHERE r.side IN (66, 83) AND r.created <= {CURVE_END} AND r.destroyed > {CURVE_START}
  GROUP BY g.t, r.side, r.price
)"""

_CATALOG = """
ds AS (
  SELECT p_partkey AS id, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS name,
         CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size % 5 END AS module_id
  FROM part
),
an AS (SELECT r_regionkey AS id, r_name AS name FROM region),
lin AS (
  SELECT DISTINCT l_partkey AS left_fs_id, l_suppkey AS right_ds_id FROM lineitem WHERE l_partkey <> l_suppkey
)"""

_LATEST = """
WITH log AS (
  SELECT {key} AS key, ts, event_id, event_type,
         row_number() OVER (PARTITION BY {key} ORDER BY ts DESC, event_id DESC) AS rn
  FROM events
)
SELECT key, epoch_us(ts) // 1000 AS last_ts, event_id AS last_event_id, event_type AS action
FROM log WHERE rn = 1 AND event_type <> 'error'
"""

_ORACLES = {
    "event_count": f"""
        WITH m AS (SELECT epoch_us(ts) // 1000 AS ms FROM events)
        SELECT {EVENTS_START} + ((ms - {EVENTS_START}) // {EVENTS_INTERVAL}) * {EVENTS_INTERVAL} AS "timestamp",
               count(*) AS "count"
        FROM m WHERE ms >= {EVENTS_START} AND ms < {EVENTS_END}
        GROUP BY 1""",
    "scan_orders": "WITH " + _BOOK + " SELECT created, destroyed, side, price, quantity FROM book",
    "import_orders": "WITH " + _BOOK + """
        SELECT id, ref, ob_id, created, destroyed, side, price, quantity, is_round, past_id, new_id, p_id FROM book""",
    "import_cancels": "WITH " + _LINES + """
        SELECT CAST(l_orderkey * 8 + l_linenumber AS INTEGER) AS id, CAST(NULL AS INTEGER) AS past_id,
               CAST(NULL AS INTEGER) AS new_id, CAST(l_partkey AS INTEGER) AS ob_id,
               epoch_us(l_shipdate) // 1000 AS "timestamp", 83 AS side,
               CAST(l_partkey % 20 AS INTEGER) AS price, CAST(l_quantity AS INTEGER) AS quantity
        FROM lines WHERE l_returnflag = 'R'""",
    "import_trades": "WITH " + _LINES + """
        SELECT CAST(l_orderkey * 8 + l_linenumber AS INTEGER) AS id, CAST(l_suppkey AS INTEGER) AS ref,
               CAST(l_orderkey AS INTEGER) AS o_id, CAST(l_partkey AS INTEGER) AS ob_id,
               epoch_us(l_shipdate) // 1000 AS "timestamp", 66 AS side,
               CAST(l_quantity AS INTEGER) AS quantity, CAST(l_partkey % 20 AS INTEGER) AS price,
               CAST(o_custkey AS INTEGER) AS p_id, CAST(l_suppkey AS INTEGER) AS cp_id
        FROM lines WHERE l_returnflag = 'A'""",
    "import_identifiers": r"""
        SELECT page_id, regexp_extract(url, '^.+/(\w+)\.\w+', 1) AS identifier,
               CASE WHEN regexp_extract(url, '^.+/(\w+)\.\w+', 1) = '' THEN NULL
                    ELSE regexp_extract(url, '^.+/(\w+)\.\w+', 1) || '_ORDERS' END AS dataset_name
        FROM pages""",
    "parent_names": r"""
        WITH leaf AS (SELECT page_id, regexp_extract(rtrim(url, '/'), '[^/]*$', 0) AS leaf FROM pages)
        SELECT page_id,
               CASE WHEN ltrim(leaf, '.') LIKE '%.%'
                    THEN left(leaf, length(leaf) - length(regexp_extract(leaf, '\.[^.]*$', 0)))
                    ELSE leaf END AS name
        FROM leaf""",
    "parse_time_param": """
        SELECT event_id, strftime(ts, '%Y-%m-%d_%H:%M:%S.%g') AS param, epoch_us(ts) // 1000 AS epoch_ms
        FROM events""",
    "filter_time_range": "WITH " + _BOOK + f"""
        SELECT id, created FROM book WHERE created BETWEEN {CURVE_START} AND {CURVE_END - 1}""",
    "filter_live_orders": "WITH " + _RESOLVED + f"""
        SELECT created, destroyed, side, price, quantity FROM resolved
        WHERE NOT (created > {CURVE_END} OR destroyed <= {CURVE_START})""",
    "filter_side_buy": "WITH " + _LINES + """
        SELECT base AS created,
               CASE WHEN l_linenumber = 1 THEN CAST(0 AS BIGINT) ELSE base + CAST(l_quantity AS BIGINT) * 86400000 END
                 AS destroyed,
               66 AS side, CAST(l_partkey % 20 AS INTEGER) AS price, CAST(l_quantity AS INTEGER) AS quantity
        FROM lines WHERE l_returnflag = 'A'""",
    "filter_side_sell": "WITH " + _LINES + """
        SELECT base AS created, base + CAST(l_quantity AS BIGINT) * 86400000 AS destroyed,
               83 AS side, CAST(l_partkey % 20 AS INTEGER) AS price, CAST(l_quantity AS INTEGER) AS quantity
        FROM lines WHERE l_returnflag = 'R'""",
    "fill_open_orders": "WITH " + _RESOLVED + " SELECT id, created, destroyed FROM resolved",
    "grid_expand": "WITH " + _RESOLVED + "," + _GRID + f"""
        SELECT r.created, r.side, r.price, r.quantity, g.t AS "timestamp"
        FROM resolved r JOIN grid g ON r.created <= g.t AND g.t < r.destroyed
        WHERE r.created <= {CURVE_END} AND r.destroyed > {CURVE_START}""",
    "depth_by_price": "WITH " + _DEPTH + ' SELECT "timestamp", side, price, quantity FROM depth',
    "curve_buy": "WITH " + _DEPTH + """
        SELECT "timestamp", string_agg(price || ':' || quantity, ',' ORDER BY price) AS curve_buy
        FROM depth WHERE side = 66 GROUP BY "timestamp" """,
    "curve_sell": "WITH " + _DEPTH + """
        SELECT "timestamp", string_agg(price || ':' || quantity, ',' ORDER BY price) AS curve_sell
        FROM depth WHERE side = 83 GROUP BY "timestamp" """,
    "liquidity_curve": "WITH " + _DEPTH + """,
        c AS (
          SELECT "timestamp",
                 string_agg(price || ':' || quantity, ',' ORDER BY price) FILTER (WHERE side = 66) AS curve_buy,
                 string_agg(price || ':' || quantity, ',' ORDER BY price) FILTER (WHERE side = 83) AS curve_sell
          FROM depth GROUP BY "timestamp"
        )
        SELECT "timestamp", curve_buy, curve_sell FROM c WHERE curve_buy IS NOT NULL AND curve_sell IS NOT NULL""",
    "search_datasets": "WITH " + _CATALOG + f"""
        SELECT d.id, d.name, a.name AS module_name, count(l.right_ds_id) AS n_parents
        FROM ds d LEFT JOIN an a ON d.module_id = a.id LEFT JOIN lin l ON l.left_fs_id = d.id
        WHERE d.name ILIKE '%{SEARCH_PATTERN}%'
        GROUP BY d.id, d.name, a.name""",
    "dataset_listing": "WITH " + _CATALOG + f""",
        parents AS (
          SELECT l.left_fs_id AS id, string_agg(p.name, '|' ORDER BY p.name) AS parents
          FROM lin l JOIN ds p ON p.id = l.right_ds_id JOIN ds f ON f.id = l.left_fs_id
          GROUP BY l.left_fs_id
        )
        SELECT d.id, d.name, a.name AS module_name, pa.parents
        FROM ds d LEFT JOIN an a ON d.module_id = a.id LEFT JOIN parents pa ON pa.id = d.id
        WHERE d.name ILIKE '%{SEARCH_PATTERN}%'""",
    "search_modules": "WITH " + _CATALOG + f"""
        SELECT id, name FROM an WHERE contains(lower(name), lower('{MODULE_PATTERN}'))""",
    "dataset_parents": "WITH " + _CATALOG + """
        SELECT f.id, f.name, string_agg(p.name, '|' ORDER BY p.name) AS parents, count(*) AS n_parents
        FROM lin l JOIN ds f ON f.id = l.left_fs_id JOIN ds p ON p.id = l.right_ds_id
        GROUP BY f.id, f.name""",
    "dataset_parent_edges": "WITH " + _CATALOG + """
        SELECT f.id, f.name, p.id AS parent_id, p.name AS parent_name
        FROM lin l, ds f, ds p WHERE f.id = l.left_fs_id AND p.id = l.right_ds_id""",
    "dataset_derived": "WITH " + _CATALOG + """
        SELECT p.id, p.name, count(*) AS n_derived
        FROM lin l JOIN ds p ON p.id = l.right_ds_id
        WHERE l.left_fs_id IN (SELECT id FROM ds)
        GROUP BY p.id, p.name""",
    "resolve_inputs": "WITH " + _CATALOG + """
        SELECT name, id FROM ds WHERE id IN (SELECT l_partkey FROM lineitem)""",
    "current_datasets": _LATEST.format(key="CAST(user_id AS VARCHAR)"),
    "current_modules": _LATEST.format(key="props"),
}


# Round trips and runs return what the base query returns, so they share its oracle.
_ORACLES["sql_time_range"] = "WITH " + _BOOK + f"""
        SELECT id, created FROM book WHERE {CURVE_START} <= created AND created < {CURVE_END}"""
_ORACLES["save_dataset_roundtrip"] = _ORACLES["import_orders"]
_ORACLES["save_features_roundtrip"] = _ORACLES["event_count"]
_ORACLES["import_book_roundtrip"] = _ORACLES["import_orders"]
_ORACLES["stream_import_roundtrip"] = _ORACLES["import_orders"]
_ORACLES["run_event_count"] = _ORACLES["event_count"]
_ORACLES["run_liquidity_curve"] = _ORACLES["liquidity_curve"]


_ORACLES["import_cancels_roundtrip"] = _ORACLES["import_cancels"]
_ORACLES["import_trades_roundtrip"] = _ORACLES["import_trades"]
_ORACLES["import_partitioned_roundtrip"] = _ORACLES["import_orders"].replace(
    "new_id, p_id FROM book", "new_id, p_id, CASE WHEN side = 66 THEN 'buys' ELSE 'rest' END AS identifier FROM book")
_LONG = f"""
long_grid AS (SELECT g AS t FROM range({CURVE_START}, {CURVE_END}, {LONG_INTERVAL}) r(g))"""
_LEVEL_SUMS = """
        SELECT side, price, count(*) AS n_points, min("timestamp") AS first_ms, max("timestamp") AS last_ms,
               CAST(sum(quantity) AS BIGINT) AS quantity,
               CAST(sum(quantity * ("timestamp" % 1000003)) AS BIGINT) AS checksum
        FROM x GROUP BY side, price"""
_ORACLES["grid_expand_long"] = "WITH " + _RESOLVED + "," + _LONG + f""",
x AS (
  SELECT r.side, r.price, r.quantity, g.t AS "timestamp"
  FROM resolved r JOIN long_grid g ON r.created <= g.t AND g.t < r.destroyed
  WHERE r.created <= {CURVE_END} AND r.destroyed > {CURVE_START}
)""" + _LEVEL_SUMS
_ORACLES["depth_long"] = "WITH " + _RESOLVED + "," + _LONG + f""",
x AS (
  SELECT g.t AS "timestamp", r.side, r.price, CAST(sum(r.quantity) AS BIGINT) AS quantity
  FROM resolved r JOIN long_grid g ON r.created <= g.t AND g.t < r.destroyed
  WHERE r.side IN (66, 83) AND r.created <= {CURVE_END} AND r.destroyed > {CURVE_START}
  GROUP BY g.t, r.side, r.price
)""" + _LEVEL_SUMS
_ORACLES["missing_inputs"] = "SELECT DISTINCT 'supplier ' || l_suppkey AS name FROM lineitem"
_ORACLES["resolve_known_inputs"] = _ORACLES["resolve_inputs"]
_PART_CATALOG = """
WITH names AS (SELECT p_name || ' ' || CAST(p_partkey AS VARCHAR) AS name FROM part),
ends AS (SELECT min(name) AS first, max(name) AS last FROM names)"""
_ORACLES["catalog_features"] = _PART_CATALOG + f"""
        SELECT name, CAST(NULL AS VARCHAR) AS module_name, CAST(NULL AS VARCHAR) AS module_parameters,
               CAST(NULL AS VARCHAR) AS parents FROM names
        UNION ALL
        SELECT 'events_hourly', 'EventCount',
               '{{"end_time": {EVENTS_END}, "interval": {EVENTS_INTERVAL}, "start_time": {EVENTS_START}, "time_column": "ts"}}',
               first || '|' || last FROM ends"""
_ORACLES["catalog_after_drops"] = _PART_CATALOG + """
        SELECT 'dataset' AS kind, name, CAST(NULL AS VARCHAR) AS parents FROM names WHERE name <> (SELECT first FROM ends)
        UNION ALL SELECT 'dataset', 'events_hourly', last FROM ends
        UNION ALL SELECT 'module', r_name, NULL FROM region WHERE r_name <> (SELECT min(r_name) FROM region)
        UNION ALL SELECT 'module', unnest(['EventCount', 'Liquid']), NULL"""

_ORACLES["event_count_by_day"] = _ORACLES["event_count"]
_ORACLES["event_count_order"] = "WITH c AS (" + _ORACLES["event_count"] + """)
        SELECT "timestamp", "count", row_number() OVER (ORDER BY "timestamp") AS position FROM c"""
_ORACLES["liquidity_curve_order"] = "WITH " + _DEPTH + """,
        c AS (
          SELECT "timestamp", CAST(count(*) FILTER (WHERE side = 66) AS INTEGER) AS n_buy,
                 CAST(count(*) FILTER (WHERE side = 83) AS INTEGER) AS n_sell
          FROM depth GROUP BY "timestamp"
        )
        SELECT row_number() OVER (ORDER BY "timestamp") AS position, "timestamp", n_buy, n_sell FROM c WHERE n_buy > 0 AND n_sell > 0"""
_ORACLES["grid_expand_one_order"] = "WITH " + _BOOK + "," + _LONG + f""",
one AS (SELECT min(created) AS created, max(price) AS price, sum(quantity) AS quantity FROM book),
x AS (SELECT 66 AS side, price, quantity, t AS "timestamp" FROM one JOIN long_grid ON created <= t AND t < {CURVE_END})""" + _LEVEL_SUMS
_ORACLES["dataset_parent_pages"] = "WITH " + _CATALOG + f""",
ranked AS (
  SELECT f.id, p.name, (row_number() OVER (PARTITION BY f.id ORDER BY p.name, p.id) - 1) // {PARENTS_A_PAGE} AS page,
         count(*) OVER (PARTITION BY f.id) AS n_parents
  FROM lin l JOIN ds f ON f.id = l.left_fs_id JOIN ds p ON p.id = l.right_ds_id
)
        SELECT id, page, string_agg(name, '|' ORDER BY name) AS parents, n_parents FROM ranked GROUP BY id, page, n_parents"""
_ORACLES["import_many_sources"] = _ORACLES["import_orders"].replace(
    "new_id, p_id FROM book",
    f"new_id, p_id, CASE WHEN side = 66 THEN 'hot' ELSE 'c' || (p_id % {N_SOURCES}) END AS identifier FROM book")
_ORACLES["catalog_snapshot_tail"] = _ORACLES["catalog_after_drops"]
_ORACLES["catalog_two_writers"] = _PART_CATALOG + """
        SELECT name, CAST(1 AS BIGINT) AS n_rows, 'first' AS filepath, true AS refused FROM names"""
_ORACLES["catalog_row_stamps"] = _PART_CATALOG + """
        SELECT name, true AS in_run, true AS own_id FROM names
        UNION ALL SELECT unnest(['events_hourly', 'EventCount', 'Liquid']), true, true
        UNION ALL SELECT r_name, true, true FROM region"""
_ORACLES["orphan_folders"] = "WITH " + _BOOK + """
        SELECT 'lost' AS what, 'rest_ORDERS.parquet' AS folder, CAST(NULL AS BIGINT) AS n
        UNION ALL SELECT 'saved', 'rest_ORDERS', count(*) FROM book WHERE side NOT IN (66, 83)
        UNION ALL SELECT 'still lost', '', 0"""


def oracle_sql() -> dict[str, str]:
    found = {k: v for k, v in _ORACLES.items() if k in _QUERIES}
    if _LLM:
        import corpus_pipeline
        from quoteline.llm import queries as llm

        found |= llm.ORACLES
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
